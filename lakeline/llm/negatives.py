"""Hard negatives of anchor vectors by lists that the anchors of a cluster share.

Scores are inner products of whole numbers. The anchors of a label are put into clusters by direction. For
a cluster the candidates are sorted once, by an upper bound of the score that any member can reach: the norm
times the cosine of the candidate's angle to the centre less the widest angle of a member. Every member
walks that one list and stops as soon as no score behind its place can enter its result, which the bound
certifies. So results are exact whatever the clusters are like; good clusters only make the walks shorter.

Candidates are cut into blocks of at most ``BLOCK`` rows and anchors into groups of at most ``GROUP``; each
pair of block and group is one row of a join and is walked by itself, and the best of all blocks are merged.
The positives of each anchor come from a first walk (same label), and bound the scores of its negatives in a
second one (other labels).

* A row takes part if its label is not null and its vector is not null and has only finite components.
* An empty vector scores 0 with all; of vectors of different lengths the shorter one counts as filled up
  with zeros. Rows without an id take no part.
* Ties go by the smaller id. Rows that repeat an id are rows of their own, but never partners of each other;
  each repeated anchor has its own results.
* Scores beyond 64 bits are not defined. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeline.session import stored
from lakeline.sources.files import table

BLOCK = 1 << 16
GROUP = 1 << 15
#: Anchors that the centres are fitted on, at most.
SAMPLE_ANCHORS = 4096
PER_CELL = 256
CELLS = 64
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT, MOST_PERCENT = 30, 90
EVERY = 100

_EXACT = 2.0**53
_BLOCK = "block bigint, ids binary, labels binary, width int, numbers binary, kind string"
_HITS = "anchor bigint, place int, id bigint, score bigint"


def whole(vector: Column) -> Column:
    """Components times 256, rounded down."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def pack(kind_of_rows: str = "block") -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A function that packs the rows ``id, label, numbers`` of a group into one row of byte columns."""
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["numbers"].map(len).to_numpy()
        numbers = np.zeros((len(rows), int(lengths.max())), np.int64)
        flat = np.concatenate([np.asarray(x, np.int64) for x in rows["numbers"]])
        numbers[np.arange(numbers.shape[1]) < lengths[:, None]] = flat
        low, high = (int(flat.min()), int(flat.max())) if len(flat) else (0, 0)
        kind = next(k for k in ("int16", "int32", "int64") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
        return pd.DataFrame({
            kind_of_rows: [int(rows[kind_of_rows].iloc[0])], "ids": [rows["id"].to_numpy(np.int64).tobytes()],
            "labels": [rows["label"].to_numpy(np.int64).tobytes()], "width": [numbers.shape[1]],
            "numbers": [numbers.astype(kind).tobytes()], "kind": [kind],
        })

    return packed


def unpack(ids: bytes, labels: bytes, width: int, numbers: bytes, kind: str) -> tuple[np.ndarray, ...]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(labels, np.int64), np.frombuffer(numbers, kind).reshape(len(ids), width)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products as 64-bit integers, by floating point where that is exact."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    if width and len(left) and len(right):
        most = float(np.abs(left.astype(float)).max()) * float(np.abs(right.astype(float)).max()) * width
        if most < _EXACT:
            return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def norms(numbers: np.ndarray) -> np.ndarray:
    return np.sqrt((numbers.astype(float) ** 2).sum(axis=1))


def directions(numbers: np.ndarray) -> np.ndarray:
    """Rows of length 1; a row of zeros stays."""
    size = norms(numbers)
    return numbers.astype(float) / np.where(size > 0, size, 1.0)[:, None]


def fit_centres(numbers: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of ``cells`` clusters by direction, the same ones on every call."""
    points = directions(numbers)
    centres = points[np.random.default_rng(11).choice(len(points), min(cells, len(points)), replace=False)]
    for _ in range(rounds):
        cell = np.argmax(points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, points)
        size = np.sqrt((sums**2).sum(axis=1))
        centres = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1.0)[:, None], centres)
    return centres


def shared_list(candidates: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the candidates by falling bound, and the bounds, for members of norm 1.

    The bound holds for every member: its angle to a candidate is at least the candidate's angle to the
    centre less the widest angle of a member to the centre.
    """
    width = max(candidates.shape[1], members.shape[1])
    candidates, members = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (candidates, members))
    unit = directions(members)
    centre = unit.sum(axis=0)
    size = np.sqrt((centre**2).sum())
    centre = centre / size if size > 0 else centre
    widest = np.arccos(np.clip(unit @ centre, -1.0, 1.0)).max() if size > 0 else np.pi
    angle = np.arccos(np.clip(directions(candidates) @ centre, -1.0, 1.0))
    bound = norms(candidates) * np.cos(np.maximum(0.0, angle - widest - 1e-7))
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(
    ids: np.ndarray, numbers: np.ndarray, members: np.ndarray, member_ids: np.ndarray, owner: np.ndarray,
    low: np.ndarray, high: np.ndarray, count: int, steps: list[int] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``slot, id, score`` of the ``count`` best candidates of every slot.

    A slot belongs to the member ``owner`` and takes scores from ``low`` to ``high``. All slots walk the one
    list of their cluster, in steps that double in length; a slot leaves once it has ``count`` scores above
    whatever the rest of the list can reach, or that rest is below ``low``. ``steps`` collects how far it went.
    """
    order, bound = shared_list(numbers, members)
    reach = norms(members) * (1 + 1e-9)
    slots = np.arange(len(owner))
    least = low.astype(float)
    pool = [np.empty(0, np.int64)] * 3
    at, step = 0, 256
    active = slots[low <= high]
    while at < len(order) and len(active):
        active = active[reach[owner[active]] * bound[at] + 1e-3 >= least[active]]
        if not len(active):
            break
        step = max(1, min(step, (1 << 22) // len(active)))
        chunk = order[at:at + step]
        used, of = np.unique(owner[active], return_inverse=True)
        score = products(members[used], numbers[chunk])
        fits = score[of]
        fits = (fits >= np.maximum(low[active], np.ceil(least[active]).astype(np.int64))[:, None]) & (
            fits <= high[active][:, None]) & (ids[chunk][None, :] != member_ids[owner[active]][:, None])
        row, place = np.nonzero(fits)
        found = [np.concatenate(x) for x in zip(
            pool, (active[row], ids[chunk[place]], score[of[row], place]))]
        sort = np.lexsort((found[1], -found[2], found[0]))
        found = [x[sort] for x in found]
        rank = np.arange(len(sort)) - np.searchsorted(found[0], found[0])
        pool = [x[rank < count] for x in found]
        last = np.nonzero(rank == count - 1)[0]
        least[found[0][last]] = np.maximum(least[found[0][last]], found[2][last])
        at, step = at + len(chunk), step * 2
    if steps is not None:
        steps.append(at)
    return tuple(pool)


def _walked(count: int, same_label: bool) -> Callable:
    """For ``mapInPandas``: walks each pair of block and group, cluster by cluster."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in chain.from_iterable(frame.itertuples(index=False) for frame in frames):
            ids, labels, numbers = unpack(row.ids, row.labels, row.width, row.numbers, row.kind)
            anchor_ids, anchor_labels, anchors = unpack(
                row.a_ids, row.a_labels, row.a_width, row.a_numbers, row.a_kind)
            slots = np.frombuffer(row.slots, np.int64).reshape(-1, 5)  # anchor, member, place, low, high
            cell = np.frombuffer(row.cells, np.int64)
            for label, group in np.unique(np.stack([anchor_labels, cell], 1), axis=0):
                mine = np.nonzero((anchor_labels == label) & (cell == group))[0]
                lane = slots[np.isin(slots[:, 1], mine)]
                rows = np.nonzero((labels == label) == same_label)[0]
                if not len(rows) or not len(lane):
                    continue
                slot, found, score = walk(
                    ids[rows], numbers[rows], anchors[mine], anchor_ids[mine],
                    np.searchsorted(mine, lane[:, 1]), lane[:, 3], lane[:, 4], count)
                yield pd.DataFrame({"anchor": lane[slot, 0], "place": lane[slot, 2].astype(np.int32),
                                    "id": found, "score": score})

    return run


def _grouped(centres: np.ndarray) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Packs the anchors of a group, with the cluster of each and its slots."""
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("anchor", kind="stable")
        heads = rows["anchor"].to_numpy(np.int64)
        first = np.unique(heads, return_index=True)[1]
        out = pack("part")(rows.iloc[first])
        numbers = unpack(out.ids[0], out.labels[0], out.width[0], out.numbers[0], out.kind[0])[2]
        width = min(numbers.shape[1], centres.shape[1])
        cells = np.argmax(directions(numbers)[:, :width] @ centres[:, :width].T, axis=1)
        slots = np.stack([heads, np.searchsorted(heads[first], heads), rows["place"], rows["low"], rows["high"]], 1)
        out.columns = ["part", "a_ids", "a_labels", "a_width", "a_numbers", "a_kind"]
        return out.assign(cells=[cells.astype(np.int64).tobytes()], slots=[slots.astype(np.int64).tobytes()])

    return packed


def _met(blocks: DataFrame, anchors: DataFrame, parts: int, n_blocks: int, centres: np.ndarray) -> DataFrame:
    """One row for each pair of a candidate block and a group of anchors."""
    groups = anchors.groupBy("part").applyInPandas(
        _grouped(centres), "part bigint, a_ids binary, a_labels binary, a_width int, a_numbers binary, "
        "a_kind string, cells binary, slots binary")
    left = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    right = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
    return left.join(right, ["block", "part"])


def _best(hits: DataFrame, count: int) -> DataFrame:
    """The best ``count`` of each anchor and place, ranked from 1."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT, most_percent: int = MOST_PERCENT,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``id, label`` (whole numbers) and ``numbers`` (array of bigint). The positives of an
    anchor are its best rows of the same label, the negatives of a positive the best rows of other labels
    whose score is from ``least_percent`` to ``most_percent`` per cent of the positive's.
    """
    spark = vectors.sparkSession
    rows = vectors.where("id IS NOT NULL AND label IS NOT NULL AND numbers IS NOT NULL").select(
        "id", F.col("label").cast("bigint").alias("label"), "numbers")
    anchors = stored(rows.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    total, n_anchors = rows.count(), anchors.count()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(-(-total // BLOCK), min(shuffled, -(-total // 1024)))
    parts = -(-n_anchors // GROUP)
    sample = anchors.orderBy(F.xxhash64("anchor"), "anchor").limit(SAMPLE_ANCHORS).toPandas()
    sample = sample.assign(part=0)
    numbers = unpack(*pack("part")(sample).iloc[0][1:])[2]
    centres = fit_centres(numbers, min(CELLS, -(-n_anchors // PER_CELL)))

    blocks = stored(
        rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks)))
        .groupBy("block").applyInPandas(pack(), _BLOCK), "blocks")
    anchors = anchors.withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(parts)))

    most = float(1 << 62)
    everything = anchors.withColumns({
        "place": F.lit(0), "low": F.lit(-int(most)).cast("bigint"), "high": F.lit(int(most)).cast("bigint")})
    near = _met(blocks, everything, parts, n_blocks, centres).mapInPandas(_walked(positives, True), _HITS)
    near = stored(_best(near, positives).select(
        "anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")

    # least * p <= 100 * n <= most * p, in whole numbers
    share = F.col("positive_score").cast("decimal(38,0)")
    windows = anchors.join(near, "anchor").withColumns({
        "low": F.ceil(share * least_percent / 100).cast("bigint"),
        "high": F.floor(share * most_percent / 100).cast("bigint")})
    far = _met(blocks, windows, parts, n_blocks, centres).mapInPandas(_walked(negatives, False), _HITS)
    return (
        _best(far, negatives).join(near, ["anchor", "place"]).join(
            anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of the rows of ``embeddings`` whose id is divisible by 100, against all rows."""
    vectors = table(spark, folder, "embeddings", "vec_id", "label", "embedding").where(usable(F.col("embedding")))
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = vectors.select(F.col("vec_id").alias("id"), label.alias("label"), whole(F.col("embedding")).alias("numbers"))
    return hard_negatives(vectors, F.col("id") % EVERY == 0)


OP11_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
        CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (
        PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
    n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.alike
    AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
