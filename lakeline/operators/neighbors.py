"""Similarity joins and nearest neighbours on Euclidean distance.

Rows with the same vector are joined once: ``distinct_vectors`` folds copies
into one row with their number, joins report pairs of distinct vectors with
both numbers, and ``members`` lists the ids behind each. A third of the table
being copies of one vector then costs one row, and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.functions import vectors as vx
from lakeline.operators.joins import FAN, lookup_join
from lakeline.session import stored


def fit_lsh(
    df: DataFrame, vector: str, out: str = "hashes", bucket_length: float = 2.0,
    tables: int = 3, seed: int = 1,
) -> BucketedRandomProjectionLSHModel:
    """Random unit projections cut into buckets of ``bucket_length``."""
    return BucketedRandomProjectionLSH(
        inputCol=vector, outputCol=out, bucketLength=bucket_length, numHashTables=tables, seed=seed
    ).fit(df)


def lsh_hash(model: BucketedRandomProjectionLSHModel, df: DataFrame) -> DataFrame:
    """Add the hashes, one single-slot vector per table; rows that have them stay as they are."""
    return df if model.getOutputCol() in df.columns else model.transform(df)


def _hashes(model: BucketedRandomProjectionLSHModel) -> Column:
    return F.transform(F.col(model.getOutputCol()), lambda h: vector_to_array(h)[0])


def nearest(
    model: BucketedRandomProjectionLSHModel, df: DataFrame, key: Vector, k: int = 2,
    distance: str = "distCol", ties: str | None = None,
) -> DataFrame:
    """The ``k`` nearest rows, exactly; all rows if there are fewer. Raw or hashed rows.

    Buckets around that of ``key`` are probed ring by ring: a row's ring is how many buckets it is away in the
    table where it is farthest. The rings that hold ``k`` rows give a ``k``-th distance. Projections are on
    unit vectors, so a row farther out than that distance on any projection can't be nearer, and only
    rings up to there are looked at. No step sorts the table: each keeps the best ``k`` of a partition.
    Rows at equal distance go by the column ``ties``, if one is named.
    """
    spark, length = df.sparkSession, model.getBucketLength()
    probe = model.transform(spark.createDataFrame([(key,)], [model.getInputCol()]))
    centre = probe.select(_hashes(model).alias("h")).first()["h"]
    away = F.zip_with(_hashes(model), vx.literal_vector(centre), lambda x, y: F.abs(x - y))
    gap = F.sqrt(vx.squared_distance(
        vector_to_array(model.getInputCol()), vx.literal_vector(key.toArray())))
    ring = F.array_max(away)
    rows = lsh_hash(model, df)
    filled = rows.select(ring.alias("ring")).orderBy("ring").limit(k).agg(F.max("ring")).first()[0]
    if filled is None:
        return rows.withColumn(distance, gap).limit(0)
    found = rows.where(ring <= filled).select(gap.alias("gap")).orderBy("gap").limit(k)
    farthest = found.agg(F.max("gap")).first()[0]
    reach = max(filled, farthest * (1 + 1e-9) / length + 1)
    order = [distance] + ([ties] if ties else [])
    return rows.where(ring <= reach).withColumn(distance, gap).orderBy(*order).limit(k)


def distinct_vectors(df: DataFrame, row_id: str, vector: str) -> DataFrame:
    """``(id, n, v, ...)`` per distinct vector: smallest id, number of rows, values."""
    values = df.select(row_id, vector_to_array(vector).alias("v"))
    return values.groupBy("v").agg(
        F.min(row_id).alias("id"), F.count(F.lit(1)).alias("n")
    ).select("id", "n", "v")


def members(df: DataFrame, row_id: str, vector: str) -> DataFrame:
    """``(id, member)``: the rows behind each distinct vector.

    The digest of the values stands for them, so only 16 bytes per row are
    shuffled, and a vector that very many rows hold is cut up by the join.
    """
    values = F.transform(vector_to_array(vector), lambda x: x + 0.0)
    digest = F.md5(F.to_json(F.struct(values.alias("v"))).cast("binary"))
    rows = df.select(F.col(row_id).alias("member"), digest.alias("digest"))
    first = rows.groupBy("digest").agg(
        F.min("member").alias("id"), F.count(F.lit(1)).alias("uses")
    )
    named = lookup_join(rows, stored(first, "copies"), "digest", "uses", "member")
    return named.select("id", "member")


def _blocks(rows: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """Keys that hold more than 1/64 of all rows, with the blocks to cut them into.

    There are fewer than 64 such keys, whatever the data: safe to collect and
    to broadcast.
    """
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") * FAN / F.lit(max(rows.count(), 1))
    hot = counts.where(share > 1).select(*key, F.ceil(share).cast("int").alias(out))
    return rows.sparkSession.createDataFrame(hot.collect(), hot.schema)


def _meet(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inner join of two keyed tables that cuts frequent keys into block pairs.

    With ``p`` blocks of a key on one side and ``q`` on the other, each row
    goes to one block of its own side and is met by every block of the other,
    so each pair meets once, in one of ``p * q`` places. The work grows with
    pairs, not bytes, so the number of partitions is stated: left to itself
    Spark would fold small inputs into few tasks.
    """
    spark = a.sparkSession
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        4 * spark.sparkContext.defaultParallelism,
    )
    on = [*key, "__i", "__j"]
    hot_a, hot_b = _blocks(a, key, "__p"), _blocks(b, key, "__q")
    hot = hot_a.join(hot_b, list(key), "full").select(
        *key, F.coalesce("__p", F.lit(1)).alias("__p"), F.coalesce("__q", F.lit(1)).alias("__q")
    )
    hot = F.broadcast(hot)
    p, q = F.coalesce("__p", F.lit(1)), F.coalesce("__q", F.lit(1))

    def place(side: DataFrame, row_id: str, mine: Column, own: str, other: str, theirs: Column):
        placed = side.join(hot, list(key), "left")
        placed = placed.withColumn(own, F.pmod(F.xxhash64(row_id), mine).cast("int"))
        return placed.withColumn(
            other, F.explode(F.sequence(F.lit(0), theirs - 1))
        ).drop("__p", "__q").repartition(parts, *on)

    left = place(a, "id_a", p, "__i", "__j", q)
    right = place(b, "id_b", q, "__j", "__i", p)
    return left.join(right, on)


def _hashed(model: BucketedRandomProjectionLSHModel, df: DataFrame, row_id: str, vector: str) -> DataFrame:
    """``(id, n, v, h)`` per distinct vector, with the hashes the rows bring or new ones."""
    if model.getOutputCol() in df.columns:
        values = df.select(row_id, vector_to_array(vector).alias("v"), _hashes(model).alias("h"))
        return values.groupBy("v", "h").agg(
            F.min(row_id).alias("id"), F.count(F.lit(1)).alias("n")).select("id", "n", "v", "h")
    rows = distinct_vectors(df, row_id, vector)
    hashed = model.transform(rows.withColumn(model.getInputCol(), vx.as_vector(F.col("v"))))
    return hashed.select("id", "n", "v", _hashes(model).alias("h"))


def similarity_join(
    model: BucketedRandomProjectionLSHModel,
    a: DataFrame,
    b: DataFrame,
    row_id: str,
    vector: str,
    threshold: float,
    self_join: bool = False,
) -> DataFrame:
    """Pairs that share a bucket in some table and lie closer than ``threshold``; raw or hashed rows.

    The pairs are those of the library's own join for the model. With one projection to a
    table, buckets of a large table hold a fixed share of it: ``compound_join`` is the form that scales.

    Result ``(id_a, n_a, id_b, n_b, distance)`` over distinct vectors; with
    ``self_join`` each pair once, ``id_a < id_b``, and a vector that ``n > 1`` rows have as
    ``(id, n, id, n, 0.0)``, which stands for their ``n (n - 1) / 2`` pairs.

    Within a bucket only rows meet whose next projection also lies close
    enough: projections are on unit vectors, so two rows nearer than the
    threshold differ by less than it on every projection, and this loses
    nothing. The pair is kept where it meets first, which makes a ``distinct``
    over all candidates unnecessary.
    """
    length, tables = model.getBucketLength(), model.getNumHashTables()
    width = threshold + length

    def keyed(df: DataFrame, tag: str, reach: bool) -> DataFrame:
        hashed = stored(_hashed(model, df, row_id, vector).toDF(
            f"id_{tag}", f"n_{tag}", f"v_{tag}", f"h_{tag}"), f"hashed-{tag}")
        h = F.col(f"h_{tag}")
        rows = hashed.select("*", F.posexplode(h).alias("tab", "bucket"))
        near = F.floor(F.get(h, (F.col("tab") + 1) % tables) * length / width).cast("bigint")
        rows = rows.withColumn("cell", near)
        if reach:
            rows = rows.withColumn("cell", F.explode(F.sequence(near - 1, near + 1)))
        return rows

    left, right = keyed(a, "a", False), keyed(b, "b", True)
    met = _meet(left, right, ["tab", "bucket", "cell"])
    copies = distinct_vectors(a, row_id, vector).where((F.col("n") > 1) & F.lit(threshold > 0)).select(
        F.col("id").alias("id_a"), F.col("n").alias("n_a"), F.col("id").alias("id_b"),
        F.col("n").alias("n_b"), F.lit(0.0).alias("distance"))
    met_before = F.col("id_a") >= F.col("id_b") if self_join else F.lit(False)
    for table in range(tables - 1):
        same = F.get("h_a", F.lit(table)) == F.get("h_b", F.lit(table))
        met_before = met_before | ((F.col("tab") > table) & same)
    # one condition, so that the distance is only worked out where it is needed
    distance = F.sqrt(vx.squared_distance(F.col("v_a"), F.col("v_b")))
    pairs = (
        met.withColumn("distance", F.when(~met_before, distance))
        .where(F.col("distance") < threshold)
        .select("id_a", "n_a", "id_b", "n_b", "distance")
    )
    return pairs.union(copies) if self_join else pairs


@dataclass(frozen=True)
class CompoundLSH:
    """``tables`` alternative keys, each of ``per_key`` projections that must all agree."""

    model: BucketedRandomProjectionLSHModel
    per_key: int
    tables: int

    def keys(self, hashes: Column) -> Column:
        """The keys of a row with these hashes, one for each table."""
        def of(known: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), F.lit(self.tables - 1)),
                lambda table: F.xxhash64(table, F.slice(known, table * self.per_key + 1, self.per_key)))

        # bound to a name: Spark would else put what makes the hashes into the inner function, once for each table
        return F.get(F.transform(F.array(hashes), of), F.lit(0))


def same_bucket(distance: float, length: float, dimensions: int) -> float:
    """Chance that two points at ``distance`` share a bucket of one random unit projection."""
    ratio = length * sqrt(dimensions) / distance
    return erf(ratio / sqrt(2)) - 2 / (sqrt(2 * pi) * ratio) * (1 - exp(-ratio * ratio / 2))


SAMPLE_ROWS = 1024
WIDTH = 4.0


def fit_compound_lsh(
    df: DataFrame, vector: str, threshold: float, recall: float = 0.98, candidates: float = 4.0,
    out: str = "hashes", seed: int = 1,
) -> CompoundLSH:
    """Keys that find a pair at ``threshold`` with probability ``recall``.

    Two rows share a key with a probability that falls with their distance. The distances between at most ``SAMPLE_ROWS``
    rows, from twice the threshold on, say how a pair picked at random does; as many projections are joined to a key
    as leave a row about ``candidates`` random partners in a bucket, and as many tables are
    taken as ``recall`` then asks for. So the work for a row grows with the tables, with the logarithm
    of the rows, and not with the rows. Pairs nearer than the threshold are found more often than ``recall``.
    """
    n = df.count()
    sample = df.select(vector).sample(fraction=min(1.0, 2 * SAMPLE_ROWS / max(n, 1)), seed=seed).limit(SAMPLE_ROWS)
    points = np.array([row[0].toArray() for row in sample.collect()])
    per_key, size, tables = 1, points.shape[1] if len(points) else 1, 1
    length = WIDTH * threshold / sqrt(size)
    near = same_bucket(threshold, length, size)
    if len(points) > 1:
        squares = (points**2).sum(axis=1)
        gaps = np.sqrt(np.maximum(0, squares[:, None] + squares - 2 * points @ points.T))
        gaps = gaps[np.triu_indices(len(points), 1)]
        far = gaps[gaps >= 2 * threshold]
        if len(far):
            chances = np.array([same_bucket(x, length, size) for x in np.quantile(far, np.linspace(0, 1, 201))])
            while per_key < 32 and n * (chances**per_key).mean() > candidates:
                per_key += 1
    tables = max(1, ceil(log(1 - recall) / log(1 - near**per_key)))
    return CompoundLSH(fit_lsh(df, vector, out, length, per_key * tables, seed), per_key, tables)


def compound_candidates(lsh: CompoundLSH, left: DataFrame, right: DataFrame, self_join: bool = False) -> DataFrame:
    """``(id_a, id_b)`` of the rows ``(id, keys)`` that share a key in some table, each pair once.

    Only ids and keys meet; a key that very many rows have is cut into blocks.
    """
    def keyed(rows: DataFrame, tag: str) -> DataFrame:
        return rows.select(F.col("id").alias(f"id_{tag}"), F.posexplode("keys").alias("tab", "key"))

    met = _meet(keyed(left, "a"), keyed(right, "b"), ["tab", "key"])
    return (met.where("id_a < id_b") if self_join else met).select("id_a", "id_b").distinct()


BLOCK_BYTES = 96 << 20
#: Blocks that a row travels to before its copies are dropped again.
ROUND = 8
#: Pairs of places marked at once, and pairs compared at once.
MARKS, PAIRS = 32 << 20, 1 << 17


def _meetings(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows that share a key, each pair once; ``a`` and ``b`` have a row for each table.

    Some rows of ``a`` meet all of ``b`` at a time, in a table of marks, so that the tables in which a pair meets cost a mark each.
    """
    tables, size = b.shape
    order = np.argsort(b, axis=1, kind="stable").astype(np.int32)
    first, count = (np.empty(a.shape, np.int32) for _ in range(2))
    for table in range(tables):
        ordered = b[table, order[table]]
        first[table] = np.searchsorted(ordered, a[table])
        count[table] = np.searchsorted(ordered, a[table], "right") - first[table]
    order, step = order.ravel(), max(1, MARKS // size)
    marks = np.zeros((min(step, a.shape[1]), size), bool)
    for start in range(0, a.shape[1], step):
        table, row = np.nonzero(count[:, start:start + step])
        n = count[table, start + row].astype(np.int64)
        begin, ends = first[table, start + row] + table * size, np.cumsum(n)
        at = 0
        while at < len(n):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            some = n[at:to]
            place = np.repeat(begin[at:to] - (ends[at:to] - some - done), some) + np.arange(ends[to - 1] - done)
            marks[np.repeat(row[at:to], some), order[place]] = True
            at = to
        met = np.flatnonzero(marks.ravel())
        marks.ravel()[met] = False
        for piece in range(0, len(met), PAIRS):
            own, other = np.divmod(met[piece:piece + PAIRS], size)
            yield own + start, other


class _Block:
    """The rows of one block, put together from batches."""

    def __init__(self):
        self.ids, self.n, self.v, self.keys = [], [], [], []

    def add(self, batch: pa.RecordBatch) -> None:
        def values(name: str) -> np.ndarray:
            column = batch.column(name)
            return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

        self.ids.append(batch.column("id"))
        self.n.append(batch.column("n").to_numpy())
        self.v.append(values("v"))
        self.keys.append(values("keys").T)

    def whole(self) -> _Block:
        self.ids, self.n = pa.chunked_array(self.ids).combine_chunks(), np.concatenate(self.n)
        self.v, self.keys = np.concatenate(self.v), np.concatenate(self.keys, axis=1)
        return self


def _near(threshold: float, self_join: bool):
    """Of the rows of two blocks, the pairs closer than ``threshold``; coordinates add up in their order, as in a column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _Block(), _Block()
        for batch in batches:
            on_right = batch.column("side").to_numpy(zero_copy_only=False)
            for side, block in enumerate(sides):
                if (on_right == side).any():
                    block.add(batch.filter(pa.array(on_right == side)))
        if not sides[0].ids or not (self_join or sides[1].ids):
            return
        # a block that meets itself comes once
        a = sides[0].whole()
        b = sides[1].whole() if sides[1].ids else a
        for own, other in _meetings(a.keys, b.keys):
            if a is b:
                own, other = own[own < other], other[own < other]
            gaps = np.ascontiguousarray((a.v[own] - b.v[other]).T)
            total = np.zeros(len(own))
            for gap in gaps:
                total += gap * gap
            distance = np.sqrt(total)
            near = np.flatnonzero(distance < threshold)
            own, other, distance = own[near], other[near], distance[near]
            if not self_join:
                yield _pairs(a, own, b, other, distance)
            elif len(near):
                left, right = a.ids.take(pa.array(own)), b.ids.take(pa.array(other))
                for x, x_at, y, y_at, before in ((a, own, b, other, pc.less(left, right)), (b, other, a, own, pc.less(right, left))):
                    at = np.flatnonzero(pc.fill_null(before, False).to_numpy(zero_copy_only=False))
                    yield _pairs(x, x_at[at], y, y_at[at], distance[at])

    return run


def _pairs(a: _Block, own: np.ndarray, b: _Block, other: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [a.ids.take(pa.array(own)), pa.array(a.n[own]), b.ids.take(pa.array(other)), pa.array(b.n[other]), pa.array(distance)],
        ["id_a", "n_a", "id_b", "n_b", "distance"])


def _grid(rows: Sequence[int], row_bytes: int, cores: int) -> list[int]:
    """Into how many blocks to cut each side; one side only for a join with itself."""
    cuts = [max(1, ceil(n * row_bytes / BLOCK_BYTES)) for n in rows]
    while (cuts[0] * (cuts[0] + 1) // 2 if len(cuts) == 1 else cuts[0] * cuts[1]) < cores:
        larger = max(range(len(rows)), key=lambda side: rows[side] / cuts[side])
        cuts[larger] += 1
    return cuts


def compound_join(
    lsh: CompoundLSH, a: DataFrame, b: DataFrame, row_id: str, vector: str, threshold: float,
    self_join: bool = False,
) -> DataFrame:
    """Pairs that share a key and lie closer than ``threshold``; rows raw or hashed, result as ``similarity_join``.

    Rows are dealt into blocks of ``BLOCK_BYTES`` at most, each pair of blocks meets in one task, and there rows meet by their keys. A row
    travels once for each block it meets and not for each table. Of more than ``ROUND`` blocks some pairs meet at a
    time, their result is stored and what they shuffled let go, so the disk in use grows with the rows.
    """
    spark = a.sparkSession

    def rows(df: DataFrame, tag: str) -> DataFrame:
        hashed = _hashed(lsh.model, df, row_id, vector)
        # half of a key: rows that share one by chance are compared in vain, or found to be near
        keys = F.transform(lsh.keys(F.col("h")), lambda key: F.shiftright(key, 32).cast("int"))
        return stored(hashed.select("id", "n", "v", keys.alias("keys")), f"keys-{tag}")

    left = rows(a, "a")
    right = left if self_join else rows(b, "b")
    sides = [left] if self_join else [left, right]
    size = left.agg(F.max(F.size("v"))).first()[0] or 0
    cuts = _grid([side.count() for side in sides], 8 * size + 4 * lsh.tables + 32, spark.sparkContext.defaultParallelism)
    across, rounds = cuts[-1], ceil(max(cuts) / ROUND)
    block = lambda n: F.pmod(F.xxhash64("v"), F.lit(n)).cast("int")

    def placed(turn: int) -> DataFrame:
        """The rows at each pair of blocks that meets in this turn, numbered ``row * across + column``."""
        def at(row: Column, column: Column, side: Column) -> Column:
            return F.when((row + column) % rounds == turn, F.struct((row * across + column).alias("task"), side.alias("side")))

        def sent(df: DataFrame, n: int, others: int, place) -> DataFrame:
            places = F.filter(F.transform(F.sequence(F.lit(0), F.lit(others - 1)), lambda other: place(block(n), other)), F.isnotnull)
            return df.withColumn("at", F.explode(places)).select("at.task", "at.side", "id", "n", "v", "keys")

        if self_join:
            return sent(left, across, across, lambda own, other: at(
                F.least(own, other), F.greatest(own, other), (own > other).cast("int")))
        return sent(left, cuts[0], across, lambda own, other: at(own, other, F.lit(0))).unionByName(
            sent(right, across, cuts[0], lambda own, other: at(other, own, F.lit(1))))

    kinds = dict(left.dtypes)
    schema = f"id_a {kinds['id']}, n_a bigint, id_b {dict(right.dtypes)['id']}, n_b bigint, distance double"

    def near(turn: int) -> DataFrame:
        # partitions are the pairs of blocks: the work grows with pairs, not bytes
        dealt_out = placed(turn).repartitionById(cuts[0] * across, F.col("task"))
        return dealt_out.mapInArrow(_near(threshold, self_join), schema)

    if rounds == 1:
        found = near(0)
    else:
        parts = []
        for turn in range(rounds):
            parts.append(stored(near(turn), f"near-{turn}"))
            spark.sparkContext._jvm.System.gc()
        found = reduce(DataFrame.union, parts)
    if not self_join:
        return found
    copies = left.where((F.col("n") > 1) & F.lit(threshold > 0)).select(
        F.col("id").alias("id_a"), F.col("n").alias("n_a"), F.col("id").alias("id_b"),
        F.col("n").alias("n_b"), F.lit(0.0).alias("distance"))
    return found.union(copies)


def exact_similarity_join(
    a: DataFrame,
    b: DataFrame,
    row_id_a: str,
    row_id_b: str,
    vector: str,
    threshold: float,
    axes: int = 2,
) -> DataFrame:
    """All pairs closer than ``threshold``, for vectors of few dimensions.

    The first ``axes`` dimensions are cut into cells as wide as the threshold;
    a row meets the rows of its own and the adjoining cells, which holds every
    partner. Result ``(id_a, n_a, id_b, n_b, distance)`` over distinct vectors.
    """
    def keyed(df: DataFrame, row_id: str, tag: str, reach: bool) -> DataFrame:
        rows = distinct_vectors(df, row_id, vector).select(
            F.col("id").alias(f"id_{tag}"), F.col("n").alias(f"n_{tag}"),
            F.col("v").alias(f"v_{tag}"),
        )
        rows = stored(rows, f"distinct-{tag}")
        for axis in range(axes):
            cell = F.floor(F.get(f"v_{tag}", F.lit(axis)) / threshold).cast("bigint")
            around = F.explode(F.sequence(cell - 1, cell + 1)) if reach else cell
            rows = rows.withColumn(f"cell{axis}", around)
        return rows

    left, right = keyed(a, row_id_a, "a", False), keyed(b, row_id_b, "b", True)
    met = _meet(left, right, [f"cell{axis}" for axis in range(axes)])
    distance = F.sqrt(vx.squared_distance(F.col("v_a"), F.col("v_b")))
    return (
        met.withColumn("distance", distance)
        .where(F.col("distance") < threshold)
        .select("id_a", "n_a", "id_b", "n_b", "distance")
    )
