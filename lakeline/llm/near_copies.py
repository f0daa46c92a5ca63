"""Near copies of documents by Order MinHash and banded alignment.

The k-mers are runs of five words, each labelled with its occurrence number in the text. For each of
``SKETCHES`` hash functions a document keeps its ``KEPT`` smallest labelled k-mers **in text order**;
two documents that agree on one such ordered tuple are candidates. Order MinHash is sensitive to edit
similarity, as moved passages change the order. A candidate pair is a link if a banded alignment of
the two k-mer sequences matches at least ``SIMILARITY`` of the distinct k-mers of both texts.

Documents with equal words are folded first, so a group of copies costs one row. No bucket is written
out as pairs. First each document is aligned with the busiest member of each of its buckets. Buckets
whose members are then in one component are closed. In the others the busiest member of each component stands for it, and
those of up to ``SMALL`` components align these with each other.

Sketches miss some pairs, so an exact join by distinct k-mers follows, over all texts. Each text's k-mers have
one order, by hash, but the most frequent of those in about more than ``COMMON`` texts come last, the rarer of them first. Two
sets of the similarity must share k-mers among the first fifth, and early enough that what either has left can suffice. Only texts
in different components meet, and the pairs that may reach the similarity are aligned too: no link between components is lost.
Before their texts travel, pairs are compared by outlines, counts of k-mers in ``BINS`` bins, which bound from above what two texts share.

Text of fewer than five words is one k-mer. A document without any word (null, empty, white space)
is a class of its own. Rows that share doc_id and words are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from lakeline.llm.graph import components
from lakeline.llm.words import Words, mixed, raw, slices
from lakeline.operators.tables import unused
from lakeline.session import Scratch, small_batches, stored
from lakeline.sources.files import table

WORDS = 5
SIMILARITY = 0.8
KEPT = 5
SKETCHES = 24
SMALL = 64
#: Text hashed at a time; the arrays are a few dozen times as large.
BLOCK_BYTES = 1 << 18
#: A k-mer in more texts than this comes last in the order, if it is one of the ``LATE`` most frequent.
COMMON = 32
LATE = 1 << 16
#: K-mers are counted in one of so many texts.
COUNTED = 8
#: Bins of an outline, a byte each.
BINS = 256

_SEEDS = np.random.default_rng(7919).integers(1, 2**63, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of five words; a shorter text is one run."""
    count = max(1, len(words) - WORDS + 1) if len(words) else 0
    total = np.zeros(count, np.uint64)
    for step in range(min(WORDS, len(words))):
        total += words[step:step + count] * np.uint64(2 * 1000003 ** (step + 1) % 2**61 + 1)
    return mixed(total)


def labelled(runs: np.ndarray) -> np.ndarray:
    """Each run with its occurrence number worked in, so that all are different."""
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(runs)), 0))
    number = np.empty(len(runs), np.uint64)
    number[order] = (np.arange(len(runs)) - begin).astype(np.uint64)
    return mixed(runs + number * np.uint64(0x9E3779B97F4A7C15))


def sketch(words: np.ndarray) -> np.ndarray:
    """Order MinHash of a text: one key for each hash function."""
    marks = labelled(shingles(words))
    kept = min(KEPT, len(marks))
    scores = marks[None, :] * _SEEDS[:, None]
    if kept < len(marks):
        least = np.sort(np.argpartition(scores, kept - 1, axis=1)[:, :kept], axis=1)
    else:
        least = np.broadcast_to(np.arange(kept), (SKETCHES, kept))
    keys = np.arange(1, SKETCHES + 1, dtype=np.uint64)
    for place in range(kept):
        keys = mixed(keys * np.uint64(31) + marks[least[:, place]])
    return keys


def aligned_share(left: np.ndarray, right: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Share of distinct k-mers of both texts that a banded alignment matches.

    Matches join equal labelled k-mers whose places differ by no more than the band, which is as
    wide as the most k-mers that one text may have alone at ``similarity``. The alignment
    is the longest chain of matches that runs forward in both texts.
    """
    runs_a, runs_b = shingles(left), shingles(right)
    sure = 2 * similarity / (1 + similarity)
    band = int((1 - sure / 2) * max(len(runs_a), len(runs_b))) + WORDS
    distinct_a, distinct_b = len(np.unique(runs_a)), len(np.unique(runs_b))
    if min(distinct_a, distinct_b) < similarity * max(distinct_a, distinct_b):
        return 0.0
    _, at_a, at_b = np.intersect1d(labelled(runs_a), labelled(runs_b), True, return_indices=True)
    near = np.abs(at_a - at_b) <= band
    at_a, at_b = at_a[near], at_b[near]
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    if np.any(np.diff(at_b) < 0):
        at_a = at_a[longest_rise(at_b)]
    matched = len(np.unique(runs_a[at_a]))
    return matched / max(1, distinct_a + distinct_b - matched)


def longest_rise(values: np.ndarray) -> np.ndarray:
    """Places of a longest increasing subsequence of different values."""
    from bisect import bisect_left

    tails: list[int] = []
    places: list[int] = []
    before = np.full(len(values), -1, np.int64)
    for place, value in enumerate(values.tolist()):
        at = bisect_left(tails, value)
        if at == len(tails):
            tails.append(value)
            places.append(place)
        else:
            tails[at] = value
            places[at] = place
        before[place] = places[at - 1] if at else -1
    chain, place = [], places[-1]
    while place >= 0:
        chain.append(place)
        place = before[place]
    return np.array(chain[::-1], np.int64)


def _narrow(words: np.ndarray) -> bytes:
    """Three bytes of each word's hash: enough to tell the words of two texts apart in runs of five."""
    return (words >> np.uint64(40)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def outline(words: np.ndarray) -> np.ndarray:
    """How many distinct k-mers fall in each of ``BINS`` bins; 255 stands for any larger number too."""
    bins = np.unique(shingles(words)) % np.uint64(BINS)
    return np.minimum(np.bincount(bins.astype(np.int64), minlength=BINS), 255).astype(np.uint8)


def may_reach(left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """For each pair of outlines: can the texts share enough k-mers? No pair that ``aligned_share`` finds similar is denied.

    Two texts share at most the lesser count of each bin. Sizes from counts cut at 255 are too small, which lets more through.
    """
    shared = np.minimum(left, right).sum(1, dtype=np.int64)
    sizes = left.sum(1, dtype=np.int64) + right.sum(1, dtype=np.int64)
    unknown = ((left == 255) & (right == 255)).any(1)
    return unknown | (shared >= sizes * similarity / (1 + similarity) - 1e-9)


_PRINTS = pa.schema([
    ("doc_id", pa.int64()), ("node", pa.binary()), ("seq", pa.binary()), ("outline", pa.binary()),
    ("keys", pa.list_(pa.int64())),
])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", BLOCK_BYTES):
            texts = Words(raw(part.column("text")), seeds=2)
            whole = np.stack([texts.whole(0), texts.whole(1)], 1)
            rows: list[list] = [[], [], [], [], []]
            for row, doc_id in enumerate(part.column("doc_id").to_pylist()):
                first, last = texts.first[row], texts.first[row + 1]
                words = texts.hashes[0][first:last]
                rows[0].append(doc_id)
                rows[1].append(whole[row].tobytes())
                seq = _narrow(words)
                rows[2].append(seq)
                # of the words that an alignment reads
                rows[3].append(outline(_wide(seq)).tobytes())
                rows[4].append(sketch(words).view(np.int64) if len(words) else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind.type) for column, kind in zip(rows, _PRINTS)], schema=_PRINTS)


def _wide(seq: bytes) -> np.ndarray:
    parts = np.frombuffer(seq, np.uint8).reshape(-1, 3).astype(np.uint64)
    return mixed(parts[:, 0] | parts[:, 1] << np.uint64(8) | parts[:, 2] << np.uint64(16))


_LINKED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])


def _aligned(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # read in place: a batch of pairs holds two texts a row
            linked = [aligned_share(_wide(a.as_buffer()), _wide(b.as_buffer()), similarity) >= similarity
                      for a, b in zip(batch.column("seq_a"), batch.column("seq_b"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], schema=_LINKED)

    return run


def _promising(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, BINS)
                           for name in ("outline_a", "outline_b"))
            yield batch.select(["a", "b"]).filter(pa.array(may_reach(left, right, similarity)))

    return run


def promising(pairs: DataFrame, outlines: DataFrame, similarity: float) -> DataFrame:
    """``pairs (a, b)`` without those whose outlines show that they do not reach ``similarity``."""
    left = pairs.join(outlines.toDF("a", "outline_a"), "a")
    both = left.join(outlines.toDF("b", "outline_b"), "b")
    return both.select("a", "b", "outline_a", "outline_b").mapInArrow(_promising(similarity), "a bigint, b bigint")


def verified(pairs: DataFrame, seqs: DataFrame, similarity: float) -> DataFrame:
    """``pairs (a, b)`` with ``linked``: does the alignment reach ``similarity``?"""
    left = pairs.join(seqs.toDF("a", "seq_a"), "a")
    both = left.join(seqs.toDF("b", "seq_b"), "b")
    return both.select("a", "b", "seq_a", "seq_b").mapInArrow(
        _aligned(similarity), "a bigint, b bigint, linked boolean")


@F.pandas_udf(BinaryType())
def _node(texts):
    import pandas as pd

    found = []
    for text in texts:
        words = Words([(text or "").encode()], seeds=2)
        whole = np.stack([words.whole(0), words.whole(1)], 1)
        found.append(whole[0].tobytes() if words.counts[0] else None)
    return pd.Series(found, dtype=object)


def _ordered(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def standing(members: DataFrame, links: DataFrame) -> DataFrame:
    """``key, root, node, n``: who stands for each component in the buckets that hold several.

    ``node`` is the component's busiest member there and ``n`` the components of the bucket.
    """
    placed = members.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    standing = placed.groupBy("key", "root").agg(F.max(F.struct("degree", "node")).alias("top"))
    open_buckets = standing.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return standing.join(open_buckets, "key").select("key", "root", F.col("top.node").alias("node"), "n")


def shared_keys(keyed: DataFrame) -> DataFrame:
    """``node, key, degree`` of the buckets of several texts; the degree adds up the buckets of a text."""
    slots = keyed.select("node", F.explode("keys").alias("key"))
    shared = slots.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    degree = F.sum("n").over(Window.partitionBy("node"))
    return slots.join(shared, "key").select("node", "key", degree.alias("degree"))


def linked_texts(
    keyed: DataFrame, texts_of: Callable[[DataFrame, str], DataFrame], seqs: DataFrame, nodes: DataFrame,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``a, b`` links between different texts that hold each component together.

    ``keyed (node, keys)`` has one row for each text; no two hash functions share a key. ``texts_of`` gives
    ``node`` and a column, ``seq`` or ``outline``, for the nodes of a table. ``seqs (mark, seq)`` holds all texts, copies too, and ``nodes (mark, node)``
    one row for each text: the exact join goes by marks, so that no text is shuffled for it.
    """
    scratch = Scratch(keyed.sparkSession, "links")
    members = scratch.keep(shared_keys(keyed), "members")
    leader = F.max(F.struct("degree", "node")).getField("node").alias("leader")
    pairs = members.join(members.groupBy("key").agg(leader), "key").where("node <> leader")
    own = scratch.keep(texts_of(members.select("node").distinct(), "seq"), "seqs")
    tried = scratch.keep(verified(pairs.select(*_ordered("node", "leader")).distinct(), own, similarity), "tried")
    links = tried.where("linked").select("a", "b")

    few = scratch.keep(standing(members, links).where(F.col("n") <= SMALL), "standing")
    one, other = (few.select("key", F.col("node").alias(name)) for name in ("one", "other"))
    crossed = one.join(other, "key").where("one < other").select(*_ordered("one", "other")).distinct()
    fresh = crossed.join(tried.select("a", "b"), ["a", "b"], "left_anti")
    more = scratch.keep(verified(fresh, own, similarity), "more")
    scratch.drop("members", "seqs", "standing")

    tried, links = tried.union(more), links.union(more.where("linked").select("a", "b"))
    placed = nodes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = rare_runs(seqs, scratch.keep(placed, "placed"), similarity, scratch)
    met = scratch.keep(sharing(first, similarity).join(tried.select("a", "b"), ["a", "b"], "left_anti"), "met")
    rest = scratch.keep(promising(met, scratch.keep(texts_of(_ends(met), "outline"), "outlines"), similarity), "rest")
    last = scratch.keep(verified(rest, scratch.keep(texts_of(_ends(rest), "seq"), "wanted"), similarity), "last")
    scratch.drop("placed", "first", "met", "outlines", "rest", "wanted")
    return links.union(last.where("linked").select("a", "b"))


def _ends(pairs: DataFrame) -> DataFrame:
    """The different nodes of ``pairs (a, b)``."""
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


_RUNS = pa.schema([("mark", pa.int64()), ("run", pa.int64()), ("size", pa.int32()), ("left", pa.int32())])


def first_runs(runs: np.ndarray, similarity: float, common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Of a text's distinct k-mers, sorted, those of which two texts of the similarity share at least one.

    Those of the sorted ``common`` come last, by their ``ranks``.
    """
    if len(common):
        at = np.minimum(np.searchsorted(common, runs), len(common) - 1)
        late = common[at] == runs
        ranked = runs[late][np.argsort(ranks[at[late]])]
        runs = np.concatenate((runs[~late], ranked))
    return runs[:len(runs) - ceil(len(runs) * similarity - 1e-9) + 1]


def _first_runs(similarity: float, common: np.ndarray, ranks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "seq", BLOCK_BYTES):
                runs = [np.unique(shingles(_wide(seq.as_buffer()))).view(np.int64) for seq in part.column("seq")]
                found = [first_runs(own, similarity, common, ranks) for own in runs]
                counts = [len(own) for own in found]
                left = [np.arange(len(own), len(own) - count, -1) for own, count in zip(runs, counts)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(part.column("mark").to_numpy(), counts)), pa.array(np.concatenate(found)),
                    pa.array(np.repeat([len(own) for own in runs], counts), pa.int32()),
                    pa.array(np.concatenate(left), pa.int32())], schema=_RUNS)

    return run


def _all_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "seq", BLOCK_BYTES):
            runs = [np.unique(shingles(_wide(seq.as_buffer()))).view(np.int64) for seq in part.column("seq")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(runs))], ["run"])


def common_runs(seqs: DataFrame) -> list[int]:
    """The most frequent k-mers, the least frequent of them first; at most ``LATE`` reach the driver.

    They are counted in every ``COUNTED``-th text. That decides on an order alone, and any order gives the same links.
    """
    some = seqs.where(F.pmod("mark", F.lit(COUNTED)) == 0).select("mark", "seq").dropDuplicates(["mark"])
    often = some.select("seq").mapInArrow(_all_runs, "run bigint").groupBy("run").agg(F.count(F.lit(1)).alias("often"))
    most = often.where(F.col("often") * COUNTED > COMMON).orderBy(F.desc("often"), "run").limit(LATE).select("run").collect()
    return [row.run for row in most][::-1]


def rare_runs(seqs: DataFrame, placed: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """``run, node, root, size, left, main``: the first k-mers of each text that texts of several roots have among theirs.

    ``seqs (mark, seq)``, ``placed (mark, node, root)``; ``main`` is the root of most of a k-mer's texts and ``left`` the number
    of the text's k-mers from this one on. The order of k-mers is the same for all texts, which makes the join exact,
    whichever come last.
    """
    common = np.array(common_runs(seqs), np.int64)
    ranks = np.argsort(common)
    rows = seqs.select("mark", "seq").mapInArrow(
        _first_runs(similarity, common[ranks], ranks), "mark bigint, run bigint, size int, left int")
    kept = scratch.keep(_shared(rows).join(placed, "mark").select("run", "node", "root", "size", "left"), "kept")
    roots = kept.groupBy("run", "root").agg(F.count(F.lit(1)).alias("n"))
    several = roots.groupBy("run").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("n", "root")).getField("root").alias("main")).where("n > 1")
    first = scratch.keep(kept.join(several.select("run", "main"), "run"), "first")
    scratch.drop("kept")
    return first


def _shared(rows: DataFrame) -> DataFrame:
    """The different ``rows (mark, run, size, left)`` whose run several marks have."""
    by_run = rows.repartition("run").dropDuplicates(["run", "mark"])
    return by_run.withColumn("often", F.count(F.lit(1)).over(Window.partitionBy("run"))).where("often > 1").drop("often")


def meeting(first: DataFrame, similarity: float) -> DataFrame:
    """``one, other`` for each k-mer at which two texts in different roots meet that can reach the similarity.

    ``first`` is that of ``rare_runs``. A pair shares at most the k-mers that either text has left from the first shared one on,
    and fewer from each later one, so it meets only at k-mers from which both have enough left. With the frequent k-mers last,
    those are rare ones, unless the texts are nearly equal. At each k-mer texts outside the main root meet all others, so that
    pairs within that root are never made.
    """
    one, other = (first.select(
        "run", F.col("node").alias(name), F.col("root").alias(f"root_{name}"), F.col("size").alias(f"size_{name}"),
        F.col("left").alias(f"left_{name}"), (F.col("root") != F.col("main")).alias(f"seeks_{name}"))
        for name in ("one", "other"))
    apart = (F.col("root_one") != F.col("root_other")) & (~F.col("seeks_other") | (F.col("one") < F.col("other")))
    least = (F.col("size_one") + F.col("size_other")) * similarity / (1 + similarity) - 1e-9
    met = one.where("seeks_one").join(other, "run").where(apart & (F.least("left_one", "left_other") >= least))
    return met.select("one", "other")


def sharing(first: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: the different pairs of ``meeting``; one of a pair may seek at one k-mer and the other at another."""
    return meeting(first, similarity).select(*_ordered("one", "other")).distinct()


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, node, class_id, class_node`` of each row of ``docs (doc_id, text)``.

    ``class_id`` is the smallest doc_id of the class and ``node`` stands for a text's words. A class
    has one text, ``class_node``, whose smallest doc_id is the class id.
    """
    small_batches(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = ids.mapInArrow(_prints, "doc_id bigint, node binary, seq binary, outline binary, keys array<bigint>")
    prints = stored(found.withColumn("row", F.monotonically_increasing_id()), "prints")
    worded = prints.where(F.col("keys").isNotNull())
    # a text goes by the number of one of its rows
    texts = stored(worded.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("number")), "texts")

    def of_texts(wanted: DataFrame, column: str) -> DataFrame:
        """``node, column`` of each text of ``wanted (number)``."""
        return worded.join(wanted, worded["row"] == wanted["number"]).select(F.col("number").alias("node"), column)

    def texts_of(members: DataFrame, column: str) -> DataFrame:
        # stored, so that Spark knows its size: the texts are shuffled only if very many are asked for
        return of_texts(stored(members.toDF("number"), "wanted"), column)

    mark = F.xxhash64("node").alias("mark")
    roots = components(linked_texts(
        of_texts(texts.select("number"), "keys"), texts_of, worded.select(mark, "seq"),
        texts.select(mark, F.col("number").alias("node")), similarity))
    placed = texts.join(
        roots.select(F.col("node").alias("number"), "root"), "number", "left").withColumn("root", F.coalesce("root", "number"))
    first = F.min(F.struct("doc_id", "node"))
    named = placed.groupBy("root").agg(first.alias("first")).select(
        "root", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("class_node"))
    known = placed.join(named, "root").select("node", "class_id", "class_node")
    rows = prints.select("doc_id", "node", F.col("keys").isNull().alias("wordless")).join(known, "node", "left")
    return rows.select(
        "doc_id", "node", F.when(F.col("wordless"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_node", "node").alias("class_node"), "wordless",
    )


def op4_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each document: its class, and whether it is the one that stays."""
    found = classes(table(spark, folder, "documents", "doc_id", "text"))
    kept = F.col("wordless") | ((F.col("doc_id") == F.col("class_id")) & (F.col("node") == F.col("class_node")))
    return found.select("doc_id", "class_id", kept.alias("kept"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without all but one document of each class; wordless documents stay.

    Of rows that share doc_id and words, any one stays. A null doc_id counts as the smallest.
    """
    found = classes(docs, similarity)
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("class_node"))
    own = [unused(docs, name) for name in ("id", "node", "rows")]
    stay = stored(found.where(~F.col("wordless") & stays).groupBy(
        F.col("doc_id").alias(own[0]), F.col("node").alias(own[1])).agg(F.count(F.lit(1)).alias(own[2])), "stay")
    marked = docs.withColumn(own[1], _node("text"))
    near = marked["doc_id"].eqNullSafe(stay[own[0]]) & (marked[own[1]] == stay[own[1]])
    kept = marked.join(stay, near, "left").where(marked[own[1]].isNull() | (stay[own[2]] == 1)).select(
        *(marked[name] for name in docs.columns))
    several = stay.where(F.col(own[2]) > 1)
    if several.isEmpty():
        return kept
    # whole rows are shuffled once more only where some share doc_id and words
    near = marked["doc_id"].eqNullSafe(several[own[0]]) & (marked[own[1]] == several[own[1]])
    return kept.union(marked.join(several, near, "left_semi").dropDuplicates(["doc_id", own[1]]).select(*docs.columns))
