"""Links between near vectors of one label, by binary codes of randomly rotated vectors.

Each vector of length 1 is turned by two random rotations. Its code in each is one sign for every dimension, and
with it goes the correction factor, the inner product of the vector with its code: the code divided by the
factor is an unbiased estimate of the vector. Codes of the two rotations err independently, so the
inner product of the estimate of one vector from the first and of the other from the second is an unbiased
estimate of theirs, with a known spread. Pairs are recomputed from the full vectors, in double precision, unless
the estimate and ``SPREADS`` times its spread stay below ``SIMILARITY``.

Rows with the same label and components are folded first. Pairs are looked for inside buckets: ``tables``
samples of the sign bits, as many bits as leave about ``BUCKET`` vectors of the largest label in a bucket, and
as many samples as find a pair at the threshold with probability ``RECALL``. A label that fits one
bucket takes no bits, and all its pairs are looked at. Larger buckets are cut into blocks that meet two by
two, so no bucket is one task. A pair counts in the first of the samples it shares, which its codes tell.

A bucket says which vectors have a pair to recompute; only their components go to its second look. That
gives each vector its number of links there and one link to the least vector of its part: pairs are never rows.

* Null, empty or zero vectors, those with null or non-finite components and rows without a label link with nothing.
* Vectors of different lengths are never compared. A group of copies links each with all others.
* Rows that repeat an id are vectors of their own; the component is the smallest id that is not null, and a row
  without an id is not kept. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm.graph import components
from lakeline.llm.negatives import usable
from lakeline.operators.joins import lookup_join
from lakeline.session import stored
from lakeline.sources.files import table

SIMILARITY = 0.93
RECALL = 0.995
SPREADS = 1.9
BUCKET = 2048
CUT = 2 * BUCKET
ROWS = 512

_RECORD = "key bigint, sample int, node bigint, code binary"


@cache
def rotations(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two random orthogonal matrices for vectors of ``width``, filled up to whole 64-bit words."""
    size = 64 * -(-width // 64)
    return tuple(np.linalg.qr(np.random.default_rng([seed, size]).normal(size=(size, size)))[0] for seed in (1, 2))


@cache
def sampled_bits(width: int, tables: int, bits: int) -> np.ndarray:
    """A row of 64-bit masks over both codes for each sample."""
    size = 2 * 64 * -(-width // 64)
    pick = np.random.default_rng([3, size, bits])
    marks = np.zeros((tables, size), np.uint8)
    for row in marks:
        row[pick.choice(size, min(bits, size), replace=False)] = 1
    return np.packbits(marks, axis=1, bitorder="little").view(np.uint64)


def shape_of(largest: int, recall: float = RECALL, similarity: float = SIMILARITY) -> tuple[int, int]:
    """Samples and bits in each for ``largest`` vectors of one label."""
    bits = max(0, ceil(log2(max(1, largest) / BUCKET)))
    agree = (1 - acos(similarity) / pi) ** bits
    return (1 if agree == 1 else ceil(log(1 - recall) / log(1 - agree))), bits


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, also where squares of the components would leave the range of a double."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def codes_of(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits in both rotations as 64-bit words, and the correction factor in each."""
    words, factors = [], []
    for rotation in rotations(vectors.shape[1]):
        turned = unit(vectors) @ rotation[:, :vectors.shape[1]].T
        signs = turned >= 0
        words.append(np.packbits(signs, axis=1, bitorder="little").view(np.uint64))
        factors.append(np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1]))
    return np.concatenate(words, axis=1), np.stack(factors, axis=1)


def estimates(words: np.ndarray, factors: np.ndarray) -> list[np.ndarray]:
    """Unbiased estimates of the vectors from each of their two codes."""
    half = words.shape[1] // 2
    found = []
    for number, rotation in enumerate(rotations(64 * half)):
        part = np.ascontiguousarray(words[:, number * half:(number + 1) * half])
        signs = np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").astype(np.float64) * 2 - 1
        found.append(signs @ rotation / (np.sqrt(64 * half) * factors[:, number:number + 1]))
    return found


def uncertain(
    words: np.ndarray, factors: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float = SIMILARITY
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a row of ``left`` and one of ``right`` that may reach ``similarity``, in slices of ``left``."""
    first, second = estimates(words, factors)
    both, turned = np.concatenate([first, second], axis=1), np.concatenate([second, first], axis=1)
    loss = ((1 - factors**2) / factors**2).max(axis=1)
    gain = 1 / (factors**2).min(axis=1)
    for at in range(0, len(left), ROWS):
        part = left[at:at + ROWS]
        estimate = both[part] @ turned[right].T / 2
        spread = np.sqrt((loss[part][:, None] * gain[right] + loss[right]) / max(1, first.shape[1] - 1))
        row, place = np.nonzero(estimate + SPREADS * spread >= similarity)
        yield part[row], right[place]


def first_shared(words: np.ndarray, a: np.ndarray, b: np.ndarray, masks: np.ndarray, sample: int) -> np.ndarray:
    """Whether no sample before ``sample`` has both of each pair in one bucket."""
    fresh = np.ones(len(a), bool)
    apart = words[a] ^ words[b]
    for mask in masks[:sample]:
        fresh &= (apart & mask).any(axis=1)
    return fresh


def _coded(tables: int, bits: int) -> Callable:
    """For ``mapInArrow``: a record for each vector and sample."""
    schema = pa.schema([("key", pa.int64()), ("sample", pa.int32()), ("node", pa.int64()), ("code", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for _, rows in frame.groupby("width"):
                vectors = np.array(rows["vector"].tolist(), np.float64)
                words, factors = codes_of(vectors)
                code = np.concatenate([words.view(np.uint8), factors.astype(np.float32).view(np.uint8)], axis=1)
                code = [row.tobytes() for row in code]
                group = rows["place"].to_numpy(np.int64).view(np.uint64)
                for sample, mask in enumerate(sampled_bits(vectors.shape[1], tables, bits)):
                    key = _mixed(group + np.uint64(sample + 1) * np.uint64(0x9E3779B97F4A7C15))
                    for word in (words & mask).T:
                        key = _mixed(key ^ word)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.view(np.int64)), pa.array(np.full(len(rows), sample, np.int32)),
                        pa.array(rows["node"].to_numpy(np.int64)), pa.array(code, pa.binary())], schema=schema)

    return run


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _pairs(rows: pd.DataFrame, tables: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one pair of blocks that are to be recomputed there, each once."""
    raw = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
    words = np.ascontiguousarray(raw[:, :-8]).view(np.uint64)
    factors = np.ascontiguousarray(raw[:, -8:]).view(np.float32).astype(np.float64)
    masks = sampled_bits(32 * words.shape[1], tables, bits)
    sample, one, other = (int(rows[name].iloc[0]) for name in ("sample", "one", "other"))
    block = rows["block"].to_numpy()
    left, right = np.nonzero(block == one)[0], np.nonzero(block == other)[0]
    for a, b in uncertain(words, factors, left, right):
        if one == other:
            a, b = a[a < b], b[a < b]
        fresh = first_shared(words, a, b, masks, sample)
        yield a[fresh], b[fresh]


def _doubtful(tables: int, bits: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows of a pair of blocks that have a pair to recompute."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        marked = np.zeros(len(rows), bool)
        for a, b in _pairs(rows, tables, bits):
            marked[a] = marked[b] = True
        return rows[marked]

    return run


def _linked(tables: int, bits: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """``node, peer, links`` of a pair of blocks: links counted with copies, and the least node of the part."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node").reset_index(drop=True)
        vectors = unit(np.array(rows["vector"].tolist(), np.float64))
        place, copies = rows["place"].to_numpy(), rows["copies"].to_numpy()
        links, least = np.zeros(len(rows), np.int64), np.arange(len(rows))
        edges = []
        for a, b in _pairs(rows, tables, bits):
            near = np.concatenate([np.zeros(0, bool)] + [
                np.einsum("ij,ij->i", vectors[a[at:at + 65536]], vectors[b[at:at + 65536]]) >= SIMILARITY
                for at in range(0, len(a), 65536)]) & (place[a] == place[b])
            a, b = a[near], b[near]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            edges.append(np.stack([a, b]))
        a, b = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), int)
        while True:
            before = least.copy()
            np.minimum.at(least, a, least[b])
            np.minimum.at(least, b, least[a])
            least = least[least]
            if (least == before).all():
                break
        node = rows["node"].to_numpy()
        return pd.DataFrame({"node": node, "peer": node[least], "links": links})[links > 0]

    return run


def near_links(vectors: DataFrame) -> DataFrame:
    """``node, root, links`` of the vectors that are linked with another one.

    ``vectors`` has ``node`` (unique), ``place`` (label and length as one number), ``width``, ``vector`` and ``copies``.
    It is read several times. ``links`` counts the copies of the other vectors.
    """
    largest = vectors.groupBy("place").count().agg(F.max("count")).first()[0] or 0
    tables, bits = shape_of(largest)
    records = stored(vectors.select("node", "place", "width", "vector").mapInArrow(_coded(tables, bits), _RECORD), "codes")
    crowded = records.groupBy("key").count().where(F.col("count") > CUT).select(
        "key", F.ceil(F.col("count") / BUCKET).cast("int").alias("cuts"))
    cuts = F.coalesce("cuts", F.lit(1))
    cut = records.join(crowded, "key", "left").select(
        *records.columns, cuts.alias("cuts"), F.pmod(F.xxhash64("node"), cuts).cast("int").alias("block"))
    met = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).select(
        *records.columns, "block", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"))
    pair = ["key", "one", "other"]
    doubtful = stored(met.groupBy(pair).applyInPandas(_doubtful(tables, bits), met.schema), "doubtful")
    found = doubtful.join(vectors.select("node", "place", "vector", "copies"), "node").groupBy(pair).applyInPandas(
        _linked(tables, bits), "node bigint, peer bigint, links bigint")
    found = stored(found, "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("node != peer").select(F.col("node").alias("a"), F.col("peer").alias("b")))
    return links.join(roots, "node")


def near_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``rows (vec_id, label, embedding)``."""
    compared = F.col("label").isNotNull() & usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    rows = rows.select("vec_id", "label", "embedding", F.coalesce(compared, F.lit(False)).alias("compared"))
    # 128 bits of label and components
    hashes = [F.xxhash64(F.lit(seed), "label", "embedding") for seed in (1, 2)]
    marked = rows.where("compared").withColumn("mark", F.concat_ws(":", *hashes))
    folded = stored(
        marked.groupBy("mark", "label", "embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .select("mark", "least", "copies", F.monotonically_increasing_id().alias("node"),
                F.xxhash64("label", F.size("embedding")).alias("place"), F.size("embedding").alias("width"),
                F.col("embedding").cast("array<double>").alias("vector")), "vectors")
    linked = stored(near_links(folded), "linked")
    known = folded.select("mark", "least", "copies", "node").join(linked, "node", "left")
    known = stored(known.withColumn("root", F.coalesce("root", "node")), "known")
    least = known.where("links > 0").groupBy("root").agg(F.min("least").alias("component"))
    answers = stored(known.join(least, "root", "left").select(
        "mark", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "least").alias("component_id")), "answers")
    found = lookup_join(marked.select("mark", "vec_id"), answers, "mark", "copies", "vec_id").select(
        "vec_id", "n_links", "component_id")
    alone = rows.where("NOT compared").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all rows of ``embeddings``."""
    return near_vectors(table(spark, folder, "embeddings", "vec_id", "label", "embedding"))
