"""Benchmark items in documents, by the CGK embedding and bit-sampling LSH.

The CGK embedding walks over a string of words with random bits: each step puts out the current word and
moves on if the word's bit for that step is set. Strings of small edit distance walk into step
again after an edit, so their walks agree in most places: edit distance becomes Hamming distance. A
repetition samples ``SAMPLED`` steps of a walk of its own; a window that agrees with an item in all of
them is a candidate. Windows begin at every word of every document. Items are entered at every
``STRIDE``-th word, so a stretch that has kept its words is enough wherever it lies. Steps are
compared one after another, and windows that no item agrees with so far are walked no further.

Each candidate is then aligned exactly: a leak is an item with a stretch of the document at a word edit
distance of at most ``EDITS`` of its length. ``REPEATS`` is set so that an item with that many edits is
found with at least 0.95, and one with half as many with 0.999 (see tests); an exact copy always is.

Null texts have no words. Items of fewer than ``LEAST_WORDS`` words are not looked for. The index of the
items goes to the tasks in parts of at most ``INDEX_WORDS`` words; a larger benchmark takes more
than one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from lakeline.llm.words import BLOCK_BYTES, Words, mixed, raw, slices
from lakeline.sources.files import table

EDITS = 0.2
STEPS = 20
SAMPLED = 4
REPEATS = 5
STRIDE = 2
LEAST_WORDS = 5
INDEX_WORDS = 1_000_000

_ANY = np.random.default_rng(104729)
_SEEDS = _ANY.integers(1, 2**63, REPEATS, np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = STEPS // SAMPLED
_AT = np.arange(SAMPLED) * _BLOCK + _ANY.integers(0, _BLOCK, (REPEATS, SAMPLED))
_AT[:, 0] = 0  # every walk begins with its first word, so that is looked up once for all repetitions


class Depth(NamedTuple):
    """Keys after so many samples: those that go on, and those that are complete with their entries."""

    seen: np.ndarray
    filter: np.ndarray
    done: np.ndarray
    entry: np.ndarray


class Index(NamedTuple):
    ids: list[int]
    words: list[np.ndarray]
    item: np.ndarray
    offset: np.ndarray
    depths: list[list[Depth]]


def _walk(words: np.ndarray, ends: np.ndarray, starts: np.ndarray, repeat: int) -> Iterator:
    """At each sampled step: (keys, places, inside) of the walks. Send a choice of walks to keep."""
    at, last, seed = starts, ends, _SEEDS[repeat]
    keys = np.zeros(len(starts), np.uint64)
    step = 0
    for sample in _AT[repeat]:
        while step < sample:
            bit = (words[np.minimum(at, last)] * seed) >> np.uint64(63 - step)
            at = at + (bit & np.uint64(1)).astype(np.int64)
            step += 1
        inside = at <= last
        own = np.where(inside, words[np.minimum(at, last)], np.uint64(0))
        keys = mixed(keys * np.uint64(31) + own + seed) if sample else own
        kept = yield keys, inside
        if kept is not None:
            at, last, keys = at[kept], last[kept], keys[kept]


def _bitmap(keys: np.ndarray) -> np.ndarray:
    found = np.zeros(1 << 16, bool)
    found[(keys >> np.uint64(48)).astype(np.int64)] = True
    return found


def index(ids: list[int], texts: list[bytes]) -> Index:
    """Entries of all items, by repetition and number of samples."""
    hashed = Words(texts)
    words = [hashed.hashes[0][hashed.first[n]:hashed.first[n + 1]] for n in range(len(texts))]
    used = [n for n in range(len(texts)) if len(words[n]) >= LEAST_WORDS]
    ids, words = [ids[n] for n in used], [words[n] for n in used]
    sizes = np.array([len(word) for word in words], np.int64)
    flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    offsets = [np.arange(0, size, STRIDE) for size in sizes.tolist()]
    item = np.repeat(np.arange(len(words)), [len(part) for part in offsets]).astype(np.int64)
    offset = np.concatenate(offsets).astype(np.int64) if offsets else np.zeros(0, np.int64)
    starts, ends = begin[item] + offset, (begin + sizes - 1)[item]
    depths = []
    for repeat in range(REPEATS if len(words) else 0):
        levels, alive = [], np.arange(len(item))
        walk = _walk(flat, ends, starts, repeat)
        keys, inside = next(walk)
        for depth in range(SAMPLED):
            # a walk that has left its item is complete with what it has seen, if it saw it from the start
            out = alive[~inside]
            if depth:
                whole = offset[out] == 0
                previous, gone = levels[-1], before[~inside][whole]
                levels[-1] = (previous[0], np.concatenate((previous[1], gone)),
                              np.concatenate((previous[2], out[whole])))
            alive, before = alive[inside], keys[inside]
            full = depth == SAMPLED - 1
            levels.append((before, before if full else before[:0], alive if full else alive[:0]))
            if not full:
                keys, inside = walk.send(np.flatnonzero(inside))
        made = []
        for keys, done, entry in levels:
            order = np.argsort(done, kind="stable")
            seen = np.unique(keys)
            made.append(Depth(seen, _bitmap(seen), done[order], entry[order]))
        depths.append(made)
    return Index(ids, words, item, offset, depths)


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def candidates(texts: Words, known: Index) -> np.ndarray:
    """Rows of text, item and place where the item would begin, each once."""
    words = texts.hashes[0]
    if not len(words) or not known.words:
        return np.zeros((0, 3), np.int64)
    ends = (texts.first[1:] - 1)[texts.text]
    level = known.depths[0][0]
    begin = np.flatnonzero(level.filter[(words >> np.uint64(48)).astype(np.int64)])
    begin = begin[_among(words[begin], level.seen)]
    found = []
    for repeat, depths in enumerate(known.depths):
        alive = begin
        walk = _walk(words, ends[begin], alive, repeat)
        keys, _ = next(walk)
        for depth, level in enumerate(depths):
            if len(level.done):
                low, high = (np.searchsorted(level.done, keys, side) for side in ("left", "right"))
                hit = np.flatnonzero(high > low)
                for start, first, last in zip(alive[hit].tolist(), low[hit].tolist(), high[hit].tolist()):
                    for entry in level.entry[first:last].tolist():
                        number = int(texts.text[start])
                        place = start - int(texts.first[number]) - int(known.offset[entry])
                        found.append((number, int(known.item[entry]), place))
            if depth == SAMPLED - 1:
                break
            kept = np.arange(len(keys))
            if depth:
                kept = np.flatnonzero(level.filter[(keys >> np.uint64(48)).astype(np.int64)])
                kept = kept[_among(keys[kept], level.seen)]
            if not len(kept):
                break
            alive = alive[kept]
            keys, _ = walk.send(kept)
    return np.unique(np.array(found, np.int64).reshape(-1, 3), axis=0)


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least word edit distance of the item to any stretch of the text, and where that ends."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for number, word in enumerate(item, 1):
        best = np.empty_like(row)
        best[0] = number
        best[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(best - steps) + steps
    end = int(np.argmin(row))
    return int(row[end]), end


def leaks(texts: Words, known: Index) -> list[tuple[int, int, int, int]]:
    """``(text, item, distance, last word)``, the best of each text and item."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    covered: dict[tuple[int, int], int] = {}
    for number, item, place in candidates(texts, known).tolist():
        word = known.words[item]
        most = int(EDITS * len(word))
        pair = number, item
        if pair in best and (best[pair][0] == 0 or place <= covered[pair]):
            continue
        first, count = int(texts.first[number]), int(texts.counts[number])
        text = texts.hashes[0][first:first + count]
        if place >= 0 and np.array_equal(text[place:place + len(word)], word):
            best[pair], covered[pair] = (0, place + len(word)), place
            continue
        low, high = max(0, place - 2 * most), min(count, place + len(word) + 2 * most)
        covered[pair] = place
        if np.isin(word, text[low:high]).sum() < len(word) - most:
            continue  # each edit takes away one word of the item at most
        distance, end = edit_distance(word, text[low:high])
        if distance <= most and (pair not in best or distance < best[pair][0]):
            best[pair] = distance, low + end
    return [(*pair, *value) for pair, value in best.items()]


_LEAKS = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("edit_distance", pa.int64()),
    ("item_words", pa.int64()), ("end_word", pa.int64()),
])


def _searched(known: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                doc_ids = part.column("doc_id").to_pylist()
                rows = [
                    {"doc_id": doc_ids[number], "item_id": known.ids[item], "edit_distance": distance,
                     "item_words": len(known.words[item]), "end_word": end}
                    for number, item, distance, end in leaks(Words(raw(part.column("text"))), known)
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_LEAKS)

    return run


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of parts of ``benchmark (item_id, text)``, none of more than about ``INDEX_WORDS`` words."""
    items = benchmark.selectExpr("CAST(item_id AS bigint) AS item_id", "coalesce(CAST(text AS string), '') AS text")
    words = items.agg(F.sum(F.size(F.split("text", "[ \\t-\\r]+")).cast("bigint"))).first()[0] or 0
    parts = words // INDEX_WORDS + 1
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).distinct().collect()
        yield index([row["item_id"] for row in rows], [row["text"].encode() for row in rows])


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that it holds: ``doc_id, item_id, edit_distance, item_words, end_word``.

    ``end_word`` is the number of words up to the end of the best stretch.
    """
    texts = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text")
    ddl = "doc_id bigint, item_id bigint, edit_distance bigint, item_words bigint, end_word bigint"
    found = [texts.mapInArrow(_searched(known), ddl) for known in _indexes(benchmark)]
    whole = found[0]
    for part in found[1:]:
        whole = whole.union(part)
    return whole


def _leaked(known: Index):
    @F.pandas_udf(BooleanType())
    def leaked(texts: pd.Series) -> pd.Series:
        found = np.zeros(len(texts), bool)
        block, size, first = [], 0, 0
        for number, text in enumerate(texts):
            block.append((text or "").encode())
            size += len(block[-1])
            if size >= BLOCK_BYTES or number == len(texts) - 1:
                for hit, *_ in leaks(Words(block), known):
                    found[first + hit] = True
                block, size, first = [], 0, number + 1
        return pd.Series(found)

    return leaked


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark."""
    for known in _indexes(benchmark):
        docs = docs.where(~_leaked(known)(F.col("text").cast("string")))
    return docs


def op6_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in all documents."""
    return find(table(spark, folder, "documents", "doc_id", "text"),
                table(spark, folder, "benchmark", "item_id", "text"))
