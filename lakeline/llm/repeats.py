"""Repeated passages of twenty words, found by difference-cover anchors.

Windows of ``ANCHOR`` words are hashed only at places that lie, modulo ``PERIOD``, in ``COVER``. Any two
places are both moved into the cover by some shift below the period, so two equal passages of
``WINDOW`` words share an anchor at the same distance from their starts. Anchors that
occur once in the corpus are dropped; around the others the full windows are hashed, and each window whose words also start earlier removes its words.

Rows travel as blocks of numbers, dealt by hash into as many buckets as the texts need, so a task
holds one bucket at a time. Anchors carry 32 bits beside their bucket: a chance agreement only costs a few
windows more, and those are compared by 96 bits beside theirs. A part of the input (``PART`` anchors) sends each different hash once,
with its first place; the other places in the part are settled on the spot. A passage
that a third of all documents share thus costs one number per part. Texts are shuffled by document
once; the same exchange serves both times that places found meet their texts.

Null text has no words; a null doc_id counts as the smallest. Of rows that share a doc_id none is
earlier than the other at an equal place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm.words import Words, raw, slices
from lakeline.sources.files import table

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
PART = 1 << 20
BUCKET_BYTES = 64 << 20
NO_ID = -(2**63)
SEEK, FOUND = 0, 1

_COVERED = np.isin(np.arange(PERIOD), COVER)
_BLOCKS = pa.schema([
    ("bucket", pa.int32()), ("kind", pa.int32()), ("key", pa.binary()), ("other", pa.binary()),
    ("doc", pa.binary()), ("mark", pa.binary()), ("place", pa.binary()),
])
BLOCKS = "bucket int, kind int, key binary, other binary, doc binary, mark binary, place binary"
_TYPES = {"key": np.uint64, "other": np.uint32, "doc": np.int64, "mark": np.int32, "place": np.int32}
Places = dict[str, np.ndarray]


def _joined(parts: list[Places]) -> Places:
    return {name: np.concatenate([part[name] for part in parts]) for name in parts[0]}


def _bucket(doc_id: Column, buckets: int) -> Column:
    """The bucket of a document, as ``_by_doc`` computes it."""
    return F.pmod(doc_id.bitwiseXOR(F.shiftright(doc_id, 17)), F.lit(buckets)).cast("int")


def _by_doc(rows: Places, buckets: int) -> np.ndarray:
    return (rows["doc"] ^ (rows["doc"] >> 17)) % buckets


def _dealt(rows: Places, kind: int, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows as one block for each bucket that has any."""
    order = np.argsort(bucket, kind="stable")
    used, starts = np.unique(bucket[order], return_index=True)
    if not len(used):
        return
    columns: dict[str, list] = {name: [] for name in _BLOCKS.names}
    for number, part in zip(used.tolist(), np.split(order, starts[1:])):
        columns["bucket"].append(number)
        columns["kind"].append(kind)
        for name in _TYPES:
            columns[name].append(rows[name][part].astype(_TYPES[name]).tobytes() if name in rows else None)
    yield pa.RecordBatch.from_pydict(columns, schema=_BLOCKS)


def _found(rows: Places, done: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    found = {name: values[done] for name, values in rows.items() if name not in ("key", "other")}
    yield from _dealt(found, FOUND, _by_doc(found, buckets))


def _block(row: dict) -> Places:
    return {name: np.frombuffer(row[name], kind) for name, kind in _TYPES.items() if row.get(name) is not None}


def _fresh(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Where, in an order, a key differs from the one before."""
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = np.any([key[order][1:] != key[order][:-1] for key in keys], axis=0)
    return fresh


def _repeated(rows: Places) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors occur twice or more, and one of each different one."""
    key = rows["key"] if "key" in rows else rows["other"]
    order = np.argsort(key, kind="stable")
    start = np.flatnonzero(_fresh(order, key))
    sizes = np.diff(np.append(start, len(order)))
    twice = np.empty(len(order), bool)
    twice[order] = np.repeat(sizes > 1, sizes)
    return twice, order[start]


def _later(rows: Places) -> tuple[np.ndarray, np.ndarray]:
    """Which windows also start earlier, and the different earliest ones."""
    key, other, doc, place, mark = (rows[name] for name in ("key", "other", "doc", "place", "mark"))
    order = np.lexsort((mark, place, doc, other, key))
    fresh = _fresh(order, key, other)
    least = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    after = (doc[order] != doc[least]) | (place[order] != place[least])
    first = order[~after & _fresh(order, key, other, doc, place, mark)]
    done = np.empty(len(order), bool)
    done[order] = after
    return done, first


def _anchors(texts: Words, doc_ids: np.ndarray) -> Places:
    at = np.flatnonzero(_COVERED[texts.place % PERIOD] & (texts.left >= ANCHOR))
    return {"key": texts.windows(ANCHOR)[at], "doc": doc_ids[texts.text[at]],
            "place": texts.place[at].astype(np.int32)}


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(False)


def _settled(rows: Places, decide: Callable, buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of one part: places decided within it, and one place of each hash to seek elsewhere."""
    done, first = decide(rows)
    yield from _found(rows, done, buckets)
    seek = {name: values[first] for name, values in rows.items()}
    bucket = ((seek["key"] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    if "other" not in seek:
        seek["other"] = (seek.pop("key") & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    yield from _dealt(seek, SEEK, bucket)


def _seek_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                parts.append(_anchors(Words(raw(part.column("text"))), _ids(part.column("doc_id"))))
                held += len(parts[-1]["key"])
                if held >= PART:
                    yield from _settled(_joined(parts), _repeated, buckets)
                    parts, held = [], 0
        if parts:
            yield from _settled(_joined(parts), _repeated, buckets)

    return run


def _buckets(batches: Iterator[pa.RecordBatch], measured: str) -> Iterator[tuple[int, Iterator[dict]]]:
    """Rows of each bucket in turn; the input is sorted by bucket."""
    rows = (row for batch in batches for part in slices(batch, measured) for row in part.to_pylist())
    return groupby(rows, key=lambda row: row["bucket"])


def _decide(decide: Callable, buckets: int):
    """Decide the places of each bucket's hashes; what is found already passes through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: list[dict] = []
        for _, rows in _buckets(batches, "doc"):
            parts = []
            for row in rows:
                if row["kind"] == SEEK:
                    parts.append(_block(row))
                else:
                    passed.append(row)
            if parts:
                block = _joined(parts)
                yield from _found(block, decide(block)[0], buckets)
            if len(passed) > 100:
                yield pa.RecordBatch.from_pylist(passed, schema=_BLOCKS)
                passed = []
        if passed:
            yield pa.RecordBatch.from_pylist(passed, schema=_BLOCKS)

    return run


def _meet(blocks: pa.Table, texts: pa.Table) -> Iterator[tuple[dict, np.ndarray]]:
    """Each document of a bucket with the places found in it. Marks in blocks must be the text's own."""
    parts = [_block(row) for row in blocks.to_pylist()]
    ready = _joined(parts) if parts else {"doc": np.zeros(0, np.int64), "place": np.zeros(0, np.int32)}
    order = np.argsort(ready["doc"], kind="stable")
    ready = {name: values[order] for name, values in ready.items()}
    for row in (row for batch in texts.to_batches() for part in slices(batch, "text") for row in part.to_pylist()):
        low, high = (np.searchsorted(ready["doc"], row["key"], side) for side in ("left", "right"))
        places = ready["place"][low:high]
        if "mark" in ready:
            places = places[ready["mark"][low:high] == row["text_mark"]]
        yield row, places


def _spread(found: np.ndarray, size: int, width: int) -> np.ndarray:
    """Which of ``size`` places lie in ``found[i]:found[i] + width`` for some i."""
    steps = np.zeros(size + width + 1, np.int64)
    np.add.at(steps, found, 1)
    np.add.at(steps, found + width, -1)
    return np.cumsum(steps)[:size] > 0


def _seek_windows(buckets: int):
    """Windows around the repeated anchors of each document."""
    def windows(held: list[tuple[dict, np.ndarray]]) -> Places | None:
        texts = Words([(row["text"] or "").encode() for row, _ in held], seeds=2)
        near = []
        for number, (_, anchors) in enumerate(held):
            size = int(texts.counts[number]) - WINDOW + 1
            if size > 0:
                # windows that begin up to a period before an anchor; another text of the same id
                # may have some further on
                anchors = anchors[anchors < size + PERIOD - 1]
                reach = _spread(anchors.astype(np.int64), size + PERIOD, 1)
                steps = np.cumsum(np.concatenate(([0], reach)))
                wide = steps[PERIOD:PERIOD + size] - steps[:size]
                near.append(texts.first[number] + np.flatnonzero(wide > 0))
        if not near:
            return None
        at = np.concatenate(near)
        owner = texts.text[at]
        return {
            "key": texts.windows(WINDOW, 0)[at], "other": (texts.windows(WINDOW, 1)[at] >> np.uint64(32)).astype(np.uint32),
            "doc": np.array([row["key"] for row, _ in held], np.int64)[owner],
            "mark": np.array([row["text_mark"] for row, _ in held], np.int32)[owner],
            "place": texts.place[at].astype(np.int32),
        }

    def run(blocks: pa.Table, texts: pa.Table) -> pa.Table:
        parts, held, size = [], [], 0
        for row, anchors in _meet(blocks, texts):
            if not len(anchors):
                continue
            held.append((row, anchors))
            size += len(row["text"] or "")
            if size >= 1 << 20:
                parts.append(windows(held))
                held, size = [], 0
        if held:
            parts.append(windows(held))
        parts = [part for part in parts if part is not None]
        found = _settled(_joined(parts), _later, buckets) if parts else []
        return pa.Table.from_batches(found, schema=_BLOCKS)

    return run


_KEPT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
])
_DIGESTS = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
])


def _cut(digests: bool):
    def run(blocks: pa.Table, texts: pa.Table) -> pa.Table:
        done: list[tuple] = []
        for row, starts in _meet(blocks, texts):
            words = (row["text"] or "").encode().split()
            gone = _spread(starts.astype(np.int64), len(words), WINDOW) if len(starts) else None
            kept = words if gone is None else [word for word, out in zip(words, gone.tolist()) if not out]
            text = b" ".join(kept)
            done.append((row["doc_id"], len(words), len(words) - len(kept),
                         hashlib.sha256(text).hexdigest() if digests else text.decode()))
        schema = _DIGESTS if digests else _KEPT
        columns = zip(*done) if done else [[] for _ in schema]
        return pa.Table.from_arrays([pa.array(values, kind.type) for values, kind in zip(columns, schema)], schema=schema)

    return run


def without_repeats(docs: DataFrame, digests: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed`` and ``kept`` (or ``kept_sha256``) of ``docs (doc_id, text)``."""
    texts = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text")
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    default = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(default, size // BUCKET_BYTES + 1)
    key = F.coalesce("doc_id", F.lit(NO_ID))
    dealt = texts.select("doc_id", "text", key.alias("key"), F.hash("text").alias("text_mark"),
                         _bucket(key, buckets).alias("bucket")).groupBy("bucket")

    def decided(blocks: DataFrame, decide: Callable) -> DataFrame:
        placed = blocks.repartition(default, "bucket").sortWithinPartitions("bucket")
        return placed.mapInArrow(_decide(decide, buckets), BLOCKS)

    anchors = texts.mapInArrow(_seek_anchors(buckets), BLOCKS)
    repeated = decided(anchors, _repeated).groupBy("bucket")
    windows = repeated.cogroup(dealt).applyInArrow(_seek_windows(buckets), BLOCKS)
    starts = decided(windows, _later).groupBy("bucket")
    last = "kept_sha256 string" if digests else "kept string"
    return starts.cogroup(dealt).applyInArrow(_cut(digests), f"doc_id bigint, n_words bigint, n_removed bigint, {last}")


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without repeated passages."""
    return without_repeats(table(spark, folder, "documents", "doc_id", "text"), digests=True)


OP9_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
numbered AS (
    SELECT doc_id, unnest(range(len(w) - 19)) AS place, w FROM words WHERE len(w) >= 20),
windows AS (
    SELECT doc_id, place, md5(array_to_string(w[place + 1:place + 20], ' ')) AS key FROM numbered),
marked AS (
    SELECT doc_id, place, row_number() OVER (PARTITION BY key ORDER BY doc_id, place) > 1 AS later FROM windows),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS place FROM marked WHERE later),
rows AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS place FROM words),
kept AS (
    SELECT r.doc_id, count(g.place) AS n_removed,
           string_agg(r.word, ' ' ORDER BY r.place) FILTER (WHERE g.place IS NULL) AS text
    FROM rows r LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.place = g.place GROUP BY r.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""
