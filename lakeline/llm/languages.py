"""Language of a text by a string kernel.

The kernel of two texts is the number of different byte n-grams (n = 1 to 3, lower case) that both have,
the blended spectrum by presence, over the root of the product of their own numbers. Landmarks, a few
texts of each language, give a Nyström map: kernel values with the landmarks, times the inverse root
of the landmarks' own kernel. On it a ridge regression for each language is fitted against the rest. Whole
batches of texts are scored by matrix products: presence by landmarks, then by languages. N-grams that
no landmark has count for nothing.

Learned from at most ``EXAMPLES`` texts of each language, one of least hash in each of as many hash
buckets, of which the first ``LANDMARKS`` are landmarks. Documents whose crc32(doc_id) mod 4 is 2, and those
without id or language, are never learned from. A null text, and one without a letter, is ``und`` with
score 0, as is every text if nothing could be learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm.words import slices
from lakeline.sources.files import table

EXAMPLES = 192
LANDMARKS = 24
RIDGE = 1e-3
ORDERS = (1, 2, 3)
ROWS = 64
PIECE = 1 << 20
UNKNOWN = "und"


def _codes(text: str) -> Iterator[np.ndarray]:
    """N-gram codes of a text, piece by piece: two bits of order above three bytes."""
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    for start in range(0, len(data), PIECE):
        part = data[start:start + PIECE + max(ORDERS) - 1]
        for order in ORDERS:
            code = np.full(max(0, len(part) - order + 1), order << 24, np.uint32)
            for step in range(order):
                code |= part[step:len(part) - order + 1 + step] << np.uint32(8 * step)
            yield code


def _present(text: str) -> np.ndarray:
    parts = [np.unique(codes) for codes in _codes(text)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)


class Model(NamedTuple):
    """Known n-grams, which landmark has which (packed bits), and weights of each language."""

    languages: list[str]
    grams: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def kernel(self) -> np.ndarray:
        has = np.unpackbits(self.landmarks, axis=1, count=len(self.weights) - 1).astype(np.float32)
        return has / np.sqrt(np.maximum(has.sum(0), 1))


def fit(texts: list[tuple[str, np.ndarray]]) -> Model | None:
    """Fit to ``(language, n-gram codes)`` pairs, in order of preference as landmarks."""
    languages = sorted({language for language, _ in texts})
    if not languages:
        return None
    chosen = [codes for name in languages for codes in
              [codes for language, codes in texts if language == name and len(codes)][:LANDMARKS]]
    if not chosen:
        return None
    grams = np.unique(np.concatenate(chosen))
    has = np.stack([np.isin(grams, codes) for codes in chosen], 1)
    rows = np.stack([np.isin(grams, codes) for _, codes in texts]).astype(np.float32)
    rows /= np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))
    marks = has / np.sqrt(has.sum(0))
    values, vectors = np.linalg.eigh((marks.T @ marks).astype(float))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = np.hstack([(rows @ marks) @ root, np.ones((len(rows), 1))])
    truth = np.array([[float(language == name) for name in languages] for language, _ in texts])
    square = mapped.T @ mapped + RIDGE * len(rows) * np.diag([1.0] * root.shape[1] + [0.0])
    fitted = np.linalg.solve(square, mapped.T @ truth)
    weights = np.vstack([root @ fitted[:-1], fitted[-1:]])
    return Model(languages, grams, np.packbits(has, axis=1), weights.astype(np.float32))


class Scorer:
    """Scores batches of texts with dense presence rows."""

    def __init__(self, model: Model):
        self.model, self.marks = model, model.kernel()
        kind = np.uint16 if len(model.grams) < 2**16 - 1 else np.int32
        self.places = {order: np.zeros(1 << 8 * order, kind) for order in ORDERS}
        for order in ORDERS:
            own = np.flatnonzero(model.grams >> np.uint32(24) == order)
            self.places[order][model.grams[own] & np.uint32(0xFFFFFF)] = own + 1
        self.rows = np.zeros((ROWS, len(model.grams) + 1), np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        found = []
        for start in range(0, len(texts), ROWS):
            part = texts[start:start + ROWS]
            rows = self.rows[:len(part)]
            rows[:] = 0
            for row, text in zip(rows, part):
                for codes in _codes(text):
                    if len(codes):
                        row[self.places[int(codes[0]) >> 24][codes & np.uint32(0xFFFFFF)]] = 1
            known = rows[:, 1:]
            values = (known @ self.marks) / np.sqrt(np.maximum(known.sum(1, keepdims=True), 1))
            found.append(values @ self.model.weights[:-1] + self.model.weights[-1])
        return np.concatenate(found) if found else np.zeros((0, len(self.model.languages)))


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
])


def _scored(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                told = [number for number, text in enumerate(texts)
                        if scorer and text and any(map(str.isalpha, text))]
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                values = scorer.scores([texts[number] for number in told]) if told else []
                for number, row in zip(told, values):
                    best = int(np.argmax(row))
                    names[number], scores[number] = model.languages[best], float(min(max(row[best], 0), 1))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()),
                    pa.array(scores, pa.float64())], schema=_RESULT)

    return run


_EXAMPLES = pa.schema([("lang", pa.string()), ("hash", pa.int64()), ("codes", pa.binary())])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            codes = [_present(text or "").tobytes() for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("hash"), pa.array(codes, pa.binary())], schema=_EXAMPLES)


def held_out(doc_id: Column) -> Column:
    """Is the document kept from learning? One without an id always is."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def learn(docs: DataFrame) -> Model | None:
    """Learn from ``docs (doc_id, text, lang)``; None if no document can be learned from."""
    rows = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text",
                           "CAST(lang AS string) AS lang")
    open_rows = rows.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).withColumn(
        "hash", F.xxhash64("doc_id"))
    bucket = F.pmod("hash", F.lit(EXAMPLES)).alias("bucket")
    chosen = open_rows.groupBy("lang", bucket).agg(F.min("hash").alias("hash")).drop("bucket")
    examples = open_rows.join(chosen, ["lang", "hash"]).select("lang", "hash", "text").mapInArrow(
        _examples, "lang string, hash bigint, codes binary").groupBy("lang", "hash").agg(F.min("codes").alias("codes"))
    found = examples.orderBy("lang", "hash").collect()
    return fit([(row["lang"], np.frombuffer(row["codes"], np.uint32)) for row in found])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each row of ``docs (doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        _scored(model), "doc_id bigint, held_out boolean, lang_pred string, score double")


def op3_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    return predict(docs, learn(docs))
