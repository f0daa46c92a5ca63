"""Quality rules: fixed limits and a decision list learned from labelled documents.

Sequential covering: on one part of the labelled rows a rule grows condition by condition, each the
threshold with the best information gain; on the other part its last conditions are pruned as
long as that makes it more exact. A rule that is exact enough and covers enough is kept, the rows it
covers are set aside, and the next rule grows on the rest. The list is emitted as one ordered Spark
conditional. Text that no rule rejects is kept.

Null text has no words, so the fixed limits reject it. With no labels, or with one class only, no
rule is learned. At most ``LABELLED`` labelled documents, those of least hash, are used for learning; the
measures of all documents are computed over whole texts.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeline.llm.words import Words, mixed
from lakeline.session import small_batches
from lakeline.sources.files import table

LABELLED = 20_000
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
MOST_RULES = 12
MOST_CONDITIONS = 4
LEAST_EXACT = 0.95
#: Of the share that is rejected rightly: the bound that it exceeds nine times in ten (Wilson).
LEAST_SURE, SURE = 0.8, 1.2816
THRESHOLDS = 24
#: Texts measured at a time; the arrays are a few dozen times as large.
BLOCK_CHARS = 1 << 18
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
    "n_digits", "n_distinct", "n_stops", "longest_word",
]
#: What rules look at: measures as shares of the words or characters.
SHARES = {
    "words": "n_words", "word_length": "word_chars / n_words", "symbols": "n_symbols / n_words",
    "dup_lines": "n_dup_lines / n_lines", "repeated": "n_repeat_words / n_words",
    "upper": "n_upper / word_chars", "digits": "n_digits / word_chars",
    "distinct": "n_distinct / n_words", "stops": "n_stops / n_words", "longest": "longest_word",
    "line_words": "n_words / n_lines",
}


class Condition(NamedTuple):
    share: str
    above: bool
    limit: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.share] > self.limit if self.above else values[self.share] <= self.limit

    def column(self) -> Column:
        value = F.col(f"__shares.{self.share}")
        return value > self.limit if self.above else value <= self.limit


class Rule(NamedTuple):
    """Documents for which all conditions hold are rejected."""

    conditions: list[Condition]
    covered: int
    exact: float


def _table(chosen: bytes) -> np.ndarray:
    found = np.zeros(256, np.int64)
    found[list(chosen)] = 1
    return found


_IS_SYMBOL, _IS_UPPER = _table(SYMBOLS), _table(bytes(range(65, 91)))
_IS_DIGIT, _IS_STOP = _table(bytes(range(48, 58))), _table(b".!?")
_STARTS_CHAR = np.array([byte & 0xC0 != 0x80 for byte in range(256)], np.int64) - _table(SPACES)


def _dup_lines(text: str) -> tuple[int, int]:
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines)), len(lines)


def measured(texts: list[str]) -> dict[str, np.ndarray]:
    """All measures of a block of texts."""
    coded = [text.encode() for text in texts]
    words = Words(coded)
    data = np.frombuffer(words.buffer, np.uint8)
    ends = np.cumsum([len(text) + 1 for text in coded]).astype(np.int64)

    def total(kinds: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(kinds[data])))[np.concatenate(([0], ends))]
        return np.diff(sums)

    owner = mixed(words.text.astype(np.uint64))
    at = np.flatnonzero(words.left >= REPEAT_WINDOW)
    keys = words.windows(REPEAT_WINDOW)[at] ^ owner[at]
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    twice = at[counts[back] > 1]
    steps = np.zeros(len(words.starts) + REPEAT_WINDOW + 1, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + REPEAT_WINDOW, -1)
    repeated = np.cumsum(steps)[:len(words.starts)] > 0
    _, first = np.unique(words.hashes[0] ^ owner, return_index=True)
    count = len(texts)
    lengths = np.zeros(count, np.int64)
    np.maximum.at(lengths, words.text, words.ends - words.starts)
    lines = np.array([_dup_lines(text) for text in texts], np.int64).reshape(-1, 2)
    return {
        "n_words": words.counts, "word_chars": total(_STARTS_CHAR), "n_symbols": total(_IS_SYMBOL),
        "n_dup_lines": lines[:, 0], "n_repeat_words": np.bincount(words.text[repeated], minlength=count),
        "n_lines": lines[:, 1], "n_upper": total(_IS_UPPER), "n_digits": total(_IS_DIGIT),
        "n_distinct": np.bincount(words.text[first], minlength=count), "n_stops": total(_IS_STOP),
        "longest_word": lengths,
    }


@F.pandas_udf(StructType([StructField(name, LongType()) for name in MEASURES]))
def measures(texts: pd.Series) -> pd.DataFrame:
    parts, block, size = [], [], 0
    for text in texts:
        block.append(text or "")
        size += len(block[-1])
        if size >= BLOCK_CHARS:
            parts.append(pd.DataFrame(measured(block)))
            block, size = [], 0
    if block:
        parts.append(pd.DataFrame(measured(block)))
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({name: [] for name in MEASURES}, dtype="int64")


def _shares() -> Column:
    return F.struct(*[
        F.coalesce(F.expr(
            "try_divide(" + ", ".join(f"CAST(__measures.{part} AS double)" for part in text.split(" / ")) + ")"
            if "/" in text else f"CAST(__measures.{text} AS double)"), F.lit(0.0)).alias(name)
        for name, text in SHARES.items()
    ])


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the structs ``__measures`` and ``__shares`` of its ``text``."""
    return docs.withColumn("__measures", measures(F.col("text").cast("string"))).withColumn("__shares", _shares())


def base_failed() -> Column:
    words, repeated = F.col("__measures.n_words"), F.col("__measures.n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)


def _gain(good: np.ndarray, bad: np.ndarray, good_before: int, bad_before: int) -> np.ndarray:
    """Bad rows covered, times what their share has gained in bits."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = bad * (np.log2(bad / (good + bad)) - np.log2(bad_before / (good_before + bad_before)))
    return np.nan_to_num(gain, nan=0.0, neginf=0.0)


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    inside, found = np.ones(len(bad), bool), []
    while len(found) < MOST_CONDITIONS:
        n_bad, n_good = int(bad[inside].sum()), int((~bad[inside]).sum())
        if not n_bad or not n_good:
            break
        best = (0.0, None)
        for share, column in values.items():
            limits = np.unique(np.quantile(column[inside & bad], np.linspace(0, 1, THRESHOLDS)))
            for above in (True, False):
                held = column[inside][:, None] > limits if above else column[inside][:, None] <= limits
                covered_bad, covered = held[bad[inside]].sum(0), held.sum(0)
                gains = _gain(covered - covered_bad, covered_bad, n_good, n_bad)
                at = int(np.argmax(gains))
                if gains[at] > best[0] + 1e-9:
                    best = (float(gains[at]), Condition(share, above, float(limits[at])))
        if best[1] is None:
            break
        found.append(best[1])
        inside &= best[1].holds(values)
    return found


def _worth(conditions: list[Condition], values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, int]:
    held = np.ones(len(bad), bool)
    for condition in conditions:
        held &= condition.holds(values)
    covered = int(held.sum())
    return (float(bad[held].mean()) if covered else 0.0), covered


def lower_bound(share: float, rows: int) -> float:
    """What the true share exceeds nine times in ten, if ``share`` was seen on ``rows``."""
    if not rows:
        return 0.0
    square = SURE * SURE / rows
    spread = SURE * np.sqrt(share * (1 - share) / rows + square / (4 * rows))
    return float((share + square / 2 - spread) / (1 + square))


def learned(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """The decision list for rows whose order is random."""
    left, found = np.ones(len(bad), bool), []
    grows = np.arange(len(bad)) % 3 != 0
    while len(found) < MOST_RULES and bad[left & grows].any() and (left & ~grows).any():
        part = {name: column[left & grows] for name, column in values.items()}
        test = {name: column[left & ~grows] for name, column in values.items()}
        conditions = _grow(part, bad[left & grows])
        if not conditions:
            break
        choices = [conditions[:size] for size in range(1, len(conditions) + 1)]
        conditions = max(choices, key=lambda rule: (_worth(rule, test, bad[left & ~grows])[0], -len(rule)))
        exact, covered = _worth(conditions, test, bad[left & ~grows])
        if exact < LEAST_EXACT or lower_bound(exact, covered) < LEAST_SURE:
            break
        found.append(Rule(conditions, covered, exact))
        held = np.ones(len(bad), bool)
        for condition in conditions:
            held &= condition.holds(values)
        left &= ~held
    return found


def decision_list(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> list[Rule]:
    """Learn from ``labels (doc_id, quality)``: 0 is to be rejected. Base failures are left out."""
    sample = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    sample = sample.where("doc_id IS NOT NULL AND quality IS NOT NULL").orderBy(
        F.xxhash64("doc_id"), "quality").limit(most).dropDuplicates(["doc_id"])
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = with_measures(texts.join(F.broadcast(sample), "doc_id")).where(~base_failed())
    rows = rows.select("doc_id", "quality", "__shares.*").dropDuplicates(["doc_id"]).orderBy(
        F.xxhash64("doc_id")).toPandas()
    return learned({name: rows[name].to_numpy(float) for name in SHARES}, rows["quality"].to_numpy() == 0)


def verdict(rules: list[Rule]) -> Column:
    """Kept or not, as one conditional in the order of the rules; needs ``with_measures``."""
    chain = F.when(base_failed(), F.lit(False))
    for rule in rules:
        held = rule.conditions[0].column()
        for condition in rule.conditions[1:]:
            held &= condition.column()
        chain = chain.when(held, F.lit(False))
    return chain.otherwise(F.lit(True))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that neither the limits nor the learned rules reject."""
    small_batches(docs.sparkSession)
    rules = decision_list(docs, labels)
    own = {name: "text" if name == "text" else f"column{at}" for at, name in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{name}`").alias(new) for name, new in own.items()])  # whatever they are called
    kept = with_measures(renamed).where(verdict(rules))
    return kept.select(*[F.col(new).alias(name) for name, new in own.items()])


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    rules = decision_list(docs, table(spark, folder, "labels", "doc_id", "quality"))
    return with_measures(docs).select(
        "doc_id", *[F.col(f"__measures.{name}").alias(name) for name in MEASURES[:5]],
        base_failed().alias("base_failed"), verdict(rules).alias("kept"),
    )
