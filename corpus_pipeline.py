"""Documents to token ids: quality, near copies, benchmark leaks, personal data, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and gets what the one before it kept, read back from
Parquet. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm import bpe, leaks, near_copies, personal, quality
from lakeline.session import stored
from lakeline.sources.files import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the fixed limits nor the learned rules reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_copies.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` is that of the new text."""
    redacted = personal.redact(docs, personal.learn(docs))
    return redacted.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else redacted


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what is left."""
    return bpe.encode_digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]
#: No SQL twin: learned rules, sketches and merges are not SQL. ``tests/llm`` checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
