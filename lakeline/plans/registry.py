"""Query registry and the pieces that several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.functions import text as tx
from lakeline.functions import vectors as vx
from lakeline.operators import features as ft
from lakeline.sources.files import table
from lakeline.session import dealt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query ``(spark, folder) -> DataFrame`` and its SQL twin."""
    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded, with no negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``doc_id``, ``text`` and further columns of the documents, on all cores."""
    return dealt(table(spark, folder, "documents", "doc_id", "text", *columns), "doc_id")


def tokenized(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id`` and lower-case ``tokens`` of the documents."""
    return ft.tokenize(documents(spark, folder), "text").select("doc_id", "tokens")


def labelled_text(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, text, label`` of the documents that have a quality label."""
    labels = table(spark, folder, "labels", "doc_id", "quality").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    return documents(spark, folder).join(labels, "doc_id")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """``vec_id, label double, features vector`` of the embeddings."""
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"),
        vx.as_vector(F.col("embedding")).alias("features"),
    )


def text_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, label, features``: characters of a document by its number of words."""
    n_words = F.size(tx.words_of_lines(F.col("text"))).cast("double")
    return documents(spark, folder, "n_chars").select(
        "doc_id", F.col("n_chars").cast("double").alias("label"),
        vx.as_vector(F.array(n_words)).alias("features"),
    )


# SQL pieces


def sql_lines(text: str) -> str:
    """List of the lines of a text."""
    parts = f"regexp_split_to_array({text}, '\\r\\n|\\r|\\n')"
    return (
        f"list_slice({parts}, 1, "
        f"len({parts}) - CASE WHEN {text} = '' OR right({text}, 1) IN (chr(10), chr(13)) "
        "THEN 1 ELSE 0 END)"
    )


def sql_words(line: str) -> str:
    """List of the words of a line."""
    return (
        f"CASE WHEN {line} = '' THEN [''] WHEN rtrim({line}, ' ') = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split(rtrim({line}, ' '), ' ') END"
    )


def sql_word_rows(source: str, column: str, *keep: str) -> str:
    """A query giving one row per word, for use in a WITH clause."""
    kept = "".join(f"{name}, " for name in keep)
    return (
        f"SELECT {kept}unnest({sql_words('line')}) AS word "
        f"FROM (SELECT {kept}unnest({sql_lines(column)}) AS line FROM {source})"
    )


SQL_SPACE = "[ \\t\\n\\x0B\\f\\r]"
SQL_TOKENS = (
    "CASE WHEN text = '' THEN [''] "
    f"WHEN regexp_replace(text, '{SQL_SPACE}+$', '') = '' THEN CAST([] AS VARCHAR[]) "
    f"ELSE regexp_split_to_array(regexp_replace(lower(text), '{SQL_SPACE}+$', ''), "
    f"'{SQL_SPACE}') END"
)
SQL_TOKENIZED = f"tokenized AS (SELECT doc_id, {SQL_TOKENS} AS tokens FROM documents)"
SQL_TEXT_SIZES = (
    "sizes AS (SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS y, "
    "CAST(coalesce(w.n, 0) AS DOUBLE) AS x FROM documents d LEFT JOIN "
    f"(SELECT doc_id, count(*) AS n FROM ({sql_word_rows('documents', 'text', 'doc_id')}) "
    "GROUP BY doc_id) w ON d.doc_id = w.doc_id)"
)
SQL_VECTORS = (
    "vectors AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS value, "
    "generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"
)
