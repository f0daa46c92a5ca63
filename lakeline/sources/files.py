"""File sources: parquet tables, text lines, JSON lines and libsvm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A parquet table, narrowed to ``columns`` so that the scan reads only those."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line of the text files at ``path``."""
    return spark.read.text(path)


def read_json_inferred(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """JSON lines with an inferred schema.

    Inference reads the input once more; give ``schema`` to save that pass, or
    ``sampling_ratio`` to infer from a share of the lines. All lines are
    always loaded.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.json(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``(label double, features vector)`` from libsvm text.

    Without ``num_features`` Spark scans the input first to find the size.
    """
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", num_features)
    return reader.load(path)


def write_libsvm(df: DataFrame, path: str) -> None:
    """Write ``(label double, features vector)`` as libsvm text."""
    df.write.format("libsvm").mode("overwrite").save(path)
