"""Projection, schema, split and inspection of tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def sql_over(df: DataFrame, view: str, text: str) -> DataFrame:
    """Run SQL text with ``df`` visible as the temporary view ``view``."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(text)


def rename_columns(df: DataFrame, *names: str) -> DataFrame:
    """Rename all columns by position."""
    return df.toDF(*names)


def conform_schema(df: DataFrame, record: StructType) -> DataFrame:
    """View ``df`` as ``record``: match by name, widen types, fail on a missing column."""
    missing = [name for name in record.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.to(record)


def row_map(
    df: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
) -> DataFrame:
    """Run Python code over the records, an Arrow batch at a time.

    For code that no column expression can state; the input should be narrowed
    to the needed columns first.
    """
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(over, schema)


def derive_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a computed column."""
    return df.withColumn(name, value)


def preview_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in a stated order; each partition keeps only its best ``n``."""
    return df.orderBy(*order).limit(n)


def keep(df: DataFrame) -> DataFrame:
    """Mark a table for reuse, in memory and then on local disk."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def partition_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows and key range of each physical partition."""
    return df.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
    )


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has, in any case of letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random parts by weight; repeatable only while the partitioning stays the same."""
    return df.randomSplit(list(weights), seed)


def key_split(
    df: DataFrame, key: str, parts: int = 10, cut: int = 7, hashed: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Two parts by key, the same on every run and under any partitioning.

    ``hashed`` spreads keys of any kind; without it a dense integer key is
    taken as it is. A NULL key is in the first part then.
    """
    slot = F.coalesce(F.pmod(F.xxhash64(key) if hashed else F.col(key), F.lit(parts)), F.lit(0))
    return df.where(slot < cut), df.where(slot >= cut)
