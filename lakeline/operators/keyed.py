"""Aggregation by key, word counts and total orders."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.functions import text as tx


def tokenize_explode(df: DataFrame, column: str, *keep: str, out: str = "word") -> DataFrame:
    """One row per word of a text column; lines end at any line break."""
    return df.select(*keep, F.explode(tx.words_of_lines(F.col(column))).alias(out))


def map_to_pairs(df: DataFrame, key: str, value: Column | None = None) -> DataFrame:
    """``(key, value)`` pairs, value 1 unless stated."""
    return df.select(key, (F.lit(1) if value is None else value).alias("value"))


def map_partitions_to_pairs(df: DataFrame, key: str, kind: str = "string") -> DataFrame:
    """The same pairs made by Python code over each partition's batches."""
    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(value=1)

    return df.select(key).mapInPandas(pairs, f"`{key}` {kind}, value int")


def word_count(df: DataFrame, column: str, ordered: bool = True) -> DataFrame:
    """Rows per word, words descending; counted before the shuffle."""
    counts = tokenize_explode(df, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("word")) if ordered else counts


def reduce_by_key(df: DataFrame, key: str, value: Column | str, how: Callable = F.sum,
                  out: str = "value") -> DataFrame:
    """One associative built-in aggregate per key."""
    return df.groupBy(key).agg(how(value).alias(out))


def group_values(df: DataFrame, key: str, value: str, row_id: str, width: int = 4096) -> DataFrame:
    """All values of each key as ``(key, block, values)``, in ``row_id`` order.

    A key's values are cut into blocks of ``width`` consecutive ids. With
    unique ids no array holds more than ``width`` values and no task takes more
    than that of a key, however many rows it has.
    """
    block = F.floor(F.col(row_id) / width).cast("bigint")
    pairs = F.sort_array(F.collect_list(F.struct(F.col(row_id), F.col(value))))
    return df.groupBy(key, block.alias("block")).agg(
        F.transform(pairs, lambda pair: pair.getField(value)).alias("values")
    )


def sort_by_key_desc(df: DataFrame, key: str, ties: Sequence[str] = ()) -> DataFrame:
    """Total order on a key, largest first.

    Range partitioning on the key alone sends all rows of a frequent key to
    one task. The order goes on over ``ties``, or over the row's position in
    the input, so that such a key is cut into several ranges.
    """
    if ties:
        return df.orderBy(F.desc(key), *ties)
    at = "__position"
    return (
        df.withColumn(at, F.monotonically_increasing_id()).orderBy(F.desc(key), at).drop(at)
    )


def max_per_partition_sum(
    df: DataFrame, key: str, value: str, part: str, zero: int = 0
) -> DataFrame:
    """Per key, the sum over partitions of the largest value, at least ``zero``.

    The partition is a column, so the answer does not depend on where Spark
    happens to place the rows.
    """
    tops = df.groupBy(key, part).agg(F.greatest(F.max(value), F.lit(zero)).alias("top"))
    return tops.groupBy(key).agg(F.sum("top").alias("value"))


def sum_and_count_by_key(df: DataFrame, key: str, value: Column | str) -> DataFrame:
    """Sum and number of values per key."""
    return df.groupBy(key).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
