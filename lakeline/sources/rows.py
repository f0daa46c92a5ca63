"""Small literal inputs as distributed tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows_to_table(
    spark: SparkSession,
    rows: Iterable[tuple],
    schema: StructType | str,
    partitions: int | None = None,
) -> DataFrame:
    """Rows written in the program as a DataFrame, in ``partitions`` parts if given."""
    df = spark.createDataFrame(list(rows), schema)
    return df.repartition(partitions) if partitions else df
