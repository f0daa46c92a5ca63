"""The custom average, as a column and under a name for SQL text.

NULLs are skipped, no rows give NaN. Integers are summed as ``decimal(38,0)`` so that the sum cannot
wrap around, other numbers as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def average(value: Column) -> Column:
    """Average of a numeric column, with the usual map-side partial sums."""
    whole = F.typeof(value).isin("tinyint", "smallint", "int", "bigint")
    exact = F.sum(F.when(whole, value.cast("decimal(38,0)"))).cast("double")
    total, n = F.coalesce(exact, F.sum(F.when(~whole, value.cast("double")))), F.count(value)
    return F.when(n == 0, F.lit(float("nan"))).otherwise(total / n)


def register_average(spark: SparkSession, name: str = "udfAvg") -> str:
    """Register the finishing step; use as ``udfAvg(sum(x), count(x))``.

    The buffer (sum, count) is kept by the built-in aggregates, which combine
    before the shuffle. A Python aggregate under the same name would send each
    group, and a global average the whole table, to one worker.

    The total may be of any numeric type. Sum large integers as ``CAST(x AS DECIMAL(38,0))``:
    the sum is then exact and is rounded once, here.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(total DOUBLE, n BIGINT) "
        "RETURNS DOUBLE RETURN CASE WHEN n = 0 THEN double('NaN') ELSE total / n END"
    )
    return name
