"""User-defined functions and aggregates."""

from pyspark.sql import functions as F

from lakeline.functions.average import average, register_average
from lakeline.functions.text import register_token_count
from lakeline.operators.tables import sql_over
from lakeline.plans.registry import SQL_TOKENIZED, query, rounded, tokenized
from lakeline.sources.files import table


@query(
    "udf_token_count",
    f"WITH {SQL_TOKENIZED} SELECT doc_id, CAST(len(tokens) AS INTEGER) AS tokens FROM tokenized",
)
def udf_token_count(spark, folder):
    name = register_token_count(spark)
    return tokenized(spark, folder).select("doc_id", F.expr(f"{name}(tokens)").alias("tokens"))


@query("udaf_avg_sql", "SELECT round(avg(o_custkey), 6) AS mean FROM orders")
def udaf_avg_sql(spark, folder):
    name = register_average(spark)
    means = sql_over(
        table(spark, folder, "orders", "o_custkey"), "lakeline_student",
        f"SELECT {name}(sum(CAST(o_custkey AS DECIMAL(38,0))), count(o_custkey)) AS mean "
        "FROM lakeline_student",
    )
    return means.select(rounded(F.col("mean")).alias("mean"))


@query(
    "udaf_avg_column",
    "SELECT l_returnflag, round(avg(l_orderkey), 6) AS mean FROM lineitem GROUP BY l_returnflag",
)
def udaf_avg_column(spark, folder):
    items = table(spark, folder, "lineitem", "l_returnflag", "l_orderkey")
    return items.groupBy("l_returnflag").agg(
        rounded(average(F.col("l_orderkey"))).alias("mean")
    )


@query(
    "udaf_avg_sql_fractions",
    "SELECT l_returnflag, round(avg(l_discount), 6) AS mean, "
    "round(avg(CAST(l_extendedprice AS DECIMAL(18,2))), 6) AS mean_price FROM lineitem GROUP BY l_returnflag",
)
def udaf_avg_sql_fractions(spark, folder):
    name = register_average(spark)
    means = sql_over(
        table(spark, folder, "lineitem", "l_returnflag", "l_discount", "l_extendedprice"), "lakeline_items",
        f"SELECT l_returnflag, {name}(sum(l_discount), count(l_discount)) AS mean, "
        f"{name}(sum(CAST(l_extendedprice AS DECIMAL(18,2))), count(l_extendedprice)) AS mean_price "
        "FROM lakeline_items GROUP BY l_returnflag",
    )
    return means.select(
        "l_returnflag", rounded(F.col("mean")).alias("mean"), rounded(F.col("mean_price")).alias("mean_price"))
