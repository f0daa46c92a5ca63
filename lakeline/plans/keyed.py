"""Key-value aggregation and sorting."""

import numpy as np
from pyspark.sql import functions as F

from lakeline.operators import keyed as ops
from lakeline.operators.mergeable import mergeable_aggregate
from lakeline.plans.registry import documents, query, rounded, sql_word_rows
from lakeline.session import dealt
from lakeline.sources.files import table


@query(
    "tokenize_explode",
    "SELECT doc_id, count(*) AS words, CAST(sum(length(word)) AS BIGINT) AS letters "
    f"FROM ({sql_word_rows('documents', 'text', 'doc_id')}) GROUP BY doc_id",
)
def tokenize_explode(spark, folder):
    words = ops.tokenize_explode(documents(spark, folder), "text", "doc_id")
    return words.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"), F.sum(F.length("word")).alias("letters")
    )


@query(
    "map_to_pairs",
    f"SELECT word, 1 AS value FROM ({sql_word_rows('conversations', 'text')})",
)
def map_to_pairs(spark, folder):
    words = ops.tokenize_explode(table(spark, folder, "conversations", "text"), "text")
    return ops.map_to_pairs(words, "word")


@query(
    "map_partitions_to_pairs",
    f"SELECT word, 1 AS value FROM ({sql_word_rows('conversations', 'text')})",
)
def map_partitions_to_pairs(spark, folder):
    words = ops.tokenize_explode(table(spark, folder, "conversations", "text"), "text")
    return ops.map_partitions_to_pairs(words, "word")


WORD_COUNT = (
    "SELECT word, count(*) AS n FROM ({words}) GROUP BY word{order}"
)


@query(
    "word_count",
    WORD_COUNT.format(words=sql_word_rows("documents", "text"), order=" ORDER BY word DESC"),
)
def word_count(spark, folder):
    return ops.word_count(documents(spark, folder), "text")


@query(
    "word_count_grouped",
    WORD_COUNT.format(words=sql_word_rows("documents", "text"), order=""),
)
def word_count_grouped(spark, folder):
    return ops.word_count(documents(spark, folder), "text", ordered=False)


@query(
    "reduce_by_key",
    "SELECT l_partkey, sum(l_quantity) AS value FROM lineitem GROUP BY l_partkey",
)
def reduce_by_key(spark, folder):
    return ops.reduce_by_key(
        table(spark, folder, "lineitem", "l_partkey", "l_quantity"), "l_partkey", "l_quantity"
    )


@query(
    "group_values",
    "SELECT event_type, event_id // 4096 AS block, "
    "string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY event_id) AS users "
    "FROM events GROUP BY 1, 2",
)
def group_values(spark, folder):
    events = table(spark, folder, "events", "event_id", "event_type", "user_id")
    grouped = ops.group_values(events, "event_type", "user_id", "event_id")
    return grouped.select(
        "event_type", "block",
        F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("users"),
    )


@query(
    "sort_by_key_desc",
    "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders "
    "ORDER BY o_orderpriority DESC, o_orderkey",
)
def sort_by_key_desc(spark, folder):
    orders = table(spark, folder, "orders", "o_orderpriority", "o_orderkey", "o_totalprice")
    return ops.sort_by_key_desc(orders, "o_orderpriority", ["o_orderkey"])


@query(
    "max_per_partition_sum",
    "SELECT l_suppkey, CAST(sum(top) AS BIGINT) AS value FROM (SELECT l_suppkey, l_linenumber, "
    "greatest(max(CAST(l_quantity AS INTEGER) - 45), 0) AS top FROM lineitem GROUP BY 1, 2) "
    "GROUP BY l_suppkey",
)
def max_per_partition_sum(spark, folder):
    items = table(spark, folder, "lineitem", "l_suppkey", "l_linenumber", "l_quantity")
    shifted = items.withColumn("v", F.col("l_quantity").cast("int") - 45)
    return ops.max_per_partition_sum(shifted, "l_suppkey", "v", "l_linenumber")


@query(
    "sum_and_count_by_key",
    "SELECT l_returnflag, sum(l_quantity) AS total, count(l_quantity) AS n FROM lineitem "
    "GROUP BY l_returnflag",
)
def sum_and_count_by_key(spark, folder):
    items = table(spark, folder, "lineitem", "l_returnflag", "l_quantity")
    return ops.sum_and_count_by_key(items, "l_returnflag", "l_quantity")


def _add(state: tuple, values: np.ndarray) -> tuple:
    return state[0] + float(values.sum()), state[1] + len(values)


@query(
    "mergeable_aggregate",
    "SELECT l_suppkey, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY l_suppkey",
)
def mergeable(spark, folder):
    items = dealt(table(spark, folder, "lineitem", "l_suppkey", "l_quantity"))
    means = mergeable_aggregate(
        items, "l_suppkey", "l_quantity",
        zero=lambda: (0.0, 0),
        reduce=_add,
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda state: (state[0] / state[1],),
        state="total double, n bigint",
        result="mean double",
    )
    return means.select("l_suppkey", rounded(F.col("mean")).alias("mean"))
