"""Projection, filter, schema and SQL."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeline.functions import text as tx
from lakeline.operators import tables as ops
from lakeline.plans.registry import documents, query, rounded, sql_word_rows
from lakeline.sources.files import table


@query("sql_select_all", "SELECT * FROM customer")
def sql_select_all(spark, folder):
    return ops.sql_over(
        table(spark, folder, "customer"), "lakeline_user", "SELECT * FROM lakeline_user"
    )


@query("project_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def project_columns(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("rename_columns", 'SELECT s_suppkey AS id, s_name AS "name", s_nationkey AS nation, '
       "s_acctbal AS balance FROM supplier")
def rename_columns(spark, folder):
    return ops.rename_columns(
        table(spark, folder, "supplier"), "id", "name", "nation", "balance"
    )


@query(
    "conform_schema",
    "SELECT c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_custkey FROM customer",
)
def conform_schema(spark, folder):
    record = StructType([
        StructField("c_name", StringType()),
        StructField("c_nationkey", LongType()),
        StructField("c_custkey", LongType()),
    ])
    return ops.conform_schema(table(spark, folder, "customer"), record)


@query(
    "row_map",
    "SELECT c_custkey, lower(c_mktsegment) || '-' || CAST(c_nationkey AS VARCHAR) AS tag "
    "FROM customer",
)
def row_map(spark, folder):
    def tag(batch):
        batch["tag"] = batch.c_mktsegment.str.lower() + "-" + batch.c_nationkey.astype(str)
        return batch[["c_custkey", "tag"]]

    customers = table(spark, folder, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    return ops.row_map(customers, tag, "c_custkey bigint, tag string")


@query(
    "derive_column",
    "SELECT d.doc_id, d.lang, coalesce(w.n, 0) AS tokens FROM documents d LEFT JOIN "
    f"(SELECT doc_id, count(*) AS n FROM ({sql_word_rows('documents', 'text', 'doc_id')}) "
    "GROUP BY doc_id) w ON d.doc_id = w.doc_id",
)
def derive_column(spark, folder):
    docs = documents(spark, folder, "lang")
    tokens = F.size(tx.words_of_lines(F.col("text"))).cast("bigint")
    return ops.derive_column(docs, "tokens", tokens).select("doc_id", "lang", "tokens")


@query(
    "filter_nested_predicate",
    "SELECT c_custkey AS a_id, o_orderkey AS b_id, c_name AS a_name, o_totalprice AS b_price "
    "FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_custkey < o_orderkey",
)
def filter_nested_predicate(spark, folder):
    a = table(spark, folder, "customer").select(
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("datasetA")
    )
    b = table(spark, folder, "orders").select(
        F.struct(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"),
            F.col("o_totalprice").alias("price"),
        ).alias("datasetB")
    )
    pairs = a.join(b, F.col("datasetA.id") == F.col("datasetB.cust"))
    return pairs.filter("datasetA.id < datasetB.id").select(
        F.col("datasetA.id").alias("a_id"), F.col("datasetB.id").alias("b_id"),
        F.col("datasetA.name").alias("a_name"), F.col("datasetB.price").alias("b_price"),
    )


@query(
    "preview_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
    "ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def preview_rows(spark, folder):
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return ops.preview_rows(orders, 20, F.desc("o_totalprice"), "o_orderkey")


@query(
    "cache_reuse",
    "SELECT 'flag' AS kind, l_returnflag AS value, count(*) AS n, "
    "round(sum(l_extendedprice * (1 - l_discount)), 2) AS net FROM lineitem GROUP BY l_returnflag "
    "UNION ALL SELECT 'status', l_linestatus, count(*), "
    "round(sum(l_extendedprice * (1 - l_discount)), 2) FROM lineitem GROUP BY l_linestatus",
)
def cache_reuse(spark, folder):
    items = table(
        spark, folder, "lineitem", "l_returnflag", "l_linestatus", "l_extendedprice", "l_discount"
    )
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    kept = ops.keep(items.select("l_returnflag", "l_linestatus", net.alias("net")))

    def totals(kind, column):
        return kept.groupBy(column).agg(
            F.count(F.lit(1)).alias("n"), rounded(F.sum("net"), 2).alias("net")
        ).select(F.lit(kind).alias("kind"), F.col(column).alias("value"), "n", "net")

    return totals("flag", "l_returnflag").union(totals("status", "l_linestatus"))


@query(
    "partition_profile",
    "SELECT count(*) AS n, min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem",
)
def partition_profile(spark, folder):
    profile = ops.partition_profile(table(spark, folder, "lineitem", "l_orderkey"), "l_orderkey")
    return profile.agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )


@query(
    "random_split",
    "SELECT count(*) AS n, count(DISTINCT o_orderkey) AS keys, TRUE AS near_weights FROM orders",
)
def random_split(spark, folder):
    orders = table(spark, folder, "orders", "o_orderkey")
    first, second = ops.random_split(orders, [0.7, 0.3], seed=1)
    both = first.withColumn("part", F.lit(1)).union(second.withColumn("part", F.lit(0)))
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("keys"),
        F.avg("part").between(0.65, 0.75).alias("near_weights"),
    )


@query(
    "key_split",
    "SELECT CASE WHEN doc_id % 10 < 7 THEN 'first' ELSE 'second' END AS part, count(*) AS n, "
    "CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1",
)
def key_split(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "n_chars")
    first, second = ops.key_split(docs, "doc_id", 10, 7, hashed=False)

    def size(name, part):
        return part.agg(
            F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
        ).select(F.lit(name).alias("part"), "n", "chars")

    return size("first", first).union(size("second", second))
