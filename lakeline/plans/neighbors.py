"""Similarity joins and nearest neighbours."""

from pyspark.ml.feature import Normalizer, StandardScaler
from pyspark.sql import functions as F

from lakeline.functions import vectors as vx
from lakeline.operators import features as ft
from lakeline.operators import neighbors as ops
from lakeline.plans.registry import embeddings, query, rounded, tokenized
from lakeline.session import stored
from lakeline.sources.files import table

BUCKET_LENGTH = 0.25
#: Of documents: a few words in a hundred differ.
CLOSE = 0.3


def _model(df):
    return ops.fit_lsh(df, "features", bucket_length=BUCKET_LENGTH, tables=3, seed=1)


@query("lsh_hash")
def lsh_hash(spark, folder):
    df = embeddings(spark, folder)
    hashed = ops.lsh_hash(_model(df), df)
    return hashed.select("vec_id", F.posexplode("hashes").alias("hash_table", "h")).select(
        "vec_id", "hash_table", vx.vector_to_array("h")[0].alias("bucket")
    )


def _text_vectors(spark, folder):
    """``doc_id, features``: 64 hashed term counts of a document, less their mean direction, of length 1."""
    counts = ft.hashing_tf(tokenized(spark, folder), "tokens", "counts", 64)
    counts = Normalizer(inputCol="counts", outputCol="direction").transform(counts.select("doc_id", "counts"))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="direction", outputCol="centred").fit(
        counts).transform(counts)
    rows = Normalizer(inputCol="centred", outputCol="features").transform(centred)
    return stored(rows.where(F.size(F.unwrap_udt("counts")["indices"]) > 0).select("doc_id", "features"), "text-vectors")


@query("lsh_similarity_join")
def lsh_similarity_join(spark, folder):
    """Documents without a label next to those that have one."""
    df = _text_vectors(spark, folder)
    labelled = table(spark, folder, "labels", "doc_id").distinct()
    known, rest = df.join(labelled, "doc_id", "left_semi"), df.join(labelled, "doc_id", "left_anti")
    lsh = ops.fit_compound_lsh(df, "features", CLOSE)
    return ops.compound_join(lsh, known, rest, "doc_id", "features", CLOSE)


@query("lsh_self_join")
def lsh_self_join(spark, folder):
    df = _text_vectors(spark, folder)
    lsh = ops.fit_compound_lsh(df, "features", CLOSE)
    return ops.compound_join(lsh, df, df, "doc_id", "features", CLOSE, self_join=True)


@query(
    "lsh_nearest",
    "WITH first AS (SELECT CAST(embedding AS DOUBLE[]) AS key FROM embeddings ORDER BY vec_id LIMIT 1), "
    "gaps AS (SELECT vec_id, list_distance(CAST(embedding AS DOUBLE[]), key) AS distance "
    "FROM embeddings, first) "
    "SELECT vec_id, round(distance, 6) AS distance FROM gaps ORDER BY gaps.distance, vec_id LIMIT 10",
)
def lsh_nearest(spark, folder):
    df = embeddings(spark, folder)
    key = df.orderBy("vec_id").first()["features"]
    found = ops.nearest(_model(df), df, key, k=10, ties="vec_id")
    return found.select("vec_id", rounded(F.col("distCol")).alias("distance"))


@query(
    "copy_members",
    "SELECT min(event_id) OVER (PARTITION BY user_id, event_type) AS id, event_id AS member "
    "FROM events",
)
def copy_members(spark, folder):
    events = table(spark, folder, "events", "event_id", "user_id", "event_type")
    slots = F.array(F.col("user_id").cast("double"), F.length("event_type").cast("double"),
                    F.ascii("event_type").cast("double"))
    points = events.select("event_id", vx.as_vector(slots).alias("v"))
    return ops.members(points, "event_id", "v")


@query(
    "exact_similarity_join",
    "WITH a AS (SELECT min(c_custkey) AS id, count(*) AS n, c_acctbal / 10 AS x, c_nationkey AS y "
    "FROM customer GROUP BY 3, 4), "
    "b AS (SELECT min(s_suppkey) AS id, count(*) AS n, s_acctbal / 10 AS x, s_nationkey AS y "
    "FROM supplier GROUP BY 3, 4) "
    "SELECT a.id AS id_a, a.n AS n_a, b.id AS id_b, b.n AS n_b, "
    "round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS distance "
    "FROM a JOIN b ON b.x BETWEEN a.x - 1.5 AND a.x + 1.5 "
    "WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < 1.5",
)
def exact_similarity_join(spark, folder):
    def points(name, row_id, balance, nation):
        slots = F.array(F.col(balance) / 10, F.col(nation).cast("double"))
        return table(spark, folder, name, row_id, balance, nation).select(
            row_id, vx.as_vector(slots).alias("v")
        )

    pairs = ops.exact_similarity_join(
        points("customer", "c_custkey", "c_acctbal", "c_nationkey"),
        points("supplier", "s_suppkey", "s_acctbal", "s_nationkey"),
        "c_custkey", "s_suppkey", "v", 1.5,
    )
    return pairs.withColumn("distance", rounded(F.col("distance")))
