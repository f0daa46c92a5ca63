import math

import pandas as pd
from pyspark.sql import functions as F

from lakeline.functions.average import average, register_average
from lakeline.operators import joins, keyed
from lakeline.operators.mergeable import mergeable_aggregate
from lakeline.sources import files
from lakeline.session import stored

PAIRS = [("a", 3, 0), ("a", 2, 0), ("c", 4, 0), ("b", 3, 1), ("c", 6, 1), ("c", 8, 1)]


def pairs(spark):
    return spark.createDataFrame(PAIRS, "k string, v int, part int")


def as_map(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_max_per_partition_sum(spark):
    found = as_map(keyed.max_per_partition_sum(pairs(spark), "k", "v", "part"))
    assert found == {"a": (3,), "b": (3,), "c": (12,)}
    negative = spark.createDataFrame([("x", -5, 0), ("x", 2, 1), ("y", -1, 0)], "k string, v int, part int")
    assert as_map(keyed.max_per_partition_sum(negative, "k", "v", "part")) == {"x": (2,), "y": (0,)}


def test_sum_and_count(spark):
    assert as_map(keyed.sum_and_count_by_key(pairs(spark), "k", "v")) == {
        "a": (5, 2), "b": (3, 1), "c": (18, 3)
    }
    assert as_map(keyed.reduce_by_key(pairs(spark), "k", "v")) == {"a": (5,), "b": (3,), "c": (18,)}


def test_partial_sums_before_shuffle(spark):
    plan = keyed.sum_and_count_by_key(pairs(spark), "k", "v")._jdf.queryExecution().toString()
    assert "partial_sum" in plan and "partial_count" in plan


def test_group_values_keeps_all_in_bounded_blocks(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), (F.col("id") * 2).alias("v"), "id")
    rows = keyed.group_values(df, "k", "v", "id", width=64).orderBy("block").collect()
    assert max(len(r["values"]) for r in rows) <= 64
    assert [v for r in rows for v in r["values"]] == [2 * i for i in range(1000)]


def test_sort_cuts_a_frequent_key(spark):
    # user-stated repartition-free sort: count the ranges the hot key lands in
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4000, numPartitions=8).select(
            F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("k"), "id"
        )
        placed = keyed.sort_by_key_desc(df, "k").select("k", F.spark_partition_id().alias("p"))
        assert placed.where("k = 'hot'").select("p").distinct().count() > 3
        assert [r.k for r in keyed.sort_by_key_desc(df, "k").collect()] == ["hot"] * 3600 + ["cold"] * 400
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def mean_of(df, **settings):
    return mergeable_aggregate(
        df, "k", "v",
        zero=lambda: (0.0, 0),
        reduce=lambda s, values: (s[0] + float(values.sum()), s[1] + len(values)),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda s: (s[0] / s[1],),
        state="total double, n bigint", result="mean double", **settings,
    )


def test_mergeable_equals_avg(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 97).cast("double").alias("v"),
    )
    expected = as_map(df.groupBy("k").agg(F.avg("v")))
    for settings in ({}, {"max_keys": 3}, {"salts": 1}):
        found = as_map(mean_of(df, **settings))
        assert found.keys() == expected.keys()
        assert all(abs(found[k][0] - expected[k][0]) < 1e-9 for k in found)


def test_mergeable_null_key_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    assert as_map(mean_of(df)) == {None: (2.0,), "a": (5.0,)}
    assert mean_of(df.where("v > 100")).count() == 0


def test_mergeable_keeps_integer_keys_and_values_next_to_null(spark):
    big = 2**53
    df = spark.createDataFrame(
        [(big, big + 1), (big + 1, 1), (None, 5), (big + 1, None), (None, 2), (7, None)], "k bigint, v bigint")
    for settings in ({}, {"max_keys": 1}, {"salts": 1}):
        found = mergeable_aggregate(
            df.repartition(3), "k", "v", zero=lambda: (0, None),
            reduce=lambda s, values: (s[0] + int(values.sum()), max([x for x in (s[1], *values.tolist()) if x is not None], default=None)),
            merge=lambda a, b: (a[0] + b[0], max([x for x in (a[1], b[1]) if x is not None], default=None)),
            finish=lambda s: s, state="total bigint, top bigint", result="total bigint, top bigint", **settings)
        assert as_map(found) == {big: (big + 1, big + 1), big + 1: (1, 1), None: (7, 5), 7: (0, None)}


def test_mergeable_keeps_nan_and_null_apart(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1.0), (None, 2.0), (nan, 3.0), (0.0, 4.0), (-0.0, 6.0)], "k double, v double")
    for parts in (1, 4):
        found = mean_of(df.repartition(parts), max_keys=1).collect()
        assert sorted((str(r.k), r["mean"]) for r in found if r.k != 0) == [("None", 2.0), ("nan", 2.0)]
        assert [r["mean"] for r in found if r.k == 0] == [5.0]


def test_sql_average_of_fractions(spark):
    name = register_average(spark)
    spark.createDataFrame([(0.4, 2**53 + 1), (0.4, 2**53 + 1), (None, None)], "x double, n bigint").createOrReplaceTempView("fractions")
    row = spark.sql(
        f"SELECT {name}(sum(x), count(x)) AS a, {name}(sum(CAST(x AS DECIMAL(9,2))), count(x)) AS b, "
        f"{name}(sum(CAST(n AS DECIMAL(38,0))), count(n)) AS c, {name}(sum(n), 0L) AS d FROM fractions").first()
    assert tuple(row)[:3] == (0.4, 0.4, float(2**53 + 1)) and math.isnan(row.d)


def test_custom_average(spark, tmp_path):
    # fixed values: the ages behind the golden average
    (tmp_path / "people.json").write_text("\n".join(
        f'{{"name": "{name}", "age":  {age}}}'
        for name, age in (("a", 20), ("b", 30), ("c", 40), ("d", 50))
    ))
    users = files.read_json_inferred(spark, str(tmp_path))
    assert users.dtypes == [("age", "bigint"), ("name", "string")]
    assert users.select(average(F.col("age")).alias("udfAvg2")).first()[0] == 35.0
    name = register_average(spark)
    users.createOrReplaceTempView("student_t")
    text = f"SELECT {name}(sum(CAST(age AS DECIMAL(38,0))), count(age)) FROM student_t"
    assert spark.sql(text).first()[0] == 35.0
    assert math.isnan(spark.sql(text + " WHERE age > 99").first()[0])
    assert math.isnan(users.where("age > 99").select(average(F.col("age"))).first()[0])
    big = spark.createDataFrame([(2**62,), (2**62,), (2**62,), (None,)], "age bigint")
    assert big.select(average(F.col("age"))).first()[0] == float(2**62)


def test_pairs_by_column_and_by_partition(spark):
    words = spark.createDataFrame([("a",), ("b",), ("a",)], "word string")
    by_column = sorted(tuple(r) for r in keyed.map_to_pairs(words, "word").collect())
    assert by_column == sorted(tuple(r) for r in keyed.map_partitions_to_pairs(words, "word").collect())


def test_lookup_join_with_a_frequent_key(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k")
    )
    lookup = stored(
        rows.groupBy("k").agg(F.count(F.lit(1)).alias("uses"), F.max("id").alias("top")), "lookup"
    )
    plain = sorted(tuple(r) for r in rows.join(lookup, "k").select("id", "k", "top").collect())
    for limit in (0, 10**6):
        joined = joins.lookup_join(rows, lookup, "k", "uses", "id", broadcast_rows=limit)
        assert sorted(tuple(r) for r in joined.select("id", "k", "top").collect()) == plain
