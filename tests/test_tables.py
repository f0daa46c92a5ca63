import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from lakeline.operators import tables as ops
from lakeline.sources import files, rows
from lakeline.functions import vectors as vx


def users(spark):
    return rows.rows_to_table(
        spark, [(1, "harbour", 11), (2, "elm", 52), (3, "slate", 33)], "id int, name string, age int", 2
    )


def test_rows_and_rename(spark):
    df = users(spark)
    assert df.count() == 3
    assert ops.rename_columns(df, "a", "b", "c").columns == ["a", "b", "c"]


def test_conform_schema(spark):
    record = StructType([StructField("age", LongType()), StructField("name", StringType())])
    assert ops.conform_schema(users(spark), record).dtypes == [("age", "bigint"), ("name", "string")]
    missing = StructType([StructField("zip", IntegerType(), nullable=False)])
    with pytest.raises(Exception):
        ops.conform_schema(users(spark), missing).collect()


def test_row_map(spark):
    named = ops.row_map(users(spark).select("name"), lambda b: b.assign(n=b.name.str.len()), "name string, n int")
    assert {tuple(r) for r in named.collect()} == {("harbour", 7), ("elm", 3), ("slate", 5)}


def test_splits(spark):
    df = spark.range(1000)
    first, second = ops.key_split(df, "id")
    assert first.count() + second.count() == 1000
    again, _ = ops.key_split(df.repartition(13), "id")
    assert sorted(r.id for r in first.collect()) == sorted(r.id for r in again.collect())
    parts = ops.random_split(df, [0.7, 0.3], 1)
    assert sum(p.count() for p in parts) == 1000


def test_profile_preview_sql(spark):
    df = spark.range(0, 100, numPartitions=4)
    profile = ops.partition_profile(df, "id").collect()
    assert sum(r.n for r in profile) == 100
    assert [r.id for r in ops.preview_rows(df, 3, F.desc("id")).collect()] == [99, 98, 97]
    assert ops.sql_over(df, "t_ids", "SELECT max(id) AS top FROM t_ids").first().top == 99
    kept = ops.keep(df)
    assert kept.count() == 100 and kept.storageLevel.useMemory
    kept.unpersist()


def test_json_with_and_without_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1}\n{"k": 2, "x": "y"}\n')
    assert files.read_json_inferred(spark, str(tmp_path)).dtypes == [("k", "bigint"), ("x", "string")]
    assert files.read_json_inferred(spark, str(tmp_path), "k int").dtypes == [("k", "int")]


def test_libsvm_round_trip(spark, tmp_path):
    data = spark.createDataFrame([(1.0, [0.0, 2.5, 0.0]), (0.0, [1.0, 0.0, -3.0])], "label double, a array<double>")
    path = str(tmp_path / "svm")
    files.write_libsvm(data.select("label", vx.as_vector(F.col("a")).alias("features")), path)
    for size in (3, None):
        back = files.read_libsvm(spark, path, size)
        assert {(r.label, tuple(r.features.toArray())) for r in back.collect()} == {
            (1.0, (0.0, 2.5, 0.0)), (0.0, (1.0, 0.0, -3.0))
        }


def test_worker_code_travels_by_value(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from lakeline.plans.keyed import _add

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(_add))
    code = ("import pickle, numpy; f = pickle.load(open('f.pkl', 'rb')); "
            "print(f((1.0, 1), numpy.array([2.0, 3.0])))")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert "6.0" in out.stdout, out.stderr
