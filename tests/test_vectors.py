import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lakeline.functions import vectors as vx
from lakeline.operators import features as ft


def arrays(df, column):
    return [[round(float(v), 4) + 0.0 for v in row[0].toArray()] for row in df.select(column).collect()]


def vectors(spark, *rows):
    return spark.createDataFrame([(at, row) for at, row in enumerate(rows)], ["id", "features"]).coalesce(1)


def test_normalize(spark):
    df = vectors(spark, Vectors.dense(1.0, 0.5, -1.0), Vectors.dense(2.0, 1.0, 1.0),
                 Vectors.dense(4.0, 10.0, 2.0), Vectors.dense(0.0, 0.0, 0.0))
    assert arrays(ft.normalize(df, "features", 1.0), "normalized") == [
        [0.4, 0.2, -0.4], [0.5, 0.25, 0.25], [0.25, 0.625, 0.125], [0, 0, 0]]
    top = [[1, 0.5, -1], [1, 0.5, 0.5], [0.4, 1, 0.2], [0, 0, 0]]
    assert arrays(ft.normalize(df, "features", float("inf")), "normalized") == top
    merged = {**{"p": 1.0}, **{"p": float("inf")}}
    assert arrays(ft.normalize(df, "features", 1.0, overrides=merged), "normalized") == top


def test_binarize(spark):
    df = spark.createDataFrame([(0.1,), (0.8,), (0.2,), (0.5,)], "feature double").coalesce(1)
    assert [r.flag for r in ft.binarize(df, "feature", 0.5).collect()] == [0.0, 1.0, 0.0, 0.0]


def test_slice_by_index_and_name(spark):
    df = vectors(spark, Vectors.sparse(3, [(0, -2.0), (1, 2.3)]), Vectors.dense(-2.0, 2.3, 0.0))
    named = ft.name_slots(df, "features", ["f1", "f2", "f3"])
    rows = ft.vector_slice(named, "features", indices=[1], names=["f3"]).collect()
    assert rows[0].sliced == Vectors.sparse(2, {0: 2.3}) and rows[1].sliced == Vectors.dense(2.3, 0.0)


def test_chi2(spark):
    df = spark.createDataFrame([
        (7, Vectors.dense(0.0, 0.0, 18.0, 1.0), 1.0), (8, Vectors.dense(0.0, 1.0, 12.0, 0.0), 0.0),
        (9, Vectors.dense(1.0, 0.0, 15.0, 0.1), 0.0)], ["id", "features", "clicked"])
    assert list(ft.fit_chi2_selector(df, "features", "clicked", 2).selectedFeatures) == [2, 3]
    p = [round(r.p_value, 4) for r in ft.chi2_statistic(df, "features", "clicked").orderBy("slot").collect()]
    assert p == [0.3865, 0.3865, 0.2231, 0.2231]


def test_pca(spark):
    df = vectors(spark, Vectors.sparse(5, [(1, 1.0), (3, 7.0)]), Vectors.dense(2.0, 0.0, 3.0, 4.0, 5.0),
                 Vectors.dense(4.0, 0.0, 0.0, 6.0, 7.0))
    found = arrays(ft.fit_pca(df, "features", 3).transform(df), "projected")
    expected = [[1.6486, 4.0133, 1.0091], [4.6451, 1.1168, 1.0091], [6.4289, 5.338, 1.0091]]
    assert [[abs(v) for v in row] for row in found] == expected


def test_indexes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), ("d",)], "s string")
    model = ft.fit_string_index(df, "s")
    assert list(model.labels) == ["a", "b", "c", "d"]
    back = ft.index_to_string(model.transform(df), "index", model.labels)
    assert back.where("s <> label").count() == 0
    unseen = spark.createDataFrame([("zz",)], "s string")
    with pytest.raises(Exception):
        model.transform(unseen).collect()
    df = vectors(spark, *[Vectors.dense(v, v) for v in (3.0, 0.0, -1.0)],
                 *[Vectors.dense(3.0, 10.0 + v) for v in range(4)])
    maps = ft.fit_vector_index(df, "features", max_categories=4).categoryMaps
    assert dict(maps) == {0: {0.0: 0, -1.0: 1, 3.0: 2}}


def test_vector_pieces(spark):
    df = vectors(spark, Vectors.sparse(1 << 20, {5: 2.0, 900000: 1.5}))
    assert df.select(vx.sparse_sum(F.col("features"))).first()[0] == 3.5
    entries = df.select(F.explode(vx.sparse_entries(F.col("features"))).alias("e")).collect()
    assert [(r.e.pos, r.e.value) for r in entries] == [(5, 2.0), (900000, 1.5)]
    gap = spark.range(1).select(vx.squared_distance(vx.literal_vector([0, 3]), vx.literal_vector([4, 0])))
    assert gap.first()[0] == 25.0
