import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lakeline.functions import vectors as vx
from lakeline.operators import neighbors as ops
from lakeline.plans.neighbors import _text_vectors
from lakeline.plans.registry import embeddings
from lakeline.session import stored

# fixed values: the input points of the golden fixture
A = [(0, (1.0, 1.0)), (1, (1.0, -1.0)), (2, (-1.0, -1.0)), (3, (-1.0, 1.0))]
B = [(4, (1.0, 0.0)), (5, (-1.0, 0.0)), (6, (0.0, 1.0)), (7, (0.0, -1.0))]



@pytest.fixture(scope="module")
def small(spark):
    frame = lambda rows: spark.createDataFrame(
        [(i, Vectors.dense(*v)) for i, v in rows], ["id", "keys"])
    return frame(A), frame(B)


def cloud(spark, n, size, seed, hot=0):
    """Random points, of which ``hot`` are the same one."""
    values = np.random.default_rng(seed).normal(size=(n, size))
    values[:hot] = 0.25
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(values)], "id int, a array<double>")
    return df.select("id", vx.as_vector(F.col("a")).alias("keys")), values


def brute(x, y, threshold, self_join=False):
    gaps = np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))
    return {(i, j) for i, j in zip(*np.where(gaps < threshold)) if not self_join or i < j}


def expand(pairs, left, right):
    """Pairs of rows from pairs of distinct vectors."""
    a = left.select(F.col("id").alias("id_a"), F.col("member").alias("x"))
    b = right.select(F.col("id").alias("id_b"), F.col("member").alias("y"))
    rows = pairs.join(a, "id_a").join(b, "id_b").select("x", "y").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_fixture_joins(small):
    a, b = small
    model = ops.fit_lsh(a, "keys", bucket_length=2.0, tables=3, seed=1)
    found = {(r.id_a, r.id_b): r.distance for r in ops.similarity_join(model, a, b, "id", "keys", 1.5).collect()}
    library = {(r.datasetA.id, r.datasetB.id): r.distCol for r in model.approxSimilarityJoin(a, b, 1.5).collect()}
    assert found == library
    assert set(found) <= {(0, 4), (0, 6), (1, 4), (1, 7), (2, 5), (2, 7), (3, 5), (3, 6)}
    itself = ops.similarity_join(model, a, a, "id", "keys", 2.5, self_join=True)
    library = model.approxSimilarityJoin(a, a, 2.5).filter("datasetA.id < datasetB.id")
    assert {(r.id_a, r.id_b) for r in itself.collect()} == {
        (r.datasetA.id, r.datasetB.id) for r in library.collect()}
    near = ops.nearest(model, a, Vectors.dense(1.0, 0.0), 2).collect()
    assert {r.id for r in near} == {0, 1} and all(r.distCol == 1.0 for r in near)
    exact = ops.exact_similarity_join(a, b, "id", "id", "keys", 1.5)
    assert {(r.id_a, r.id_b) for r in exact.collect()} == {
        (0, 4), (0, 6), (1, 4), (1, 7), (2, 5), (2, 7), (3, 5), (3, 6)}


@pytest.mark.parametrize("length, tables, threshold", [(0.5, 3, 1.2), (4.0, 2, 1.0), (1.0, 1, 2.0)])
def test_same_pairs_as_the_library(spark, length, tables, threshold):
    a, _ = cloud(spark, 150, 4, 1)
    b, _ = cloud(spark, 120, 4, 2)
    model = ops.fit_lsh(a, "keys", bucket_length=length, tables=tables, seed=3)
    ours = ops.similarity_join(model, a, b, "id", "keys", threshold).select("id_a", "id_b").collect()
    library = model.approxSimilarityJoin(a, b, threshold).select("datasetA.id", "datasetB.id").collect()
    assert len(ours) == len(set(ours)) and {tuple(r) for r in ours} == {tuple(r) for r in library}


def test_exact_join_with_copies_and_a_full_cell(spark):
    a, x = cloud(spark, 200, 2, 5, hot=70)
    b, y = cloud(spark, 150, 2, 6, hot=50)
    pairs = ops.exact_similarity_join(a, b, "id", "id", "keys", 0.5)
    sizes = pairs.where("n_a = 70 AND n_b = 50").collect()
    assert len(sizes) == 1 and sizes[0].distance == 0.0
    assert expand(pairs, ops.members(a, "id", "keys"), ops.members(b, "id", "keys")) == brute(x, y, 0.5)


def test_frequent_bucket_is_cut_and_whole(spark):
    a, _ = cloud(spark, 200, 3, 7)
    model = ops.fit_lsh(a, "keys", bucket_length=100.0, tables=2, seed=1)
    ours = ops.similarity_join(model, a, a, "id", "keys", 0.8, self_join=True)
    library = model.approxSimilarityJoin(a, a, 0.8).filter("datasetA.id < datasetB.id")
    assert {(r.id_a, r.id_b) for r in ours.collect()} == {
        (r.datasetA.id, r.datasetB.id) for r in library.collect()}
    keyed = a.select("id", F.lit(1).alias("k"))
    cuts = ops._blocks(keyed, ["k"], "cuts").collect()
    assert [tuple(r) for r in cuts] == [(1, 64)]


def test_recall_on_embeddings(spark, folder):
    df = embeddings(spark, folder)
    values = np.array([r.features.toArray() for r in df.orderBy("vec_id").collect()])
    model = ops.fit_lsh(df, "features", bucket_length=0.5, tables=3, seed=1)
    found = ops.similarity_join(model, df, df, "vec_id", "features", 1.2, self_join=True).collect()
    truth = brute(values, values, 1.2, self_join=True)
    assert {(r.id_a, r.id_b) for r in found} <= truth
    assert len(found) >= 0.85 * len(truth)


def test_hashed_rows_join_like_raw_ones(spark):
    a, _ = cloud(spark, 80, 4, 11)
    b, _ = cloud(spark, 60, 4, 12)
    model = ops.fit_lsh(a, "keys", bucket_length=0.7, tables=2, seed=3)
    raw = ops.similarity_join(model, a, b, "id", "keys", 1.0).collect()
    hashed = ops.similarity_join(model, ops.lsh_hash(model, a), ops.lsh_hash(model, b), "id", "keys", 1.0).collect()
    assert raw and sorted(raw) == sorted(hashed)
    key = Vectors.dense(0.1, 0.2, 0.3, 0.4)
    left, right = (sorted((r.id, r.distCol) for r in ops.nearest(model, x, key, 5).collect())
                   for x in (a, ops.lsh_hash(model, a)))
    assert left == right
    lsh = ops.fit_compound_lsh(a, "keys", 0.6)
    raw, hashed = (sorted(ops.compound_join(lsh, f(a), f(b), "id", "keys", 0.6).collect())
                   for f in (lambda x: x, lambda x: ops.lsh_hash(lsh.model, x)))
    assert raw and raw == hashed


@pytest.mark.parametrize("length", [0.05, 0.5, 50.0])
def test_nearest_is_exact_and_never_short(spark, length):
    a, x = cloud(spark, 300, 6, 21, hot=40)
    model = ops.fit_lsh(a, "keys", bucket_length=length, tables=3, seed=2)
    for key, k in ((x[77], 9), (np.full(6, 0.25), 60), (np.full(6, 9.0), 1), (x[3], 500)):
        gaps = np.sqrt(((x - key) ** 2).sum(-1))
        truth = sorted(zip(gaps.round(9), range(300)))[:k]
        found = ops.nearest(model, a, Vectors.dense(key), k, ties="id").collect()
        assert [(round(r.distCol, 9), r.id) for r in found] == [(float(d), i) for d, i in truth]
    assert ops.nearest(model, a.limit(0), Vectors.dense(x[0]), 3).collect() == []


def test_nearest_does_not_sort_the_table(spark):
    a, x = cloud(spark, 100, 3, 4)
    found = ops.nearest(ops.fit_lsh(a, "keys"), a, Vectors.dense(x[0]), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.fixture(scope="module")
def texts(spark):
    return {size: _text_vectors(spark, f"/root/testdata/{size}").cache() for size in ("sf0.01", "sf0.1")}


def test_compound_join_finds_near_documents(texts):
    df = texts["sf0.01"]
    rows = df.orderBy("doc_id").collect()
    values, ids = np.array([r.features.toArray() for r in rows]), [r.doc_id for r in rows]
    lsh = ops.fit_compound_lsh(df, "features", 0.3)
    pairs = ops.compound_join(lsh, df, df, "doc_id", "features", 0.3, self_join=True)
    member = ops.members(df, "doc_id", "features")
    a = member.select(F.col("id").alias("id_a"), F.col("member").alias("x"))
    b = member.select(F.col("id").alias("id_b"), F.col("member").alias("y"))
    found = {tuple(r) for r in pairs.join(a, "id_a").join(b, "id_b").where(
        "id_a < id_b OR x < y").selectExpr("least(x, y)", "greatest(x, y)").collect()}
    squares = (values**2).sum(1)
    gaps = np.sqrt(np.maximum(0, squares[:, None] + squares - 2 * values @ values.T))
    truth = {(ids[i], ids[j]) for i, j in zip(*np.where(gaps < 0.3 - 1e-6)) if i < j}
    wide = {(ids[i], ids[j]) for i, j in zip(*np.where(gaps < 0.3 + 1e-6)) if i < j}
    assert found <= wide and len(found & truth) >= 0.95 * len(truth) > 300


def test_candidates_per_row_stay_level(texts):
    """Random partners, that is those beyond twice the threshold; near ones are the work itself."""
    shares = {}
    for size, df in texts.items():
        lsh = ops.fit_compound_lsh(df, "features", 0.3)
        rows = stored(ops._hashed(lsh.model, df, "doc_id", "features").select(
            "id", "v", lsh.keys(F.col("h")).alias("keys")), "keys")
        pairs = ops.compound_candidates(lsh, rows.select("id", "keys"), rows.select("id", "keys"), self_join=True)
        a, b = (rows.select(F.col("id").alias(f"id_{tag}"), F.col("v").alias(f"v_{tag}")) for tag in "ab")
        far = vx.squared_distance(F.col("v_a"), F.col("v_b")) > 0.6**2
        shares[size] = pairs.join(a, "id_a").join(b, "id_b").where(far).count() / rows.count()
    assert shares["sf0.1"] < 2 * shares["sf0.01"] + 1, shares
    assert shares["sf0.01"] < 40, shares


def test_compound_join_of_copies_and_a_full_bucket(spark):
    a, x = cloud(spark, 400, 8, 31, hot=150)
    values = np.concatenate([x, x[150:300] + 0.01])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "id int, a array<double>").select(
        "id", vx.as_vector(F.col("a")).alias("keys"))
    lsh = ops.fit_compound_lsh(df, "keys", 0.2)
    rows = {(r.id_a, r.id_b): (r.n_a, r.n_b) for r in ops.compound_join(
        lsh, df, df, "id", "keys", 0.2, self_join=True).collect()}
    assert rows[(0, 0)] == (150, 150)
    assert sum((i, i + 250) in rows for i in range(150, 300)) >= 148
    assert ops.compound_join(lsh, df.limit(0), df, "id", "keys", 0.2).collect() == []


def test_keys_take_the_hashes_once(spark):
    """What makes the hashes of a row is not worked out again for each table."""
    a, _ = cloud(spark, 20, 4, 3)
    lsh = ops.CompoundLSH(ops.fit_lsh(a, "keys", tables=12), 3, 4)
    made = spark.range(2).select("id", F.transform(F.array_repeat("id", 12), lambda x: x * 7).alias("h"))
    keys = made.select("id", lsh.keys(F.col("h")).alias("keys"))
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("array_repeat") < plan.index("slice(")
    assert all(len(set(row.keys)) == 4 for row in keys.collect())


def test_compound_join_shuffles_no_candidates(spark):
    """Vectors meet in their buckets: one join, and each pair once, however many keys it shares."""
    a, x = cloud(spark, 300, 6, 41, hot=20)
    df = a.union(a.select((F.col("id") + 300).alias("id"), vx.as_vector(F.transform(
        vx.vector_to_array("keys"), lambda v: v + F.col("id") * 1e-5)).alias("keys")))
    lsh = ops.fit_compound_lsh(df, "keys", 0.4)
    pairs = ops.compound_join(lsh, df, df, "id", "keys", 0.4, self_join=True)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Distinct" not in plan and "Aggregate" not in plan
    rows = pairs.collect()
    assert len(rows) == len({(r.id_a, r.id_b) for r in rows})
    assert sum((i, i + 300) in {(r.id_a, r.id_b) for r in rows} for i in range(20, 300)) >= 270


@pytest.mark.parametrize("self_join", [True, False])
def test_compound_join_ships_a_row_once_a_block(spark, monkeypatch, self_join):
    """However many tables there are, and the same pairs with many blocks in several rounds."""
    a, x = cloud(spark, 240, 6, 51, hot=20)
    b = a if self_join else cloud(spark, 90, 6, 52)[0]
    a = a.select(F.when(F.col("id") != 30, F.col("id")).alias("id"), "keys")
    lsh = ops.CompoundLSH(ops.fit_lsh(a, "keys", bucket_length=0.8, tables=60), 2, 30)
    join = lambda: ops.compound_join(lsh, a, b, "id", "keys", 0.9, self_join=self_join)
    one = join()
    assert "posexplode" not in one._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(ops, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(ops, "ROUND", 4)
    sort = lambda rows: sorted(rows, key=str)
    assert sort(one.collect()) == sort(join().collect())
    shared = {r.id: set(r.k) for df in (a, b) for r in lsh.model.transform(df).select(
        "id", lsh.keys(ops._hashes(lsh.model)).alias("k")).collect()}
    rows = one.where("id_a IS NOT NULL AND id_a != id_b" if self_join else "id_a IS NOT NULL").collect()
    assert len(rows) == len({(r.id_a, r.id_b) for r in rows}) > 20
    if self_join:
        gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        truth = {(i, j) for i in range(240) for j in range(i + 1, 240)
                 if gaps[i, j] < 0.9 and shared.get(i, set()) & shared.get(j, set()) and 30 not in (i, j) and not 0 < i < 20 and not 0 < j < 20}
        assert {(r.id_a, r.id_b) for r in rows} == truth
