from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lakeline.operators import features as ft
from lakeline.operators import topics as ops

SIZE = 60


@pytest.fixture(scope="module")
def corpus(spark):
    """Rows of two kinds with terms of their own, a row without any, ids that repeat or are null."""
    rng = np.random.default_rng(5)
    rows = []
    for at in range(300):
        slots = rng.choice(np.arange(at % 2, SIZE, 2), 12, replace=False)
        rows.append((at, Vectors.sparse(SIZE, {int(slot): float(rng.integers(1, 5)) for slot in slots})))
    rows += [(0, rows[0][1]), (None, rows[1][1]), (None, Vectors.sparse(SIZE, [], []))]
    return spark.createDataFrame(rows, ["id", "features"]).repartition(3).cache()


def shares(model, corpus):
    rows = ops.topic_mixture(model, corpus, "id").groupBy("id", "topic").agg(F.sum("weight").alias("w")).collect()
    return {(row.id, row.topic): row.w for row in rows}


def test_a_vocabulary_beyond_the_head_gives_the_same_topics(spark, corpus, monkeypatch):
    monkeypatch.setattr(ops, "DRAWN", 8)
    monkeypatch.setattr(ops, "SHARE", 0.3)
    monkeypatch.setattr(ops, "HEAD", 64)
    whole = ops.fit_lda(corpus, k=2, max_iter=6)
    monkeypatch.setattr(ops, "HEAD", 8)
    parted = ops.fit_lda(corpus, k=2, max_iter=6)
    assert whole.tail is None and len(whole.head) == SIZE
    assert len(parted.head) == 8 and parted.tail.count() == SIZE - 8
    tail = np.array([tuple(row)[1:] for row in parted.tail.orderBy("pos").collect()])
    assert np.allclose(np.vstack((parted.head, tail)), whole.head, rtol=1e-6)
    assert np.allclose(parted.alpha, whole.alpha, rtol=1e-6) and np.allclose(parted.totals, whole.totals, rtol=1e-9)
    one, other = shares(whole, corpus), shares(parted, corpus)
    assert one.keys() == other.keys() and all(abs(one[key] - other[key]) < 1e-6 for key in one)
    assert abs(ops.lda_quality(whole, corpus).first()[0] - ops.lda_quality(parted, corpus).first()[0]) < 1e-3
    terms = spark.createDataFrame([(pos, f"t{pos}") for pos in range(SIZE)], "pos int, term string")
    assert ops.topic_terms(whole, terms, 5).drop("weight").exceptAll(ops.topic_terms(parted, terms, 5).drop("weight")).count() == 0


def test_as_good_as_the_library(corpus):
    counts = corpus.where("id IS NOT NULL")
    ours = ops.fit_lda(counts, k=2, max_iter=20)
    library = LDA(k=2, maxIter=20, seed=1).fit(counts)
    bound = ops.log_likelihood(ours, ops._entries(counts, "features"))
    assert abs(bound / library.logLikelihood(counts) - 1) < 0.02
    # the library's own topics, looked at by ours
    same = replace(ours, head=library.topicsMatrix().toArray(), totals=library.topicsMatrix().toArray().sum(0),
                   alpha=np.array(library.estimatedDocConcentration()))
    assert abs(ops.log_likelihood(same, ops._entries(counts, "features")) / library.logLikelihood(counts) - 1) < 1e-4
    theirs = {row.id: row.topicDistribution[0] for row in library.transform(counts).collect()}
    own = {row.id: row.weight for row in ops.topic_mixture(same, counts, "id").where("topic = 0").collect()}
    assert np.mean([abs(theirs[key] - own[key]) < 0.02 for key in theirs]) > 0.98


def test_special_functions():
    x = np.array([0.01, 0.1, 1.0, 2.5, 40.0, 1e6])
    step = 1e-5 * x
    assert np.allclose((ops.log_gamma(x + step) - ops.log_gamma(x - step)) / (2 * step), ops.digamma(x), rtol=1e-4, atol=1e-4)
    assert np.allclose((ops.digamma(x + step) - ops.digamma(x - step)) / (2 * step), ops.trigamma(x), rtol=1e-3)
    assert abs(ops.digamma(1.0) + 0.5772156649015329) < 1e-9 and np.allclose(ops.log_gamma(np.array([1.0, 2.0, 5.0])), [0, 0, np.log(24)])


def test_shares_of_rows_of_all_lengths():
    """Rows that are filled up get what each gets on its own."""
    rng = np.random.default_rng(3)
    sizes = np.append(rng.integers(1, 90, 40), [1, 700])
    owner, alpha = np.repeat(np.arange(len(sizes)), sizes), np.array([0.1, 0.3, 0.5])
    block = ops._Block(np.arange(len(sizes)), owner, owner, rng.integers(1, 5, len(owner)).astype(float),
                       np.log(rng.dirichlet(np.ones(3), len(owner))))
    found = ops._shares(block, alpha)
    for row in range(len(sizes)):
        beta, n, now = np.exp(block.log_beta[owner == row]), block.n[owner == row], np.ones(3)
        while True:
            theta = np.exp(ops.digamma(now) - ops.digamma(now.sum()))
            before, now = now, theta * (beta.T @ (n / (beta @ theta + 1e-100))) + alpha
            if np.abs(now - before).mean() <= 1e-3:
                break
        assert np.allclose(found[row], now, rtol=1e-9)


def test_the_tail_is_not_written_each_turn(spark, corpus, monkeypatch):
    written, keep = [], ops.Scratch.keep
    monkeypatch.setattr(ops.Scratch, "keep", lambda self, df, name: written.append(name) or keep(self, df, name))
    monkeypatch.setattr(ops, "DRAWN", 8)
    monkeypatch.setattr(ops, "HEAD", 8)
    monkeypatch.setattr(ops, "SHARE", 0.3)
    model = ops.fit_lda(corpus, k=2, max_iter=7)
    assert [name for name in written if name.isdigit()] == ["5", "7"]
    assert model.tail.count() == SIZE - 8 and not model.tail.storageLevel.useMemory


def test_text_does_not_travel_with_the_counts(spark):
    df = spark.createDataFrame([(1, ["a", "b"], "long"), (2, [], "text"), (3, ["a"], None)], "id int, words array<string>, text string")
    index = ft.fit_count_vectorizer(df, "id", "words", vocab_size=None)
    assert index.transform(df, "id").columns == ["id", "counts"] and index.transform(df).columns == ["id", "words", "text", "counts"]
    assert sorted(map(str, index.transform(df, "id").collect())) == sorted(map(str, index.transform(df).select("id", "counts").collect()))


def test_rows_are_counted_once(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, ["a"])], "id int, words array<string>")
    calls, rows = [], ft.term_rows
    monkeypatch.setattr(ft, "term_rows", lambda *a: calls.append(a) or rows(*a))
    index = ft.fit_count_vectorizer(df, "id", "words", vocab_size=None)
    same = index.transform(df, "id").collect()
    assert len(calls) == 1 and sorted(map(str, same)) == sorted(map(str, index.transform(df.select("*"), "id").collect()))
