import random

import numpy as np
from pyspark.sql import functions as F

from lakeline.llm import boosting, personal


def test_all_spans_are_learned_from(spark, monkeypatch):
    """More documents and spans than any sample held: all count, two thirds for trees, the rest for thresholds."""
    pick = random.Random(4)

    def text():
        word = "".join(pick.choice("abcdefgh") for _ in range(8))
        card = f"{pick.randint(10**15, 10**16 - 1)}"
        return f"a{pick.randint(0, 9)}@{word}.com x@{word} call +1 555 {pick.randint(1000000, 9999999)} no {card} host 10.0.0.{pick.randint(0, 400)}"

    rows = [(at, text()) for at in range(4500)] + [(None, text()), (7, None)]
    seen = {}

    def spy(name, function):
        def run(table, *rest):
            seen[name] = table.agg(F.sum("n")).first()[0]
            return function(table, *rest)

        monkeypatch.setattr(personal, name, run)

    spy("fit_table", boosting.fit_table)
    spy("lowest_levels", boosting.lowest_levels)
    monkeypatch.setattr(boosting, "TREES", 2)
    model = personal.learn(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    spans = sum(len(personal.proposals(text or "")) for _, text in rows)
    assert spans > 20_000 and sum(seen.values()) == spans
    assert abs(seen["lowest_levels"] / spans - 1 / 3) < 0.02
    assert len(model.trees.trees) == 2 and set(model.limits) == set(personal.PROPOSED)


def test_trees_over_a_table_are_those_on_arrays(spark):
    pick = np.random.default_rng(6)
    values = pick.integers(0, 9, (1500, 4)).astype(float)
    truth = ((values[:, 0] > 4) & (values[:, 2] < 6) | (pick.random(1500) < 0.05))
    rows = spark.createDataFrame(
        [(row.tolist(), at % 2, False, bool(t)) for at, (row, t) in enumerate(zip(values, truth))],
        "values array<double>, kind int, held boolean, truth boolean").repartition(4)
    cuts = boosting.quantile_cuts(rows, 4)
    table = boosting.binned(rows, cuts).cache()
    assert table.agg(F.sum("n")).first()[0] == 1500
    trees, chances = boosting.fit_table(table, cuts)
    scores = trees.score(values)
    assert np.allclose(scores, boosting.fit(values, truth.astype(float)).score(values), atol=1e-3)
    levels = boosting.lowest_levels(table, chances, 4, 0.9, 20)
    for kind, level in levels.items():
        own = np.arange(1500) % 2 == kind
        assert truth[own][scores[own] >= level].mean() >= 0.9
        assert abs(level - boosting.threshold(scores[own], truth[own], 0.9, 20)) <= 1 / boosting.LEVELS
    assert set(levels) == {0, 1}
