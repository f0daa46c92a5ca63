"""Choosing parameters by held-out metrics."""

from __future__ import annotations

from typing import Any

from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.session import cached


def grid(choices: dict[Param, list[Any]]) -> list[dict]:
    """Every combination of the listed values."""
    builder = ParamGridBuilder()
    for param, values in choices.items():
        builder = builder.addGrid(param, values)
    return builder.build()


def with_folds(df: DataFrame, key: str, folds: int = 2, hashed: bool = True, out: str = "fold") -> DataFrame:
    """Add the fold of each row, by key: the same on every run, machine and partitioning.

    ``hashed`` spreads keys of any kind; without it a dense integer key is taken as it is. NULL keys are in fold 0.
    """
    slot = F.pmod(F.xxhash64(key) if hashed else F.col(key), F.lit(folds))
    return df.withColumn(out, F.coalesce(slot, F.lit(0)).cast("int"))


def cross_validate(
    train: DataFrame, estimator: Estimator, settings: list[dict], evaluator: Evaluator,
    folds: int = 2, seed: int = 1, parallelism: int = 4, fold: str | None = None,
):
    """K-fold choice; the best setting is fitted again on all rows.

    With ``fold``, a column from ``with_folds``, rows are held out by it and not at random. What is
    the same for all settings belongs in ``train`` and not in ``estimator``: there it is worked out once, and not
    for every setting and fold.
    """
    with cached(train) as rows:
        search = CrossValidator(
            estimator=estimator, estimatorParamMaps=settings, evaluator=evaluator,
            numFolds=folds, seed=seed, parallelism=parallelism,
        )
        return (search.setFoldCol(fold) if fold else search).fit(rows)


def train_validation_split(
    train: DataFrame, estimator: Estimator, settings: list[dict], evaluator: Evaluator,
    ratio: float = 0.8, seed: int = 1, parallelism: int = 4,
):
    """One split choice; the best setting is fitted again on all rows."""
    with cached(train) as rows:
        return TrainValidationSplit(
            estimator=estimator, estimatorParamMaps=settings, evaluator=evaluator,
            trainRatio=ratio, seed=seed, parallelism=parallelism,
        ).fit(rows)


def grid_metrics(df: DataFrame, model) -> DataFrame:
    """``(setting, params, metric)``: one row per setting of a fitted choice."""
    metrics = getattr(model, "avgMetrics", None) or model.validationMetrics
    rows = [
        (at, ", ".join(f"{p.name}={v}" for p, v in setting.items()), float(value))
        for at, (setting, value) in enumerate(zip(model.getEstimatorParamMaps(), metrics))
    ]
    return df.sparkSession.createDataFrame(rows, "setting int, params string, metric double")
