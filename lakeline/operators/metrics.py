"""Scores of predictions, each as a one-row DataFrame."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accuracy(label: str = "label", prediction: str = "prediction") -> Column:
    """Share of rows whose prediction is the label."""
    return F.avg((F.col(label) == F.col(prediction)).cast("double"))


def rmse(label: str = "label", prediction: str = "prediction") -> Column:
    """Root of the mean squared difference."""
    gap = F.col(label) - F.col(prediction)
    return F.sqrt(F.avg(gap * gap))


def metric(
    df: DataFrame, name: str, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``(metric, value)`` for ``accuracy``, ``error`` or ``rmse``."""
    value = {
        "accuracy": lambda: accuracy(label, prediction),
        "error": lambda: 1 - accuracy(label, prediction),
        "rmse": lambda: rmse(label, prediction),
    }[name]()
    return df.agg(value.alias("value")).select(F.lit(name).alias("metric"), "value")


def area_under_roc(df: DataFrame, label: str = "label", score: str = "rawPrediction") -> DataFrame:
    """Exact area under the ROC curve; ``score`` is a number or a raw prediction vector.

    Rows of equal score are combined before the sort, and no score is binned.
    """
    value = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0
    ).evaluate(df)
    return df.sparkSession.createDataFrame([("areaUnderROC", value)], "metric string, value double")


def residuals(
    df: DataFrame, *keep: str, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Label minus prediction per row, next to the row's own columns."""
    return df.select(*keep, (F.col(label) - F.col(prediction)).alias("residual"))


def deviance_residuals(
    df: DataFrame, *keep: str, family: str = "gaussian", label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``(keep..., residual)``: signed root of each row's share of the deviance of a generalised linear fit.

    Their squares add up to the deviance. ``prediction`` is the mean, as a scored table has it.
    """
    y, mean = F.col(label), F.col(prediction)

    def y_log_ratio(a: Column, b: Column) -> Column:
        return F.when(a == 0, F.lit(0.0)).otherwise(a * F.log(a / b))

    deviance = {
        "gaussian": lambda: (y - mean) * (y - mean),
        "poisson": lambda: 2 * (y_log_ratio(y, mean) - (y - mean)),
        "binomial": lambda: 2 * (y_log_ratio(y, mean) + y_log_ratio(1 - y, 1 - mean)),
        "gamma": lambda: 2 * ((y - mean) / mean - F.log(y / mean)),
    }[family]()
    # rounding may leave a share just below zero
    return df.select(*keep, (F.signum(y - mean) * F.sqrt(F.greatest(deviance, F.lit(0.0)))).alias("residual"))
