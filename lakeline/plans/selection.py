"""Model selection."""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lakeline.operators import metrics
from lakeline.operators import selection as ops
from lakeline.operators.tables import key_split
from lakeline.plans.registry import SQL_TEXT_SIZES, labelled_text, query, rounded, text_sizes
from lakeline.session import cached
from lakeline.sources.files import table


def _regression_choice(train):
    model = LinearRegression(maxIter=10)
    settings = ops.grid({
        model.regParam: [0.1, 0.01],
        model.fitIntercept: [True, False],
        model.elasticNetParam: [0.0, 0.5, 1.0],
    })
    return ops.train_validation_split(
        train, model, settings, RegressionEvaluator(metricName="rmse"), ratio=0.8, seed=12345
    )


@query("grid_metrics")
def grid_metrics(spark, folder):
    with cached(text_sizes(spark, folder)) as data:
        train, _ = key_split(data, "doc_id", 10, 9)
        return ops.grid_metrics(data, _regression_choice(train))


@query("train_validation_split")
def train_validation_split(spark, folder):
    with cached(text_sizes(spark, folder)) as data:
        train, test = key_split(data, "doc_id", 10, 9)
        chosen = _regression_choice(train)
        best = chosen.bestModel
        return chosen.transform(test).agg(
            F.count(F.lit(1)).alias("n_test"), metrics.rmse().alias("rmse"),
            F.lit(best.getRegParam()).alias("reg_param"),
            F.lit(best.getFitIntercept()).alias("fit_intercept"),
            F.lit(best.getElasticNetParam()).alias("elastic_net"),
        )


SIZES = (10, 100, 1000)


def _text_choice(spark, folder):
    """Six settings on two folds; words are hashed once into each size, outside the search."""
    rows = ops.with_folds(labelled_text(spark, folder), "doc_id")
    words = Tokenizer(inputCol="text", outputCol="words").transform(rows)
    for size in SIZES:
        words = HashingTF(numFeatures=size, inputCol="words", outputCol=f"hashed{size}").transform(words)
    rows = words.select("doc_id", "label", "fold", *(f"hashed{size}" for size in SIZES))
    train, test = key_split(rows, "doc_id")
    model = LogisticRegression(maxIter=10)
    settings = ops.grid({model.featuresCol: [f"hashed{size}" for size in SIZES], model.regParam: [0.1, 0.01]})
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    return ops.cross_validate(train, model, settings, evaluator, folds=2, fold="fold"), test


@query("cross_validate")
def cross_validate(spark, folder):
    chosen, test = _text_choice(spark, folder)
    return chosen.transform(test).agg(
        F.count(F.lit(1)).alias("n_test"), metrics.accuracy().alias("accuracy"),
        F.lit(max(chosen.avgMetrics)).alias("best_auc"),
    )


@query("cross_validate_settings")
def cross_validate_settings(spark, folder):
    chosen, _ = _text_choice(spark, folder)
    return ops.grid_metrics(table(spark, folder, "labels"), chosen)


RIDGE = (0.0, 100.0, 1000.0)


@query(
    "cross_validate_ridge",
    f"WITH {SQL_TEXT_SIZES}, rows AS (SELECT x, y, doc_id % 3 AS fold FROM sizes), "
    f"settings AS (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS setting, unnest([{', '.join(map(str, RIDGE))}]) AS shrink), "
    "m AS (SELECT f.fold, corr(y, x) AS r, stddev_pop(x) AS sx, stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my "
    "FROM (SELECT unnest([0, 1, 2]) AS fold) f JOIN rows ON rows.fold <> f.fold GROUP BY f.fold), "
    "b AS (SELECT fold, setting, r / (1 + shrink / sy) * sy / sx AS slope, mx, my FROM m, settings), "
    "e AS (SELECT setting, fold, sqrt(avg((y - my - slope * (x - mx)) ** 2)) AS rmse "
    "FROM b JOIN rows USING (fold) GROUP BY setting, fold) "
    "SELECT setting, 'regParam=' || shrink AS params, round(avg(rmse), 3) AS metric "
    "FROM e JOIN settings USING (setting) GROUP BY ALL",
)
def cross_validate_ridge(spark, folder):
    """Every setting of a one-feature ridge fit, over three folds by document number."""
    with cached(ops.with_folds(text_sizes(spark, folder), "doc_id", 3, hashed=False)) as data:
        model = LinearRegression(solver="normal", elasticNetParam=0.0)
        chosen = ops.cross_validate(
            data, model, ops.grid({model.regParam: list(RIDGE)}), RegressionEvaluator(metricName="rmse"),
            folds=3, fold="fold")
        return ops.grid_metrics(data, chosen).withColumn("metric", rounded(F.col("metric"), 3))
