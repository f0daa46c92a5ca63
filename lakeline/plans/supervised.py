"""Classification, regression, metrics and saved models."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import functions as F

from lakeline.functions import vectors as vx
from lakeline.operators import metrics
from lakeline.operators import supervised as ops
from lakeline.operators.tables import key_split
from lakeline.plans.registry import (
    SQL_TEXT_SIZES,
    embeddings,
    labelled_text,
    query,
    rounded,
    text_sizes,
)
from lakeline.session import cached, dealt, work_folder
from lakeline.sources.files import table


def _test_error(predictions, label, prediction):
    return predictions.agg(
        F.count(F.lit(1)).alias("n_test"),
        (1 - metrics.accuracy(label, prediction)).alias("error"),
    )


# classification


@query("logistic_regression")
def logistic_regression(spark, folder):
    train, test = key_split(embeddings(spark, folder), "vec_id")
    plain = ops.fit_logistic_regression(train)
    first, later = {"maxIter": 20, "probabilityCol": "chance"}, {
        "maxIter": 30, "regParam": 0.1,
    }
    merged = ops.fit_logistic_regression(train, {**first, **later})
    results = [
        ops.score(model, test).agg(
            F.count(F.lit(1)).alias("n_test"),
            metrics.accuracy().alias("accuracy"),
            F.max(F.array_max(vx.vector_to_array(probability))).alias("top_probability"),
        ).select(F.lit(name).alias("model"), "n_test", "accuracy", "top_probability")
        for name, model, probability in (
            ("plain", plain, "probability"), ("merged", merged, "chance"),
        )
    ]
    return results[0].union(results[1])


@query("logistic_threshold")
def logistic_threshold(spark, folder):
    """Good and bad documents by hashed words, at a stricter and a laxer threshold."""
    rows = labelled_text(spark, folder)
    words = Tokenizer(inputCol="text", outputCol="words").transform(rows)
    hashed = HashingTF(numFeatures=1000, inputCol="words", outputCol="features").transform(words)
    train, test = key_split(hashed.select("doc_id", "label", "features"), "doc_id")
    found = None
    for threshold in (0.55, 0.95):
        scored = ops.score(ops.fit_logistic_regression(train, threshold=threshold), test)
        row = scored.agg(
            F.lit(threshold).alias("threshold"), F.count(F.lit(1)).alias("n_test"),
            F.sum("prediction").cast("bigint").alias("n_good"), metrics.accuracy().alias("accuracy"))
        found = row if found is None else found.union(row)
    return found


@query(
    "logistic_class_shares",
    "SELECT CAST(label AS INTEGER) AS label, "
    "round(count(*) / CAST((SELECT count(*) FROM embeddings) AS DOUBLE), 4) AS share FROM embeddings GROUP BY label",
)
def logistic_class_shares(spark, folder):
    """A fit with intercepts gives each class, on average over its own rows, the share it has."""
    df = embeddings(spark, folder)
    model = ops.fit_logistic_regression(df, {"tol": 1e-9}, max_iter=200)
    chances = ops.score(model, df).select(F.posexplode(vx.vector_to_array("probability")).alias("label", "chance"))
    return chances.groupBy("label").agg(rounded(F.avg("chance"), 4).alias("share"))


def _tree_query(fit, data, row_id="vec_id"):
    train, test = key_split(data, row_id)
    model = fit(data, train)
    return _test_error(ops.score(model, test), "indexedLabel", "prediction")


@query("decision_tree_classifier")
def decision_tree_classifier(spark, folder):
    return _tree_query(ops.fit_decision_tree_classifier, embeddings(spark, folder))


@query("random_forest_classifier")
def random_forest_classifier(spark, folder):
    return _tree_query(ops.fit_random_forest_classifier, embeddings(spark, folder))


@query("gbt_classifier")
def gbt_classifier(spark, folder):
    df = embeddings(spark, folder)
    halves = df.withColumn("label", (F.col("label") >= 5).cast("double"))
    return _tree_query(ops.fit_gbt_classifier, halves)


@query("mlp_classifier")
def mlp_classifier(spark, folder):
    train, test = key_split(embeddings(spark, folder), "vec_id", 10, 6)
    model = ops.fit_mlp_classifier(train, [64, 5, 4, 10])
    return _test_error(ops.score(model, test), "label", "prediction")


@query("one_vs_rest")
def one_vs_rest(spark, folder):
    train, test = key_split(embeddings(spark, folder), "vec_id", 10, 8)
    return _test_error(ops.score(ops.fit_one_vs_rest(train), test), "label", "prediction")


SQL_BAYES = """
WITH items AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label,
    [l_quantity, round(l_discount * 100), round(l_tax * 100)] AS v FROM lineitem),
classes AS (SELECT label, count(*) AS n FROM items GROUP BY label),
sums AS (SELECT label, slot, sum(v[slot + 1]) AS s FROM items, (VALUES (0), (1), (2)) t(slot)
    GROUP BY label, slot),
totals AS (SELECT label, sum(s) AS s FROM sums GROUP BY label)
SELECT CAST(label AS INTEGER) AS label, -1 AS slot,
    round(ln(n + 1) - ln((SELECT sum(n) FROM classes) + 3), 6) AS value FROM classes
UNION ALL SELECT CAST(label AS INTEGER), slot, round(ln(sums.s + 1) - ln(totals.s + 3), 6)
FROM sums JOIN totals USING (label)
"""


@query("naive_bayes", SQL_BAYES)
def naive_bayes(spark, folder):
    items = table(spark, folder, "lineitem", "l_returnflag", "l_quantity", "l_discount", "l_tax")
    label = F.when(F.col("l_returnflag") == "A", 0.0).when(
        F.col("l_returnflag") == "N", 1.0
    ).otherwise(2.0)
    slots = F.array(
        "l_quantity", F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100)
    )
    model = ops.fit_naive_bayes(
        items.select(label.alias("label"), vx.as_vector(slots).alias("features"))
    )
    rows = [(at, -1, float(value)) for at, value in enumerate(model.pi)]
    rows += [
        (at, slot, float(value))
        for at, line in enumerate(model.theta.toArray())
        for slot, value in enumerate(line)
    ]
    learned = spark.createDataFrame(rows, "label int, slot int, value double")
    return learned.withColumn("value", rounded(F.col("value")))


# regression


SQL_OLS = (
    f"WITH {SQL_TEXT_SIZES}, fit AS (SELECT regr_slope(y, x) AS slope, "
    "regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2 FROM sizes) "
)


@query(
    "linear_regression",
    SQL_OLS + "SELECT round(slope, 5) AS slope, round(intercept, 3) AS intercept, "
    "round(r2, 6) AS r2, round((SELECT sqrt(avg((y - intercept - slope * x) ** 2)) "
    "FROM sizes), 3) AS rmse FROM fit",
)
def linear_regression(spark, folder):
    model = ops.fit_linear_regression(
        text_sizes(spark, folder), reg_param=0.0, elastic_net=0.0, solver="normal"
    )
    return _linear_row(spark, model)


def _linear_row(spark, model):
    fit = model.summary
    row = (float(model.coefficients[0]), model.intercept, fit.r2, fit.rootMeanSquaredError)
    return spark.createDataFrame(
        [row], "slope double, intercept double, r2 double, rmse double"
    ).select(
        rounded(F.col("slope"), 5).alias("slope"), rounded(F.col("intercept"), 3).alias("intercept"),
        rounded(F.col("r2")).alias("r2"), rounded(F.col("rmse"), 3).alias("rmse"),
    )


def _shrunk(shrink: str) -> str:
    """One-feature fit under a penalty: its standardised slope in closed form."""
    return (
        f"WITH {SQL_TEXT_SIZES}, m AS (SELECT corr(y, x) AS r, stddev_pop(x) AS sx, "
        "stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my, CAST(count(*) AS DOUBLE) AS n FROM sizes), "
        f"b AS (SELECT *, {shrink} * sy / sx AS slope FROM m), "
        "fit AS (SELECT *, my - slope * mx AS intercept FROM b), "
        "e AS (SELECT slope, intercept, n, n * sy * sy AS syy, "
        "(SELECT sum((y - intercept - slope * x) ** 2) FROM sizes) AS sse FROM fit) "
    )


@query(
    "linear_regression_elastic_net",
    _shrunk("sign(r) * greatest(abs(r) - 0.3 * 0.8 / sy, 0) / (1 + 0.3 * 0.2 / sy)")
    + "SELECT round(slope, 5) AS slope, round(intercept, 3) AS intercept, "
    "round(1 - sse / syy, 6) AS r2, round(sqrt(sse / n), 3) AS rmse FROM e",
)
def linear_regression_elastic_net(spark, folder):
    return _linear_row(spark, ops.fit_linear_regression(text_sizes(spark, folder)))


def _glm_rows(model):
    fit = model.summary
    errors, t_values = fit.coefficientStandardErrors, fit.tValues
    return [
        ("slope", float(model.coefficients[0]), 5), ("intercept", float(model.intercept), 3),
        ("slope_error", float(errors[0]), 6), ("intercept_error", float(errors[1]), 4),
        ("slope_t", float(t_values[0]), 3), ("intercept_t", float(t_values[1]), 4),
        ("dispersion", fit.dispersion, 2), ("null_deviance", fit.nullDeviance, 0),
        ("deviance", fit.deviance, 0), ("dof_null", float(fit.residualDegreeOfFreedomNull), 0),
        ("dof", float(fit.residualDegreeOfFreedom), 0), ("aic", fit.aic, 3),
    ]


SQL_GLM = SQL_OLS + """, m AS (SELECT count(*)::DOUBLE AS n, avg(x) AS mx,
    sum((x - (SELECT avg(x) FROM sizes)) ** 2) AS sxx,
    sum((y - (SELECT avg(y) FROM sizes)) ** 2) AS syy FROM sizes),
e AS (SELECT slope, intercept, n, mx, sxx, syy,
    (SELECT sum((y - intercept - slope * x) ** 2) FROM sizes) AS sse FROM fit, m),
g AS (SELECT *, sqrt(sse / (n - 2) / sxx) AS se1,
    sqrt(sse / (n - 2) * (1 / n + mx * mx / sxx)) AS se0 FROM e)
SELECT name, value FROM (
    SELECT 'slope' AS name, round(slope, 5) AS value FROM g
    UNION ALL SELECT 'intercept', round(intercept, 3) FROM g
    UNION ALL SELECT 'slope_error', round(se1, 6) FROM g
    UNION ALL SELECT 'intercept_error', round(se0, 4) FROM g
    UNION ALL SELECT 'slope_t', round(slope / se1, 3) FROM g
    UNION ALL SELECT 'intercept_t', round(intercept / se0, 4) FROM g
    UNION ALL SELECT 'dispersion', round(sse / (n - 2), 2) FROM g
    UNION ALL SELECT 'null_deviance', round(syy, 0) FROM g
    UNION ALL SELECT 'deviance', round(sse, 0) FROM g
    UNION ALL SELECT 'dof_null', n - 1 FROM g
    UNION ALL SELECT 'dof', n - 2 FROM g
    UNION ALL SELECT 'aic', round(n * (ln(2 * pi() * sse / n) + 1) + 2 + 4, 3) FROM g)
""".replace("\n", " ")
SQL_GLM = SQL_GLM.replace("FROM sizes) , m AS", "FROM sizes), m AS")


@query("glm_gaussian", SQL_GLM)
def glm_gaussian(spark, folder):
    rows = _glm_rows(ops.fit_glm(text_sizes(spark, folder), reg_param=0.0))
    return spark.createDataFrame(
        [(name, round(value, digits) + 0.0) for name, value, digits in rows],
        "name string, value double",
    )


@query(
    "glm_deviance_residuals",
    SQL_OLS + "SELECT doc_id, round(y - intercept - slope * x, 3) AS residual FROM sizes, fit",
)
def glm_deviance_residuals(spark, folder):
    sizes = text_sizes(spark, folder)
    scored = ops.score(ops.fit_glm(sizes, reg_param=0.0), sizes)
    return metrics.deviance_residuals(scored, "doc_id").withColumn("residual", rounded(F.col("residual"), 3))


@query(
    "glm_coefficients",
    SQL_GLM.split("SELECT name, value FROM (")[0]
    # the chance by Simpson's rule over the density of Student's t
    + "SELECT name, round(value, 4) AS value, round(error, 5) AS error, round(value / error, 3) AS t, "
    "round(greatest(1 - 2 * width / 3 * sum(weight * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi()) "
    "* pow(1 + (i * width) ** 2 / dof, -(dof + 1) / 2)), 0), 9) AS p "
    "FROM (SELECT *, least(abs(value / error), 40) / 4000 AS width FROM ("
    "SELECT 'slope0' AS name, slope AS value, se1 AS error, n - 2 AS dof FROM g "
    "UNION ALL SELECT 'intercept', intercept, se0, n - 2 FROM g)), "
    "(SELECT i, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS weight "
    "FROM range(4001) AS steps(i)) GROUP BY name, value, error, width",
)
def glm_coefficients(spark, folder):
    sizes = text_sizes(spark, folder)
    rows = ops.coefficient_table(sizes, ops.fit_glm(sizes, reg_param=0.0))
    return rows.select(
        "name", rounded(F.col("value"), 4).alias("value"), rounded(F.col("error"), 5).alias("error"),
        rounded(F.col("t"), 3).alias("t"), rounded(F.col("p"), 9).alias("p"))


@query("linear_regression_history")
def linear_regression_history(spark, folder):
    sizes = text_sizes(spark, folder)
    return ops.fit_history(sizes, ops.fit_linear_regression(sizes, solver="l-bfgs"))


SQL_RIDGE = _shrunk("r / (1 + 0.3 / sy)") + """SELECT name, value FROM (
    SELECT 'slope' AS name, round(slope, 5) AS value FROM e
    UNION ALL SELECT 'intercept', round(intercept, 3) FROM e
    UNION ALL SELECT 'dispersion', round(sse / (n - 2), 2) FROM e
    UNION ALL SELECT 'null_deviance', round(syy, 0) FROM e
    UNION ALL SELECT 'deviance', round(sse, 0) FROM e
    UNION ALL SELECT 'dof_null', n - 1 FROM e
    UNION ALL SELECT 'dof', n - 2 FROM e
    UNION ALL SELECT 'aic', round(n * (ln(2 * pi() * sse / n) + 1) + 2 + 4, 3) FROM e)
""".replace("\n", " ")


@query("glm_gaussian_ridge", SQL_RIDGE)
def glm_gaussian_ridge(spark, folder):
    rows = _glm_rows(ops.fit_glm(text_sizes(spark, folder)))
    return spark.createDataFrame(
        [(name, round(value, digits) + 0.0) for name, value, digits in rows
         if not name.endswith(("_error", "_t"))],
        "name string, value double",
    )


def _regression_query(fit, data):
    train, test = key_split(data, "doc_id")
    model = fit(data, train)
    return ops.score(model, test).agg(
        F.count(F.lit(1)).alias("n_test"), metrics.rmse().alias("rmse")
    )


@query(
    "decision_tree_two_means",
    "SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS flag, "
    "round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1",
)
def decision_tree_two_means(spark, folder):
    """A tree over one column of two values predicts the mean of either side."""
    flag = (F.col("l_returnflag") == "R").cast("double")
    rows = dealt(table(spark, folder, "lineitem", "l_returnflag", "l_quantity")).select(
        F.col("l_quantity").cast("double").alias("label"), flag.alias("flag"),
        vx.as_vector(F.array(flag)).alias("features"))
    model = ops.fit_decision_tree_regressor(rows, rows, maxDepth=1)
    return ops.score(model, rows).groupBy("flag").agg(rounded(F.max("prediction")).alias("mean"))


@query("decision_tree_regressor")
def decision_tree_regressor(spark, folder):
    with cached(text_sizes(spark, folder)) as data:
        return _regression_query(ops.fit_decision_tree_regressor, data)


@query("random_forest_regressor")
def random_forest_regressor(spark, folder):
    with cached(text_sizes(spark, folder)) as data:
        return _regression_query(ops.fit_random_forest_regressor, data)


@query(
    "residual_table",
    SQL_OLS + "SELECT doc_id, round(y - intercept - slope * x, 3) + 0.0 AS residual "
    "FROM sizes, fit",
)
def residual_table(spark, folder):
    data = text_sizes(spark, folder)
    model = ops.fit_linear_regression(data, reg_param=0.0, elastic_net=0.0, solver="normal")
    left = metrics.residuals(ops.score(model, data), "doc_id")
    return left.select("doc_id", rounded(F.col("residual"), 3).alias("residual"))


# text models and saved models


@query("text_model")
def text_model(spark, folder):
    train, test = key_split(labelled_text(spark, folder), "doc_id")
    model = ops.fit_with(ops.text_stages(), train)
    return _test_error(ops.score(model, test), "label", "prediction")


@query(
    "save_model",
    "SELECT * FROM (VALUES ('fitted', 0, 'Tokenizer'), ('fitted', 1, 'HashingTF'), "
    "('fitted', 2, 'LogisticRegressionModel'), ('unfitted', 0, 'Tokenizer'), "
    "('unfitted', 1, 'HashingTF'), ('unfitted', 2, 'LogisticRegression')) "
    "AS saved(kind, place, stage)",
)
def save_model(spark, folder):
    path = work_folder(spark, "models")
    stages = ops.text_stages()
    ops.save_model(ops.fit_with(stages, labelled_text(spark, folder)), f"{path}/fitted")
    ops.save_model(stages, f"{path}/unfitted")
    fitted = ops.load_model(f"{path}/fitted").stages
    unfitted = ops.load_model(f"{path}/unfitted", Pipeline).getStages()
    rows = [
        (kind, at, type(stage).__name__)
        for kind, saved in (("fitted", fitted), ("unfitted", unfitted))
        for at, stage in enumerate(saved)
    ]
    return spark.createDataFrame(rows, "kind string, place int, stage string")


@query(
    "load_model",
    "SELECT count(*) AS n, CAST(0 AS BIGINT) AS differences "
    "FROM documents JOIN labels USING (doc_id)",
)
def load_model(spark, folder):
    data = labelled_text(spark, folder)
    model = ops.fit_with(ops.text_stages(), data)
    path = work_folder(spark, "model")
    ops.save_model(model, path)
    kept = ["prediction", "probability"]
    first = model.transform(data).select(
        "doc_id", "text", F.struct(*kept).alias("first")
    )
    second = ops.load_model(path).transform(first).select("first", F.struct(*kept).alias("second"))
    apart = (F.col("first.prediction") != F.col("second.prediction")) | (
        vx.vector_to_array("first.probability") != vx.vector_to_array("second.probability")
    )
    return second.agg(F.count(F.lit(1)).alias("n"), F.count_if(apart).alias("differences"))


# metrics


@query(
    "eval_accuracy",
    "SELECT 'accuracy' AS metric, round(avg(CASE WHEN quality = 1 - toxic THEN 1.0 ELSE 0.0 END), 6) "
    "AS value FROM labels",
)
def eval_accuracy(spark, folder):
    labels = table(spark, folder, "labels", "quality", "toxic").select(
        F.col("quality").cast("double").alias("label"),
        (1.0 - F.col("toxic")).alias("prediction"),
    )
    return metrics.metric(labels, "accuracy").withColumn("value", rounded(F.col("value")))


@query(
    "eval_rmse",
    "SELECT 'rmse' AS metric, round(sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2)), 4) "
    "AS value FROM lineitem",
)
def eval_rmse(spark, folder):
    items = table(spark, folder, "lineitem", "l_extendedprice", "l_quantity").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction")
    )
    return metrics.metric(items, "rmse").withColumn("value", rounded(F.col("value"), 4))


@query(
    "eval_auc",
    "WITH scored AS (SELECT l_linestatus = 'O' AS positive, l_extendedprice AS score "
    "FROM lineitem), "
    "ranked AS (SELECT positive, rank() OVER (ORDER BY score) + "
    "(count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM scored), "
    "sums AS (SELECT sum(place) FILTER (WHERE positive) AS places, "
    "CAST(count(*) FILTER (WHERE positive) AS DOUBLE) AS p, "
    "CAST(count(*) FILTER (WHERE NOT positive) AS DOUBLE) AS q FROM ranked) "
    "SELECT 'areaUnderROC' AS metric, round((places - p * (p + 1) / 2) / (p * q), 6) AS value "
    "FROM sums",
)
def eval_auc(spark, folder):
    scored = dealt(table(spark, folder, "lineitem", "l_linestatus", "l_extendedprice")).select(
        (F.col("l_linestatus") == "O").cast("double").alias("label"),
        F.col("l_extendedprice").alias("score"),
    )
    value = metrics.area_under_roc(scored, score="score")
    return value.withColumn("value", rounded(F.col("value")))
