"""Classification and regression.

``fit_*`` functions take a training table and give a fitted model;
``score`` applies it. Inputs of iterative fits are cached while they run.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    HashingTF,
    IndexToString,
    StringIndexer,
    Tokenizer,
    VectorIndexer,
)
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame

from lakeline.session import cached, shared_root


def by_param(stage: Estimator | Transformer, values: dict[str, Any]) -> dict:
    """A parameter map from names; merge maps with ``{**first, **later}``."""
    return {stage.getParam(name): value for name, value in values.items()}


def fit_with(estimator: Estimator, train: DataFrame, overrides: dict[str, Any] | None = None):
    """Fit, under overridden parameters if given; later values win."""
    with cached(train) as rows:
        return estimator.fit(rows, by_param(estimator, overrides or {}))


def score(model: Transformer, df: DataFrame, overrides: dict[str, Any] | None = None) -> DataFrame:
    """Apply a model, under overridden parameters if given."""
    return model.transform(df, by_param(model, overrides or {}))


def fit_logistic_regression(
    train: DataFrame, overrides: dict[str, Any] | None = None, max_iter: int = 10,
    reg_param: float = 0.01, threshold: float | None = None,
):
    """Logistic regression over any number of classes.

    ``threshold`` is the probability of class 1 above which a row is given it. It says nothing
    about more than two classes, and is refused there.
    """
    estimator = LogisticRegression(maxIter=max_iter, regParam=reg_param)
    if threshold is not None:
        overrides = {"threshold": threshold, **(overrides or {})}
    model = fit_with(estimator, train, overrides)
    if "threshold" in (overrides or {}) and model.numClasses > 2:
        raise ValueError(f"a threshold is for two classes, the labels have {model.numClasses}")
    return model


def _fit_indexed(
    data: DataFrame, train: DataFrame, model: Estimator, label: str, features: str,
    max_categories: int, classes: bool,
) -> PipelineModel:
    """Index features, and labels of classes, over all of ``data``, then fit on ``train``.

    Dictionaries from all rows leave no label unseen in a test part.
    """
    shared_root(data.sparkSession)
    with cached(data.select(label, features)) as rows:
        vector_index = VectorIndexer(
            inputCol=features, outputCol="indexedFeatures", maxCategories=max_categories
        ).fit(rows)
        stages = [vector_index, model]
        if classes:
            labels = StringIndexer(inputCol=label, outputCol="indexedLabel").fit(rows)
            names = IndexToString(
                inputCol="prediction", outputCol="predictedLabel", labels=labels.labels
            )
            stages = [labels, vector_index, model, names]
    with cached(train) as rows:
        return Pipeline(stages=stages).fit(rows)


def fit_decision_tree_classifier(
    data: DataFrame, train: DataFrame, label: str = "label", features: str = "features",
    max_categories: int = 4, **params: Any,
) -> PipelineModel:
    """Indexers, decision tree and label names in one model."""
    tree = DecisionTreeClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures", **params)
    return _fit_indexed(data, train, tree, label, features, max_categories, True)


def fit_random_forest_classifier(
    data: DataFrame, train: DataFrame, label: str = "label", features: str = "features",
    max_categories: int = 4, trees: int = 10, seed: int = 1, **params: Any,
) -> PipelineModel:
    """Indexers, random forest and label names in one model."""
    forest = RandomForestClassifier(
        labelCol="indexedLabel", featuresCol="indexedFeatures", numTrees=trees, seed=seed, **params
    )
    return _fit_indexed(data, train, forest, label, features, max_categories, True)


def fit_gbt_classifier(
    data: DataFrame, train: DataFrame, label: str = "label", features: str = "features",
    max_categories: int = 4, max_iter: int = 10, seed: int = 1, **params: Any,
) -> PipelineModel:
    """Indexers, boosted trees for two classes and label names in one model."""
    boosted = GBTClassifier(
        labelCol="indexedLabel", featuresCol="indexedFeatures", maxIter=max_iter, seed=seed,
        **params,
    )
    return _fit_indexed(data, train, boosted, label, features, max_categories, True)


def fit_mlp_classifier(
    train: DataFrame, layers: Sequence[int], block_size: int = 128, seed: int = 1234,
    max_iter: int = 100,
):
    """Feed-forward network; first and last layer are the numbers of features and classes."""
    estimator = MultilayerPerceptronClassifier(
        layers=list(layers), blockSize=block_size, seed=seed, maxIter=max_iter
    )
    return fit_with(estimator, train)


def fit_one_vs_rest(
    train: DataFrame, classifier: Estimator | None = None, parallelism: int = 4
):
    """One binary model per class, several at a time."""
    classifier = classifier or LogisticRegression(maxIter=10, tol=1e-6, fitIntercept=True)
    return fit_with(OneVsRest(classifier=classifier, parallelism=parallelism), train)


def fit_naive_bayes(train: DataFrame, smoothing: float = 1.0):
    """Multinomial naive Bayes over non-negative features; one pass, so nothing is cached."""
    return NaiveBayes(smoothing=smoothing).fit(train)


def fit_linear_regression(
    train: DataFrame, max_iter: int = 20, reg_param: float = 0.3, elastic_net: float = 0.8,
    solver: str = "auto",
):
    """Linear regression; p-values only exist for ``solver='normal'`` without an L1 part."""
    estimator = LinearRegression(
        maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net, solver=solver
    )
    return fit_with(estimator, train)


def fit_glm(
    train: DataFrame, family: str = "gaussian", link: str = "identity", max_iter: int = 10,
    reg_param: float = 0.3,
):
    """Generalised linear regression."""
    estimator = GeneralizedLinearRegression(
        family=family, link=link, maxIter=max_iter, regParam=reg_param
    )
    return fit_with(estimator, train)


def fit_history(df: DataFrame, model) -> DataFrame:
    """``(iteration, objective)`` of a fitted linear or logistic model; iteration 0 is the start.

    The closed-form solver makes no iterations: its history is one row.
    """
    rows = [(at, float(value)) for at, value in enumerate(model.summary.objectiveHistory)]
    return df.sparkSession.createDataFrame(rows, "iteration int, objective double")


def coefficient_table(df: DataFrame, model) -> DataFrame:
    """``(name, value, error, t, p)`` of an unpenalised linear fit: a row for each slope, then the intercept."""
    fit = model.summary
    names = [f"slope{at}" for at in range(len(model.coefficients))] + ["intercept"]
    values = [*model.coefficients, model.intercept]
    rows = [
        (name, float(value), float(error), float(t), float(p))
        for name, value, error, t, p in zip(
            names, values, fit.coefficientStandardErrors, fit.tValues, fit.pValues)
    ]
    return df.sparkSession.createDataFrame(rows, "name string, value double, error double, t double, p double")


def fit_decision_tree_regressor(
    data: DataFrame, train: DataFrame, label: str = "label", features: str = "features",
    max_categories: int = 4, **params: Any,
) -> PipelineModel:
    """Feature indexer and regression tree."""
    tree = DecisionTreeRegressor(labelCol=label, featuresCol="indexedFeatures", **params)
    return _fit_indexed(data, train, tree, label, features, max_categories, False)


def fit_random_forest_regressor(
    data: DataFrame, train: DataFrame, label: str = "label", features: str = "features",
    max_categories: int = 4, seed: int = 1, **params: Any,
) -> PipelineModel:
    """Feature indexer and regression forest."""
    forest = RandomForestRegressor(
        labelCol=label, featuresCol="indexedFeatures", seed=seed, **params
    )
    return _fit_indexed(data, train, forest, label, features, max_categories, False)


def text_stages(
    text: str = "text", num_features: int = 1000, max_iter: int = 10, reg_param: float = 0.001
) -> Pipeline:
    """Words, hashed counts and logistic regression, not fitted yet."""
    tokenizer = Tokenizer(inputCol=text, outputCol="words")
    hashed = HashingTF(numFeatures=num_features, inputCol="words", outputCol="features")
    model = LogisticRegression(maxIter=max_iter, regParam=reg_param)
    return Pipeline(stages=[tokenizer, hashed, model])


def save_model(model: Any, path: str) -> None:
    """Save a fitted or an unfitted model, replacing what is there."""
    model.write().overwrite().save(path)


def load_model(path: str, kind: type = PipelineModel) -> Any:
    """Load what ``save_model`` wrote; ``kind`` is ``Pipeline`` for an unfitted one."""
    return kind.load(path)
