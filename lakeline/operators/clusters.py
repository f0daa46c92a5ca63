"""Clustering and topics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.operators.topics import fit_lda, lda_quality, topic_mixture, topic_terms  # noqa: F401
from lakeline.session import cached


def fit_kmeans(df: DataFrame, k: int = 2, seed: int = 1, features: str = "features"):
    """K-means clusters."""
    with cached(df.select(features)) as rows:
        return KMeans(k=k, seed=seed, featuresCol=features).fit(rows)


def centre_rows(df: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """``(cluster, pos, value)`` of a model's centres."""
    rows = [
        (cluster, pos, float(value))
        for cluster, centre in enumerate(centres)
        for pos, value in enumerate(centre)
    ]
    return df.sparkSession.createDataFrame(rows, "cluster int, pos int, value double")


def kmeans_wssse(
    df: DataFrame, vector: str, centres: Sequence[Sequence[float]]
) -> DataFrame:
    """Sum over rows of the squared distance to the nearest centre; NULL without rows.

    The centres of a model are few; each task gets them once, as one array, and looks for the
    nearest of a whole batch at a time. The plan is the same for any number of centres.
    """
    table = np.array([list(map(float, centre)) for centre in centres])

    def batch_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).drop_null()
            if len(values):
                rows = values.flatten().to_numpy().reshape(len(values), -1)
                nearest = np.full(len(rows), np.inf)
                for centre in table:
                    gap = rows - centre
                    np.minimum(nearest, np.einsum("ij,ij->i", gap, gap), out=nearest)
                yield pa.RecordBatch.from_pydict({"wssse": [float(nearest.sum())]})

    sums = df.select(vector_to_array(vector).alias("v")).mapInArrow(batch_sums, "wssse double")
    return sums.agg(F.sum("wssse").alias("wssse"))


def fit_gaussian_mixture(df: DataFrame, k: int = 2, seed: int = 1, features: str = "features"):
    """A mixture of ``k`` normal distributions over all dimensions.

    Needs many more rows than dimensions: a component left with too few rows
    has no covariance and the fit does not end.
    """
    with cached(df.select(features)) as rows:
        return GaussianMixture(k=k, seed=seed, featuresCol=features).fit(rows)


def mixture_rows(df: DataFrame, model: GaussianMixtureModel) -> DataFrame:
    """``(component, weight, part, row, col, value)`` with means and covariances."""
    rows = []
    for at, (weight, normal) in enumerate(zip(model.weights, model.gaussiansDF.collect())):
        rows += [(at, weight, "mean", 0, c, float(v)) for c, v in enumerate(normal["mean"])]
        rows += [
            (at, weight, "cov", r, c, float(v))
            for r, line in enumerate(normal["cov"].toArray())
            for c, v in enumerate(line)
        ]
    return df.sparkSession.createDataFrame(
        rows, "component int, weight double, part string, row int, col int, value double"
    )
