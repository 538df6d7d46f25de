"""Clustering and projection: k-means elbow sweep, cluster assignment, PCA.

The feature frame is persisted once for the sweep (k-means makes many passes)
and released afterwards. A persisted partition lost with its executor is
recomputed from the plan, so nothing here depends on a surviving cache.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.operators.features import fit_concurrently
from lendscope.operators.rows import hash_bucket


def fit_kmeans(df: DataFrame, k: int, features: str = "features_scaled", seed: int = 2,
               max_iter: int = 20, prediction: str = "cluster") -> KMeansModel:
    return KMeans(featuresCol=features, k=k, seed=seed, maxIter=max_iter,
                  predictionCol=prediction).fit(df)


def elbow(spark: SparkSession, df: DataFrame, ks: Sequence[int], features: str = "features_scaled",
          seed: int = 2, max_iter: int = 20, parallelism: int = 4) -> DataFrame:
    """Within-cluster sum of squares per k: rows (k, wcss). The feature column is
    persisted for the sweep; the fits are distributed jobs, ``parallelism`` of them
    at a time; only k and one number per fit reach the driver."""
    data = df.select(features).persist()  # in the partitions the caller chose
    try:
        costs = fit_concurrently(spark, [
            (lambda k=k: float(fit_kmeans(data, k, features, seed, max_iter).summary.trainingCost))
            for k in ks], parallelism)
    finally:
        data.unpersist()
    return spark.createDataFrame([(int(k), c) for k, c in zip(ks, costs)], "k int, wcss double")


def fit_pca(df: DataFrame, k: int, features: str = "features_scaled",
            output: str = "pca_features") -> PCAModel:
    return PCA(k=k, inputCol=features, outputCol=output).fit(df)


def explained_variance(spark: SparkSession, model: PCAModel, digits: int = 6) -> DataFrame:
    """Rows (component, ratio, cumulative) from one fitted model."""
    ratios = [float(v) for v in model.explainedVariance.toArray()]
    rows, acc = [], 0.0
    for i, r in enumerate(ratios, start=1):
        acc += r
        rows.append((i, round(r, digits), round(acc, digits)))
    return spark.createDataFrame(rows, "component int, ratio double, cumulative double")


def project(model: PCAModel, df: DataFrame, keep: Sequence[str] = ("id",),
            names: Sequence[str] = ("pc1", "pc2"), sample_percent: int | None = None,
            key: str = "id", seed: int = 0) -> DataFrame:
    """Component scores as columns. For a scatter plot pass ``sample_percent``: a
    reproducible hash sample of the rows by ``key`` (no shuffle, the same rows on
    every run), never a collect of all points."""
    arr = vector_to_array(F.col(model.getOutputCol()))
    if sample_percent is not None:
        df = df.where(hash_bucket(key, seed) < sample_percent)
    return model.transform(df).select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])
