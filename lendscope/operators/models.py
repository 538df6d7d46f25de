"""Default models: imbalance-aware boosted trees, a hashed logistic-regression grid,
best-model selection by AUC, feature importances, persistence.

Each model is one ``Pipeline`` so a single fit carries its featurisation along
and a saved model scores new data without re-fitting anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import FeatureHasher, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.constants import HASHED_FEATURES
from lendscope.operators.features import fit_concurrently, guard_features
from lendscope.operators.metrics import auc


def with_balance_weight(df: DataFrame, label: str = "target", weight_col: str = "weight") -> DataFrame:
    """Weight positives by n_neg / n_pos (one small aggregate) so both classes weigh the same."""
    row = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")).first()
    ratio = (row["n"] / row["p"]) if row["p"] else 1.0
    return df.withColumn(weight_col, F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


def fit_gbt(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), label: str = "target",
            weight_col: str | None = "weight", rounds: int = 100, max_depth: int = 5, seed: int = 21) -> PipelineModel:
    """Categories as integer codes (trees split on them directly) + numbers -> boosted trees.

    The indexer is fitted first; a split can tell apart every category it found, so ``maxBins``
    follows the data.
    """
    guard_features(list(numeric) + list(categorical), label)
    stages, bins = [], 32
    codes = [c + "_code" for c in categorical]
    if categorical:
        indexer = StringIndexer(inputCols=list(categorical), outputCols=codes, handleInvalid="keep").fit(train)
        bins = max([bins, *(len(labels) + 1 for labels in indexer.labelsArray)])
        stages.append(indexer)
    stages.append(VectorAssembler(inputCols=list(numeric) + codes, outputCol="features", handleInvalid="keep"))
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=max_depth, seed=seed, maxBins=bins)
    if weight_col:
        gbt = gbt.setWeightCol(weight_col)
    return Pipeline(stages=[*stages, gbt]).fit(train)


def score_column(scored: DataFrame, prob_col: str = "probability", name: str = "score") -> DataFrame:
    """P(class 1) as a plain double column."""
    return scored.withColumn(name, vector_to_array(F.col(prob_col))[1])


def feature_importance(spark: SparkSession, model: PipelineModel, digits: int = 6) -> DataFrame:
    """(feature, importance) rows, ascending, for the fitted tree stage."""
    assembler = [s for s in model.stages if hasattr(s, "getInputCols") and s.getOutputCol() == "features"][0]
    names = assembler.getInputCols()
    tree = model.stages[-1]
    imp = tree.featureImportances.toArray()
    rows = [(n, round(float(v), digits)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy("importance", "feature")


def feature_hasher(input_cols: Sequence[str], label: str = "target", num_features: int = HASHED_FEATURES) -> FeatureHasher:
    """Mixed-type columns (numbers as values, text as one-hot) into ``num_features`` slots; NULL
    inputs hash to nothing. It has no state, so it needs no fit."""
    guard_features(input_cols, label)
    return FeatureHasher(inputCols=list(input_cols), outputCol="features", numFeatures=num_features)


def train_lr_grid(train: DataFrame, input_cols: Sequence[str], reg_params: Sequence[float], label: str = "target",
                  max_iter: int = 100, parallelism: int = 4) -> list[tuple[float, PipelineModel]]:
    """One hashed logistic model per ``regParam``, ``parallelism`` fits at a time. The training set
    is hashed once for all of them; each model comes back with the hasher as its first stage."""
    hasher = feature_hasher(input_cols, label)
    hashed = hasher.transform(train).select(label, "features").persist()
    try:
        fitted = fit_concurrently(train.sparkSession, [
            (lambda rp=rp: LogisticRegression(featuresCol="features", labelCol=label, regParam=rp, maxIter=max_iter).fit(hashed))
            for rp in reg_params], parallelism)
    finally:
        hashed.unpersist()
    return [(rp, PipelineModel(stages=[hasher, m])) for rp, m in zip(reg_params, fitted, strict=True)]


def pick_best(spark: SparkSession, models: Sequence[tuple[float, PipelineModel]], test: DataFrame,
              label: str = "target", parallelism: int = 4) -> tuple[PipelineModel, DataFrame]:
    """Score each model on ``test``, hashed once; return the best by AUC and the leaderboard."""
    hashed = models[0][1].stages[0].transform(test).select(label, "features").persist()
    try:
        aucs = fit_concurrently(spark, [
            (lambda m=m: auc(score_column(m.stages[-1].transform(hashed)), label, "score")) for _, m in models], parallelism)
    finally:
        hashed.unpersist()
    rows, best, best_auc = [], None, -1.0
    for (rp, m), a in zip(models, aucs, strict=True):
        rows.append((float(rp), a))
        if a is not None and a > best_auc:
            best, best_auc = m, a
    return best, spark.createDataFrame(rows, "reg_param double, auc double")


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of the tree ensemble in a saved pipeline: (tree, node, prediction, left, right, feature,
    go_left, n_categories, gain). A leaf has no children (left and right -1). ``go_left`` is the
    threshold of a number, or the category codes that go left where ``n_categories`` is not -1."""
    nodes = spark.read.parquet(f"{path}/stages/*_GBTClassifier_*/data")
    n, split = "nodeData.", "nodeData.split."
    return nodes.select(F.col("treeID").alias("tree"), F.col(n + "id").alias("node"), F.col(n + "prediction").alias("prediction"),
                        F.col(n + "leftChild").alias("left"), F.col(n + "rightChild").alias("right"), F.col(split + "featureIndex").alias("feature"),
                        F.col(split + "leftCategoriesOrThreshold").alias("go_left"), F.col(split + "numCategories").alias("n_categories"),
                        F.col(n + "gain").alias("gain"))


def score_by_nodes(spark: SparkSession, path: str, rows: DataFrame, key: str = "id", features: str = "features", max_depth: int = 5) -> DataFrame:
    """(``key``, score) of ``rows`` by the saved node table alone: every row walks down all trees at
    once, one join a level, and the weighted leaves give the probability of label 1.

    The node table has at most ``2^(max_depth + 1)`` nodes a tree, which bounds the broadcast.
    """
    nodes = F.broadcast(node_table(spark, path))
    weights = spark.read.parquet(f"{path}/stages/*_GBTClassifier_*/treesMetadata").toDF("tree", "metadata", "weight").drop("metadata")
    trees = weights.count()
    at = rows.select(F.col(key).alias("key"), vector_to_array(F.col(features)).alias("x"),
                     F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    value = F.get("x", F.col("feature"))
    left = F.when(F.col("n_categories") == -1, value <= F.get("go_left", F.lit(0))).otherwise(F.array_contains("go_left", value))
    child = F.when(F.col("left") < 0, F.col("node")).when(left, F.col("left")).otherwise(F.col("right"))
    for _ in range(max_depth):
        at = at.join(nodes, ["tree", "node"]).select("key", "x", "tree", child.alias("node"))
    margins = (at.join(nodes, ["tree", "node"]).join(F.broadcast(weights), "tree").groupBy("key")
               .agg(F.sum(F.col("prediction") * F.col("weight")).alias("margin")))
    return margins.select(F.col("key").alias(key), (1 / (1 + F.exp(-2 * F.col("margin")))).alias("score"))


def split_counts(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    """How often each feature splits a node of the ensemble, and the gain it brought in all:
    (feature, n_splits, gain), features that never split included, ascending.

    Aggregated from the saved node table, so it works for any number of trees; ``path`` is where
    ``model`` was saved."""
    assembler = [s for s in model.stages if hasattr(s, "getInputCols") and s.getOutputCol() == "features"][0]
    names = spark.createDataFrame(list(enumerate(assembler.getInputCols())), "place int, name string")
    splits = (node_table(spark, path).where("left >= 0").groupBy(F.col("feature").alias("of"))
              .agg(F.count("*").alias("n_splits"), F.sum("gain").alias("gain")))
    return (names.join(splits, names["place"] == splits["of"], "left")
            .select(F.col("name").alias("feature"), F.coalesce("n_splits", F.lit(0)).cast("bigint").alias("n_splits"),
                    F.round(F.coalesce("gain", F.lit(0.0)), 6).alias("gain")).orderBy("n_splits", "feature"))


def save_model(model: PipelineModel, path: str, overwrite: bool = False) -> str:
    """Save to ``path``; what lies there already stays, with an error, unless ``overwrite``."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
