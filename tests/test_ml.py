"""Features, splits, clustering, metrics (leakage guard, exact AUC vs brute force)."""

import random

import pytest
from pyspark.sql import functions as F

from lendscope.operators import cluster, features, metrics, models
from lendscope.operators.rows import hash_bucket, split_frames, stable_split
from lendscope.plans.queries_ml import model_frame
from tests.conftest import SF001


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    total = 0.0
    for p in pos:
        for n in neg:
            total += 1.0 if p > n else 0.5 if p == n else 0.0
    return total / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    rnd = random.Random(3)
    pairs = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(3000)]
    df = spark.createDataFrame(pairs, "score double, target int")
    assert metrics.auc(df, "target", "score", ranges=16, digits=None) == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_constant_score_is_half(spark):
    df = spark.createDataFrame([(0.3, i % 2) for i in range(100)], "score double, target int")
    assert metrics.auc(df, "target", "score") == 0.5


def test_classification_report_counts(spark):
    rows = [(1, 1.0, 0.9), (1, 0.0, 0.4), (0, 1.0, 0.6), (0, 0.0, 0.1), (0, 0.0, 0.2)]
    df = spark.createDataFrame(rows, "target int, prediction double, score double")
    r = metrics.classification_report(df).first()
    assert (r.tp, r.fn, r.fp, r.tn) == (1, 1, 1, 2)
    assert r.accuracy == 0.6 and r.precision == 0.5 and r.recall == 0.5
    assert r.auc == pytest.approx(brute_auc([(s, y) for y, _, s in rows]), abs=1e-6)


def test_leakage_guard():
    with pytest.raises(ValueError):
        features.guard_features(["loan_amnt", "target"])
    with pytest.raises(ValueError):
        models.feature_hasher(["indebt", "x"])


def test_stable_split_disjoint_complete(spark):
    df = model_frame(spark, SF001)
    parts = split_frames(df, [0.6, 0.2, 0.2], "id", 123, ["a", "b", "c"])
    ids = [set(r.id for r in p.select("id").collect()) for p in parts]
    assert sum(len(s) for s in ids) == df.count()
    assert not (ids[0] & ids[1]) and not (ids[0] & ids[2]) and not (ids[1] & ids[2])
    # the split does not depend on partitioning
    again = stable_split(df.repartition(7), [0.6, 0.2, 0.2], "id", 123, ["a", "b", "c"])
    assert {r.id for r in again.where(F.col("split") == "a").collect()} == ids[0]


def test_hash_bucket_range(spark):
    b = spark.range(5000).select(hash_bucket("id", 5).alias("b")).agg(F.min("b"), F.max("b")).first()
    assert b[0] >= 0 and b[1] <= 99


def test_one_hot_sums(spark):
    df = model_frame(spark, SF001)
    _, idx = features.index_categories(df, ["grade"])
    _, hot = features.one_hot(idx, ["grade_index"])
    sums = hot.select(F.aggregate(F.expr("vector_to_array(grade_index_onehot)") if False else
                                  features.vector_to_array(F.col("grade_index_onehot")),
                                  F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert {r.s for r in sums.distinct().collect()} <= {0.0, 1.0}


def test_index_frequency_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "g string")
    model, out = features.index_categories(df, ["g"])
    assert list(model.labelsArray[0]) == ["a", "b", "c"]  # a, b tie at 2 -> alphabetical
    assert out.count() == 5  # NULL row skipped


def test_wcss_equals_within_cluster_squares(spark):
    """trainingCost >= squares around the cluster means (centres are the means only at
    convergence), and clustering explains part of the total sum of squares."""
    df = model_frame(spark, SF001)
    _, scaled = features.assemble_scale(df, ["loan_amnt", "int_rate"])
    model = cluster.fit_kmeans(scaled, 3, seed=2)
    cols = features.unpack(model.transform(scaled), "features_scaled", ["a", "b"], digits=None)
    per = cols.groupBy("cluster").agg(((F.var_pop("a") + F.var_pop("b")) * F.count("a")).alias("w"))
    within = per.agg(F.sum("w")).first()[0]
    tss = cols.agg(((F.var_pop("a") + F.var_pop("b")) * F.count("a")).alias("t")).first().t
    cost = model.summary.trainingCost
    assert within * (1 - 1e-9) <= cost <= within * 1.01
    assert cost < tss


def test_explained_variance_two_columns(spark):
    df = model_frame(spark, SF001)
    _, scaled = features.assemble_scale(df, ["loan_amnt", "int_rate"])
    ev = cluster.explained_variance(spark, cluster.fit_pca(scaled, 2)).orderBy("component").collect()
    r = df.stat.corr("loan_amnt", "int_rate")
    assert ev[0].ratio == pytest.approx((1 + abs(r)) / 2, abs=1e-6)
    assert ev[1].cumulative == pytest.approx(1.0, abs=1e-6)


def test_shuffled_label_auc_near_half(spark):
    df = model_frame(spark, SF001).withColumn("target", (F.rand(11) < 0.35).cast("int"))
    train, test = split_frames(df, [0.7, 0.3], "id", 21, ["train", "test"])
    fitted = models.train_lr_grid(train, ["loan_amnt", "int_rate", "grade", "purpose"], [0.1])
    _, board = models.pick_best(spark, fitted, test)
    assert abs(board.first().auc - 0.5) < 0.06


def test_concurrent_fits_equal_sequential(spark):
    from pyspark.ml.feature import VectorAssembler

    from lendscope.operators import cluster
    df = spark.range(0, 600).select((F.col("id") % 17).cast("double").alias("a"),
                                    ((F.col("id") * 7) % 23).cast("double").alias("b"))
    feats = VectorAssembler(inputCols=["a", "b"], outputCol="features_scaled").transform(df)
    seq = [tuple(r) for r in cluster.elbow(spark, feats, [2, 3, 4, 5], parallelism=1).collect()]
    par = [tuple(r) for r in cluster.elbow(spark, feats, [2, 3, 4, 5], parallelism=4).collect()]
    # The cost is a floating-point sum combined in task-completion order, so it can
    # differ in the last bit between any two runs; the fits themselves are the same.
    assert [k for k, _ in seq] == [k for k, _ in par] == [2, 3, 4, 5]
    assert all(abs(a - b) <= 1e-9 * abs(a) for (_, a), (_, b) in zip(seq, par))


def test_pca_scatter_sample_is_stable_subset(spark):
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(0, 2000).select("id", (F.col("id") % 13).cast("double").alias("a"),
                                     ((F.col("id") * 3) % 7).cast("double").alias("b"))
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features_scaled").transform(df)
    model = cluster.fit_pca(data, 2)
    full = {r.id: (r.pc1, r.pc2) for r in cluster.project(model, data).collect()}
    s1 = {r.id: (r.pc1, r.pc2) for r in cluster.project(model, data, sample_percent=10).collect()}
    s2 = {r.id for r in cluster.project(model, data, sample_percent=10).collect()}
    assert set(s1) == s2 and 100 < len(s1) < 300
    assert all(full[i] == v for i, v in s1.items())


def test_concurrent_fits_interleaved_with_sql(spark):
    """Pool threads must not share one set of local properties (SQL execution ids)."""
    from lendscope.operators.features import fit_concurrently
    df = spark.range(0, 3000).select((F.col("id") % 10).alias("g"), F.col("id").cast("double").alias("x"))
    for _ in range(3):
        assert df.groupBy("g").count().count() == 10
        got = fit_concurrently(spark, [
            (lambda m=m: df.where(F.col("g") < m).groupBy("g").agg(F.sum("x")).count()) for m in range(1, 9)], 4)
        assert got == list(range(1, 9))


def test_report_skips_rows_without_label_or_prediction(spark):
    rows = [(1, 1.0, 0.9), (0, 0.0, 0.1), (None, 1.0, 0.5), (1, None, 0.5), (0, 1.0, None), (1, 1.0, float("nan"))]
    r = metrics.classification_report(spark.createDataFrame(rows, "target int, prediction double, score double")).first()
    assert (r.n, r.n_skipped, r.tp, r.tn, r.fp, r.fn) == (4, 2, 2, 1, 1, 0)
    assert r.accuracy == 0.75 and r.auc == 1.0
    none = metrics.classification_report(spark.createDataFrame([], "target int, prediction double, score double")).first()
    assert none.n == 0 and none.accuracy is None and none.auc is None


def test_small_split_part_is_not_rounded_away(spark):
    parts = split_frames(spark.range(20000), [0.995, 0.005], "id", 3, ["big", "small"])
    n = [p.count() for p in parts]
    assert sum(n) == 20000 and 50 <= n[1] <= 160


def test_trees_take_more_categories_than_the_default_bins(spark):
    df = spark.range(2000).select(F.concat(F.lit("c"), (F.col("id") % 80).cast("string")).alias("g"),
                                  (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 80 < 40).cast("int").alias("target"))
    model = models.fit_gbt(models.with_balance_weight(df), ["x"], ["g"], rounds=2)
    assert model.transform(df).where("prediction = target").count() == 2000


def test_kmeans_is_the_same_for_any_input_partitions(spark):
    df = model_frame(spark, SF001).select("id", "loan_amnt", "int_rate")
    costs = []
    for parts in (2, 4, 8):
        frame = features.persist_for_fit(df.repartition(parts))
        _, scaled = features.assemble_scale(frame, ["loan_amnt", "int_rate"])
        costs.append(cluster.fit_kmeans(scaled, 3, seed=2).summary.trainingCost)
        frame.unpersist()
    assert costs[1] == pytest.approx(costs[0], rel=1e-9) and costs[2] == pytest.approx(costs[0], rel=1e-9)
