"""Shared passes: k-means for many k, Krylov components, derived features, the logistic grid, split counts."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lendscope.operators import cluster, derive, features, grid, models, subspace, sweep
from lendscope.operators.rows import split_frames
from lendscope.plans import queries_ml
from tests.conftest import SF001


def blobs(spark, n=900, width=5, parts=3):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, width)) * 8
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, width)) + 100
    return x, spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "key long, x array<double>").repartition(parts)


def lloyd(x, centres, rounds=20):
    for _ in range(rounds):
        best = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[best == j].mean(0) if (best == j).any() else c for j, c in enumerate(centres)])
        still = ((new - centres) ** 2).sum(1).max() <= 1e-8
        centres = new
        if still:
            break
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


@pytest.mark.parametrize("parts", [1, 5])
def test_shared_passes_give_the_separate_fits(spark, parts):
    x, rows = blobs(spark, parts=parts)
    starts = sweep.starting_centres(rows, 7)
    found = sweep.sweep_kmeans(rows, [2, 3, 7])
    for k in (2, 3, 7):
        centres, wcss = lloyd(x, starts[:k])
        assert np.allclose(found[k][0], centres, atol=1e-6) and found[k][1] == pytest.approx(wcss, rel=1e-9)


def test_sweep_of_few_rows_and_none(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [5.0, 2.0])], "key long, x array<double>")
    assert sweep.sweep_kmeans(rows, [2, 5])[5][1] == pytest.approx(0, abs=1e-12)
    assert sweep.sweep_kmeans(rows.where(F.lit(False)), [2]) == {}


def test_assignment_by_expressions(spark):
    x, rows = blobs(spark)
    centres = x[:4]
    got = {r.key: (r.cluster, r.cluster_distance) for r in sweep.assign(rows, centres).collect()}
    apart = ((x[:, None] - centres[None]) ** 2).sum(2)
    both = {r.key: (r.four, r.two) for r in sweep.assign_all(rows, {"four": centres, "two": centres[:2]}).collect()}
    assert all(both[i] == (apart[i].argmin(), apart[i, :2].argmin()) for i in range(len(x)))
    assert all(got[i][0] == apart[i].argmin() and got[i][1] == pytest.approx(apart[i].min()) for i in range(len(x)))


def dense(spark, x, parts=4):
    rows = [(i, Vectors.dense(r.tolist()) if i % 2 else Vectors.sparse(len(r), [(j, float(v)) for j, v in enumerate(r) if v])) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, ["id", "features"]).repartition(parts)


def test_components_agree_with_the_dense_fit(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) + 30
    x[rng.random(x.shape) < 0.3] = 0
    df = dense(spark, x)
    rows = subspace.sparse_rows(df, "features")
    found = subspace.principal_components(rows, 12, 3)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(found.variances, values[::-1][:3], rtol=1e-8) and found.total == pytest.approx(values.sum())
    assert np.allclose(np.abs(np.sum(found.vectors * vectors[:, ::-1][:, :3], axis=0)), 1, atol=1e-6)
    model = cluster.fit_pca(df, 3, "features")
    assert np.allclose(found.ratios, model.explainedVariance.toArray(), atol=1e-6)
    mine = {r.key: (r.a, r.b) for r in subspace.project(rows, found, ("a", "b")).collect()}
    for r in cluster.project(model, df, names=("a", "b")).collect():
        assert np.allclose(np.abs(mine[r.id]), np.abs([r.a, r.b]), atol=1e-5)
    assert tuple(subspace.facts(spark, rows, found).first())[2:] == (0, 0)


def test_components_of_ten_thousand_hashed_columns(spark):
    rng = np.random.default_rng(6)
    n, width = 300, 10_000
    factor = rng.normal(size=n)
    rows, full = [], np.zeros((n, width))
    for i in range(n):
        at = [*range(20), *rng.choice(np.arange(20, width), 10, replace=False).tolist()]
        value = [*(5 * factor[i] + 0.1 * rng.normal(size=20)), *rng.normal(size=10)]
        full[i, at] = value
        rows.append((i, at, [float(v) for v in value]))
    df = spark.createDataFrame(rows, "key long, at array<int>, value array<double>").repartition(3)
    found = subspace.principal_components(df, width, 2)
    centred = full - full.mean(0)
    s = np.linalg.svd(centred, compute_uv=False) ** 2 / (n - 1)
    assert np.allclose(found.variances, s[:2], rtol=1e-6)


def test_components_of_degenerate_frames(spark):
    schema = "key long, at array<int>, value array<double>"
    one = spark.createDataFrame([(1, [0], [2.0])], schema)
    assert len(subspace.principal_components(one, 3, 2).variances) == 0
    flat = spark.createDataFrame([(i, [0, 1], [2.0, float(i)]) for i in range(5)], schema)
    found = subspace.principal_components(flat, 2, 2)
    assert found.variances[0] == pytest.approx(2.5) and found.variances[1] == pytest.approx(0, abs=1e-12)


# --- derived features ----------------------------------------------------------------------------

def brute_entries(row, routes, width):
    out = []

    def put(name, value):
        digest = hashlib.md5(name.encode()).hexdigest()
        out.append((int(digest[:8], 16) % width, value * (-1 if int(digest[8], 16) >= 8 else 1)))
    for r in routes:
        v = row[r.column]
        text_missing = v is None or (isinstance(v, str) and (v == "" or "None" in v or "NULL" in v))
        if r.kind == "number":
            try:
                x = float(v)
            except (TypeError, ValueError):
                x = math.nan
            if math.isnan(x):
                put(f"{r.column}=missing", 1.0)
            elif x:
                put(r.column, x * r.scale)
        elif r.kind != "none" and text_missing:
            put(f"{r.column}=missing", 1.0)
        elif r.kind == "category":
            put(f"{r.column}={v if not isinstance(v, bool) else str(v).lower()}", 1.0)
        elif r.kind == "tokens":
            tokens = [t for t in re.split(r"[^\w]+|_", v.lower()) if t]
            for t in dict.fromkeys(tokens):
                put(f"{r.column}={t}", float(tokens.count(t)))
    return out


def test_routes_and_entries(spark):
    rng = random.Random(1)
    words = ["Alpha", "beta,", "Gamma-ray", "délta", "x1"]
    rows = [(i, i % 2, rng.choice([1.5, 0.0, None, math.nan, -2.0]), rng.choice(["7", "8.5", "n/a" if i % 50 == 0 else "3", ""]),
             rng.choice(["A", "B", "", None, "NULL"]), " ".join(rng.choices(words, k=rng.randrange(1, 6))) + f" {i}", i % 3 == 0, "same", None, float(i % 2))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, target int, num double, numtext string, cat string, note string, flag boolean, fixed string, "
                                     "empty string, indebt double").repartition(3)
    routes = derive.derive_routes(df)
    assert {r.column: r.kind for r in routes} == {"num": "number", "numtext": "number", "cat": "category", "note": "tokens", "flag": "category",
                                                  "fixed": "none", "empty": "none"}
    got = {r.id: (r.at, r.value) for r in derive.hashed_features(df, routes, width=500).collect()}
    for r in df.collect():
        want = brute_entries(r, routes, 500)
        assert got[r.id][0] == [a for a, _ in want] and got[r.id][1] == pytest.approx([v for _, v in want])


def test_the_label_never_becomes_a_feature(spark):
    df = spark.createDataFrame([(1, 0, 0.0, 2.0), (2, 1, 1.0, 3.0)], "id long, target int, indebt double, x double")
    assert [r.column for r in derive.derive_routes(df)] == ["x"]


# --- the grid ------------------------------------------------------------------------------------

def test_grid_equals_separate_fits(spark):
    rng = np.random.default_rng(9)
    x = np.c_[rng.normal(size=(500, 4)), rng.normal(2000, 3, 500)]
    x[rng.random(x.shape) < 0.2] = 0
    y = (rng.random(500) < 1 / (1 + np.exp(-(x[:, 0] - 2 * x[:, 1] + 0.5)))).astype(int)
    vectors = spark.createDataFrame([(i, int(t), Vectors.dense(r.tolist())) for i, (t, r) in enumerate(zip(y, x))], ["id", "target", "features"])
    rows = subspace.sparse_rows(vectors, "features").join(vectors.select(F.col("id").alias("key"), "target"), "key").repartition(4)
    fitted = grid.fit_grid(rows, 5, [0.05, 0.1, 0.4], tol=1e-10)
    for m in fitted:
        one = LogisticRegression(regParam=m.reg_param, standardization=False, tol=1e-12, maxIter=500).fit(vectors.withColumnRenamed("target", "label"))
        assert np.allclose(m.weights, one.coefficients.toArray(), atol=1e-6)
        assert m.intercept == pytest.approx(one.intercept, abs=2e-3)  # 2000 times a weight's tolerance
        assert m.slope <= 1e-10
    assert [r.n_slopes_off for r in grid.slopes_off(spark, rows, fitted, 1e-8).collect()] == [0, 0, 0]
    scored = grid.score_grid(rows, fitted, ["key", "target"])
    for r in scored.collect():
        for j, m in enumerate(fitted):
            assert r[f"score_{j}"] == pytest.approx(1 / (1 + math.exp(-(x[r.key] @ m.weights + m.intercept))), abs=1e-9)


def test_grid_of_empty_rows_and_one_label(spark):
    schema = "id long, target int, at array<int>, value array<double>"
    empty = spark.createDataFrame([], schema)
    assert grid.fit_grid(empty, 3, [0.1])[0].intercept == 0
    ones = spark.createDataFrame([(i, 1 if i else None, [], []) for i in range(5)], schema)
    assert grid.fit_grid(ones, 3, [0.1], max_passes=30)[0].intercept > 3


# --- trees, partitions, splits -------------------------------------------------------------------

def test_split_counts_equal_a_walk_over_the_trees(spark, tmp_dir):
    frame = queries_ml.model_frame(spark, SF001).select(*queries_ml._MODEL_COLS)
    model = models.fit_gbt(models.with_balance_weight(frame), queries_ml.numeric_features(frame), ["grade"], rounds=4)
    path = models.save_model(model, tmp_dir + "/gbt")
    names = [s for s in model.stages if hasattr(s, "getInputCols") and s.getOutputCol() == "features"][0].getInputCols()
    want = dict.fromkeys(names, 0)
    for tree in model.stages[-1].trees:
        for j in re.findall(r"If \(feature (\d+) ", tree.toDebugString):
            want[names[int(j)]] += 1
    got = models.split_counts(spark, model, path).collect()
    assert {r.feature: r.n_splits for r in got} == want and sum(want.values()) > 10
    assert [r.n_splits for r in got] == sorted(r.n_splits for r in got)
    nodes = models.node_table(spark, path)
    assert nodes.count() == 2 * sum(want.values()) + 4
    with pytest.raises(Exception):
        models.save_model(model, path)
    models.save_model(model, path, overwrite=True)


def test_partitions_follow_the_rows(spark):
    assert [features.partitions_for(n) for n in (0, 1, 8 << 18, (8 << 18) + 1, 4096 << 18)] == [8, 8, 8, 9, 4096]
    frame = spark.range(3000).withColumn("v", F.col("id") % 7)
    for parts in (8, 4096):
        held = features.persist_for_fit(frame, partitions=parts)
        assert held.rdd.getNumPartitions() == parts and held.count() == 3000
        held.unpersist()


def test_random_split_is_an_option(spark):
    frame = spark.range(2000)
    parts = split_frames(frame, [0.7, 0.3], "id", 21, method="random")
    assert sum(p.count() for p in parts) == 2000 and 1300 < parts[0].count() < 1500
    with pytest.raises(ValueError):
        split_frames(frame, [1.0], method="other")


def test_an_empty_category_has_a_place_in_the_vector(spark):
    df = spark.createDataFrame([(i, ["", "a", "b"][i % 3], float(i)) for i in range(9)], "id long, c string, x double")
    _, out = features.full_features(df, ["x"], ["c"])
    assert out.columns == ["id", "c", "x", "c_named_index", "c_named_index_onehot", "features_raw", "features_scaled"]
    assert {len(r.features_scaled) for r in out.collect()} == {3}


def test_scores_by_the_node_table(spark, tmp_dir):
    frame = queries_ml.model_frame(spark, SF001).select(*queries_ml._MODEL_COLS)
    model = models.fit_gbt(models.with_balance_weight(frame), ["loan_amnt", "int_rate"], ["grade", "addr_state"], rounds=5)
    path = models.save_model(model, tmp_dir + "/gbt")
    scored = models.score_column(model.transform(frame), name="own").select("id", "features", "own")
    both = scored.join(models.score_by_nodes(spark, path, scored), "id")
    assert both.count() == frame.count()
    assert both.agg(F.max(F.abs(F.col("own") - F.col("score")))).first()[0] < 1e-12


def test_boosted_trees_take_fewer_larger_partitions():
    rows = features.BOOST_PARTITION_ROWS
    assert [features.partitions_for(n, rows) for n in (0, 8 << 20, (8 << 20) + 1, 54_000_000)] == [8, 8, 9, 52]


def test_boosting_persists_the_training_part_alone(spark, monkeypatch):
    held = []

    def hold(df, *args, **kwargs):
        held.append((df, kwargs["partitions"]))
        return df.persist()

    monkeypatch.setattr(queries_ml.features, "persist_for_fit", hold)
    monkeypatch.setattr(queries_ml.models, "fit_gbt", lambda *args: None)
    _, test = queries_ml._gbt(spark, SF001)
    frame = queries_ml.model_frame(spark, SF001)
    train, rest = split_frames(frame, [0.7, 0.3], "id", 21, ["train", "test"])
    assert [(df.count(), n) for df, n in held] == [(train.count(), 8)] and test.count() == rest.count() > 0
    assert set(held[0][0].columns) == set(queries_ml._MODEL_COLS)


def test_loan_rules_are_compiled_in_pieces_unless_the_session_says_otherwise(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        queries_ml.loans_view(spark, SF001)
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "5000")
        queries_ml.loans_view(spark, SF001)
        assert spark.conf.get(name) == "5000"
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("parts", [1, 5])
def test_spread_around_centres_and_means(spark, parts):
    x, rows = blobs(spark, n=6000, parts=parts)
    centres = np.vstack([x[:4], np.full(x.shape[1], 1e6)])  # nobody is near the last one
    apart = ((x[:, None] - centres[None]) ** 2).sum(2)
    best = apart.argmin(1)
    got = {r.cluster: r for r in sweep.spread(sweep.assign(rows, centres), centres).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    for j, r in got.items():
        own = x[best == j]
        assert r.n == len(own) and r.squares == pytest.approx(apart[best == j, j].sum())
        assert r.around_mean == pytest.approx(((own - own.mean(0)) ** 2).sum())
    assert sweep.spread(sweep.assign(rows.where("key < 0"), centres), centres).count() == 0


def test_dense_chunks_give_the_sparse_products(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 12))
    x[rng.random(x.shape) < 0.4] = 0
    x[7] = 0
    rows, block = subspace.sparse_rows(dense(spark, x), "features"), rng.normal(size=(12, 5))
    found = subspace._scatter_times(rows, block)
    monkeypatch.setattr(subspace, "_DENSE_WIDTH", 0)
    assert np.allclose(found, x.T @ x @ block, rtol=1e-10) and np.allclose(found, subspace._scatter_times(rows, block), rtol=1e-10)


def test_tokens_are_split_once_a_row(spark):
    df = spark.createDataFrame([(1, 0, " ".join(f"w{i % 7}" for i in range(j))) for j in range(70)], "id int, target int, notes string")
    routes = derive.derive_routes(df)
    assert [r.kind for r in routes] == ["tokens"]
    out = derive.hashed_features(df, routes)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    longest = max(out.collect(), key=lambda r: sum(abs(v) for v in r.value))
    assert sorted(map(abs, longest.value)) == [9.0] * 1 + [10.0] * 6 and out.columns == ["id", "target", "at", "value"]
