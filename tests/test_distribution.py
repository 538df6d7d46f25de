import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import distribution, quantiles
from lendscope.sources.fixtures import loans_view
from tests.conftest import SF001


def test_histogram_counts_sum(spark):
    df = loans_view(spark, SF001)
    h = distribution.histogram(df, "loan_amnt", bins=20).collect()
    assert len(h) == 20
    assert sum(r.n for r in h) == df.where(F.col("loan_amnt").isNotNull()).count()
    assert all(h[i].bin_hi == h[i + 1].bin_lo for i in range(19))


def test_box_stats_ordered(spark):
    df = loans_view(spark, SF001)
    for r in distribution.box_stats(df, "int_rate", ["grade"]).collect():
        assert r.min_value <= r.whisker_lo <= r.q1 <= r.median <= r.q3 <= r.whisker_hi <= r.max_value


def test_box_stats_exact_on_small(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = distribution.box_stats(df, "x").first()
    assert (r.q1, r.median, r.q3) == (3.0, 5.0, 7.0)
    assert r.whisker_hi == 8.0 and r.n_outliers == 1


def test_gamma_fit_recovers(spark):
    rng = np.random.default_rng(7)
    xs = rng.gamma(2.5, 300.0, 50000)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    r = distribution.fit_gamma(df, "x").first()
    assert abs(r.shape - 2.5) < 0.1 and abs(r.scale - 300) < 15


def test_mean_ci_contains_mean(spark):
    df = loans_view(spark, SF001)
    for r in distribution.mean_ci(df, "loan_amnt", ["grade"]).collect():
        assert r.ci_lo <= r.mean <= r.ci_hi


def test_box_stats_same_with_shuffled_joins(spark):
    """The fences are joined without a hint; with broadcasts off the numbers must not change."""
    df = loans_view(spark, SF001)
    small = sorted(distribution.box_stats(df, "int_rate", ["grade"]).collect(), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = distribution.box_stats(df, "int_rate", ["grade"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        big = sorted(out.collect(), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan
    assert small == big


def test_box_stats_without_values(spark):
    df = spark.createDataFrame([(1, None), (1, float("nan"))], "g int, x double")
    assert distribution.box_stats(df, "x", ["g"]).collect() == []
    r = distribution.box_stats(df, "x").first()
    assert r.n == 0 and r.median is None and r.n_outliers == 0


def test_gamma_fit_on_constant_and_single_row_groups(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.1), ("a", 0.1), ("b", 3.0), ("c", 1.0), ("c", 2.0), ("d", -1.0)], "g string, x double")
    got = {r.g: r for r in distribution.fit_gamma(df, "x", ["g"]).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"].shape is None and got["b"].scale is None and got["c"].shape > 0


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def _groups(seed=5):
    rng = np.random.default_rng(seed)
    rows = [(0, float(v)) for v in rng.integers(0, 1000, 6000)]                 # hot group, many ties
    rows += [(g, float(v)) for g in range(1, 6) for v in rng.normal(50, 10, 300 + g)]
    return rows + [(6, 7.5), (7, 1.0), (7, 2.0), (9, None), (9, float("nan")), (None, 4.0), (None, 5.0)]


def _check_quantiles(rows, out):
    got = {r.g: r for r in out.collect()}
    values = {}
    for g, x in rows:
        if x is not None and x == x:
            values.setdefault(g, []).append(x)
    assert set(got) == set(values)
    for g, xs in values.items():
        assert got[g].n == len(xs) and (got[g].min_value, got[g].max_value) == (min(xs), max(xs))
        np.testing.assert_allclose(got[g].q, np.quantile(xs, PROBS), rtol=1e-12)


def test_exact_quantiles_match_numpy(spark):
    rows = _groups()
    df = spark.createDataFrame(rows, "g int, x double").repartition(16)
    _check_quantiles(rows, quantiles.exact_quantiles(df, "x", ["g"], PROBS))


def test_brackets_are_widened_and_narrowed(spark):
    """Sketches far too small for their brackets, and windows far too small for the values."""
    rows = _groups(6)
    df = spark.createDataFrame(rows, "g int, x double").repartition(16)
    _check_quantiles(rows, quantiles.exact_quantiles(df, "x", ["g"], PROBS, k=8, error=1e-6))
    _check_quantiles(rows, quantiles.exact_quantiles(df, "x", ["g"], PROBS, error=0.5, window_rows=20))


def test_discrete_quantiles(spark):
    rows = _groups(7)
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r.q for r in quantiles.exact_quantiles(df, "x", ["g"], [0.0, 0.5, 0.9, 1.0], kind="disc").collect()}
    for g in (0, 1, 5, 6, 7):
        xs = sorted(x for gg, x in rows if gg == g)
        assert got[g] == [xs[max(0, int(np.ceil(p * len(xs))) - 1)] for p in (0.0, 0.5, 0.9, 1.0)]


def test_same_quantiles_over_any_partitions_past_the_sketch_size(spark):
    n = 200_000
    base = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("x"), (F.col("id") % 3).alias("g"))
    results = []
    for parts in (1, 4, 16):
        got = quantiles.exact_quantiles(base.repartition(parts), "x", ["g"]).collect()
        results.append(sorted((r.g, r.n, tuple(r.q)) for r in got))
    assert results[0] == results[1] == results[2]
    xs = [(i * 7919) % n for i in range(n)]
    for g, _, q in results[0]:
        np.testing.assert_allclose(q, np.quantile(xs[g::3], [0.25, 0.5, 0.75]), rtol=1e-12)


@pytest.mark.parametrize("key", ["box_stats", "box_stats_by", "box_stats_facet", "column_quartiles", "loan_book_by_year"])
def test_oracles_at_the_larger_scale(spark, key):
    from __spark_entry__ import oracle_sql, queries
    from tools.oracle_check import compare, duck_connect
    sf_dir = "/root/testdata/sf0.1"
    ok, _, _, detail = compare(spark, duck_connect(sf_dir), key, queries()[key], oracle_sql()[key], sf_dir)
    assert ok, detail
