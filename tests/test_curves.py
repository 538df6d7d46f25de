"""Density curve, automatic bins, gamma with location, bootstrap intervals."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import bootstrap, density
from lendscope.sources.fixtures import loans_view
from tests.conftest import SF001


def column(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def test_density_is_the_kernel_sum_over_the_values(spark):
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(5, 1, 300), rng.normal(12, 0.5, 100)]
    rows = density.density_curve(column(spark, [*x.tolist(), None, float("nan"), float("inf")]), "x", points=2048).collect()
    at, got = np.array([r.x for r in rows]), np.array([r.density for r in rows])
    iqr = np.subtract(*np.quantile(x, [0.75, 0.25]))
    h = 0.9 * min(x.std(ddof=1), iqr / 1.34) * len(x) ** -0.2
    want = np.exp(-0.5 * ((at[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert np.abs(got - want).max() < 1e-4 * want.max()
    assert np.trapezoid(got, at) == pytest.approx(1, abs=5e-3)


def test_density_of_constant_or_empty_columns(spark):
    assert density.density_curve(column(spark, [3.0] * 9), "x").collect() == []
    assert density.density_curve(column(spark, [None, float("nan")]), "x").collect() == []
    assert len(density.density_curve(column(spark, [1.0, 2.0]), "x", points=16).collect()) == 16
    # without an interquartile range the deviation alone sets the bandwidth
    assert len(density.density_curve(column(spark, [1.0] * 50 + [2.0]), "x", points=16).collect()) == 16


def test_automatic_bins(spark):
    x = np.random.default_rng(1).normal(size=500)
    width = 2 * np.subtract(*np.quantile(x, [0.75, 0.25])) / 500 ** (1 / 3)
    assert density.auto_bins(column(spark, x.tolist()), "x") == math.ceil((x.max() - x.min()) / width)
    assert density.auto_bins(column(spark, [1.0] * 99 + [2.0]), "x") == 10
    assert density.auto_bins(column(spark, [4.0] * 5), "x") == 1
    assert density.auto_bins(column(spark, []), "x") == 1
    assert [r.n for r in density.auto_histogram(column(spark, [4.0] * 5 + [None]), "x").collect()] == [5]
    assert sum(r.n for r in density.auto_histogram(column(spark, x.tolist()), "x").collect()) == 500


def test_digamma_and_trigamma():
    for x in (0.05, 0.7, 1.0, 3.3, 40.0, 1e4):
        h = 1e-4 * x
        assert density.digamma(x) == pytest.approx((math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h), rel=1e-6, abs=1e-6)
        assert density.trigamma(x) == pytest.approx((density.digamma(x + h) - density.digamma(x - h)) / (2 * h), rel=1e-6)
    assert density.digamma(1.0) == pytest.approx(-0.57721566490153286, abs=1e-13)
    assert density.trigamma(1.0) == pytest.approx(math.pi ** 2 / 6, abs=1e-13)


@pytest.mark.parametrize("shape,scale,location", [(2.5, 300.0, 1000.0), (6.0, 0.02, -3.0), (1.6, 5.0, 0.0)])
def test_gamma_with_location_recovers_planted_parameters(spark, shape, scale, location):
    x = np.random.default_rng(7).gamma(shape, scale, 40000) + location
    fit = density.fit_gamma_location(column(spark, x.tolist()).repartition(3), "x", digits=12).first()
    assert fit.n == 40000
    assert fit.shape == pytest.approx(shape, rel=0.08) and fit.scale == pytest.approx(scale, rel=0.08)
    assert fit.location == pytest.approx(location, abs=0.1 * scale)
    assert max(abs(fit.score_location) * scale, abs(fit.score_shape), abs(fit.score_scale) * scale) < 1e-8

    def likelihood(a, b, c):
        y = x - c
        return ((a - 1) * np.log(y) - y / b - a * math.log(b) - math.lgamma(a)).mean()
    best = likelihood(fit.shape, fit.scale, fit.location)
    assert best == pytest.approx(fit.log_likelihood, abs=1e-9)
    for da, db, dc in ((1e-3, 0, 0), (0, 1e-3 * scale, 0), (0, 0, 1e-4 * scale)):
        for sign in (1, -1):
            assert likelihood(fit.shape + sign * da, fit.scale + sign * db, fit.location + sign * dc) < best


def test_gamma_without_an_inner_maximum(spark):
    left = column(spark, (10 - np.random.default_rng(3).gamma(2, 1, 2000)).tolist())
    assert density.fit_gamma_location(left, "x").first().shape is None
    assert density.fit_gamma_location(column(spark, [2.0, 2.0]), "x").first()[:2] == (2, None)
    assert density.fit_gamma_location(column(spark, []), "x").first()[0] == 0


def test_poisson_thresholds():
    limits = bootstrap.poisson_thresholds()
    draws = np.arange(1 << bootstrap.DRAW_BITS)
    weight = sum((draws >= t).astype(int) for t in limits)
    assert weight.mean() == pytest.approx(1, abs=1e-3) and weight.var() == pytest.approx(1, abs=3e-3)


def test_bootstrap_covers_like_the_normal_interval(spark):
    df = loans_view(spark, SF001)
    for r in bootstrap.bootstrap_ci(df, "loan_amnt", ["grade"]).collect():
        group = df.where(F.col("grade").eqNullSafe(F.lit(r.grade)))
        st = group.agg(F.avg("loan_amnt").alias("m"), F.stddev("loan_amnt").alias("s"), F.count("loan_amnt").alias("n")).first()
        half = 1.96 * st.s / math.sqrt(st.n)
        assert r.n == st.n and r.mean == pytest.approx(st.m)
        assert r.ci_lo == pytest.approx(st.m - half, abs=0.5 * half) and r.ci_hi == pytest.approx(st.m + half, abs=0.5 * half)


def test_bootstrap_is_the_same_on_any_partitioning(spark):
    df = loans_view(spark, SF001).select("id", "grade", "loan_amnt")
    results = [bootstrap.bootstrap_ci(df.repartition(n), "loan_amnt", ["grade"], replicates=40).collect() for n in (1, 7)]
    assert [r[:2] for r in results[0]] == [r[:2] for r in results[1]]
    assert np.allclose([r[2:] for r in results[0]], [r[2:] for r in results[1]], rtol=1e-12)


def test_bootstrap_without_groups_values_or_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (3, None), (4, float("nan"))], "id long, x double")
    row = bootstrap.bootstrap_ci(df, "x", replicates=20).first()
    assert (row.n, row.mean) == (2, 1.5) and row.ci_lo == row.ci_hi == 1.5  # one key: drawn together
    assert bootstrap.bootstrap_ci(df.where("id > 2"), "x", ["id"]).collect() == []
