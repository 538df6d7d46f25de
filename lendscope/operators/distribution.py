"""Distribution summaries that used to be driver-side plots, as Spark aggregates.

- :func:`histogram`  equal-width bins (the data behind a frequency plot)
- :func:`fit_gamma`  two-parameter gamma fit from one-pass sufficient statistics
- :func:`box_stats`  quartiles, whiskers and outlier counts, optionally by group
- :func:`mean_ci`    mean with a normal 95% interval per group

Quartiles are exact and interpolated (:mod:`lendscope.operators.quantiles`), without ever
keeping all values of a group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.operators import quantiles
from lendscope.session import materialize

def histogram(df: DataFrame, col: str, bins: int = 20, lo: float | None = None,
              hi: float | None = None, digits: int = 6) -> DataFrame:
    """Counts in ``bins`` equal-width bins over [lo, hi] (the top edge goes in the last bin).

    When ``lo``/``hi`` are not given they are the column's min and max: one small
    aggregate whose single row (two numbers) is read on the driver. Empty bins are
    reported with n = 0. Output: bin, bin_lo, bin_hi, n.
    """
    x = F.col(col).cast("double")
    if lo is None or hi is None:
        row = df.where(x.isNotNull() & ~F.isnan(x)).agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
        lo = row["lo"] if lo is None else lo
        hi = row["hi"] if hi is None else hi
    spark = df.sparkSession
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if lo is None or hi is None:
        return edges.select("bin", F.lit(None).cast("double").alias("bin_lo"),
                            F.lit(None).cast("double").alias("bin_hi"), F.lit(0).cast("bigint").alias("n"))
    width = (hi - lo) / bins if hi > lo else 1.0
    bin_of = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = (df.where(x.isNotNull() & ~F.isnan(x) & (x >= lo) & (x <= hi))
              .groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    # Both sides hold at most ``bins`` rows (a parameter), so the counts are broadcast.
    return (edges.join(F.broadcast(counts), "bin", "left")
            .select("bin",
                    F.round(F.lit(lo) + F.col("bin") * F.lit(width), digits).alias("bin_lo"),
                    F.round(F.lit(lo) + (F.col("bin") + 1) * F.lit(width), digits).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))
            .orderBy("bin"))


def fit_gamma(df: DataFrame, col: str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Gamma(shape, scale) fit per group from count, mean(x), mean(ln x) over x > 0.

    s = ln(mean) - mean(ln x); shape = (3 - s + sqrt((s - 3)^2 + 24 s)) / (12 s)
    (the closed-form approximation to the maximum-likelihood shape); scale = mean / shape;
    location fixed at 0. A group whose values are all equal (or a single row) has no fit: its
    shape and scale are NULL.
    """
    x = F.col(col).cast("double")
    pos = df.where(x > 0)
    stats = pos.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("_m"),
                                 F.avg(F.ln(x)).alias("_ml"))
    s = F.ln(F.col("_m")) - F.col("_ml")
    # Rounding leaves an s of about 1e-16 where all values are equal.
    spread = F.when(s > 1e-12, s)
    shape = (F.lit(3.0) - spread + F.sqrt((spread - F.lit(3.0)) * (spread - F.lit(3.0)) + F.lit(24.0) * spread)) / (
        F.lit(12.0) * spread)
    return stats.select(
        *by, "n",
        F.round(F.col("_m"), digits).alias("mean"),
        F.round(F.col("_ml"), digits).alias("mean_log"),
        F.round(s, digits).alias("s"),
        F.round(shape, digits).alias("shape"),
        F.round(F.col("_m") / shape, digits).alias("scale"),
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str] = (), whisker: float = 1.5,
              **how) -> DataFrame:
    """Box-plot numbers per group: n, q1, median, q3, iqr, whisker_lo, whisker_hi, n_outliers,
    min_value, max_value.

    Groups and values are written once. Exact interpolated quartiles first, then one pass for the whiskers: the furthest values
    within ``whisker`` interquartile ranges, and the count beyond them. The per-group fences are
    joined without a hint, so Spark broadcasts them if they are small and splits skewed groups
    if not; without keys they are literals.
    """
    by = list(by)
    x = F.col(value).cast("double")
    base = materialize(df.where(x.isNotNull() & ~F.isnan(x)).select(*by, x.alias("_x")), "box-values")
    q = quantiles.exact_quantiles(base, "_x", by, [0.25, 0.5, 0.75], written=True, **how)
    iqr = F.col("q")[2] - F.col("q")[0]
    g = materialize(q.select(*by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
                             iqr.alias("iqr"), (F.col("q")[0] - F.lit(whisker) * iqr).alias("_lf"),
                             (F.col("q")[2] + F.lit(whisker) * iqr).alias("_uf"), "min_value", "max_value"), "box-fences")
    tail = quantiles.with_group_columns(base, g, by, ["_lf", "_uf"]).groupBy(*by).agg(
        F.min(F.when(F.col("_x") >= F.col("_lf"), F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= F.col("_uf"), F.col("_x"))).alias("whisker_hi"),
        F.count_if((F.col("_x") < F.col("_lf")) | (F.col("_x") > F.col("_uf"))).alias("n_outliers"))
    if not by:  # one row, also where there are no values
        row = g.first()
        known = {c: F.lit(None if row is None else row[c]).cast("double")
                 for c in ("q1", "median", "q3", "iqr", "min_value", "max_value")}
        out = tail.withColumns(known | {"n": F.lit(0 if row is None else row["n"]).cast("bigint")})
    else:
        out = quantiles.with_group_columns(tail, g, by, ["n", "q1", "median", "q3", "iqr", "min_value", "max_value"])
    return out.select(*by, "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "n_outliers",
                      "min_value", "max_value").orderBy(*(by or ["n"]))


def mean_ci(df: DataFrame, value: str, by: Sequence[str], z: float = 1.96,
            digits: int = 6) -> DataFrame:
    """Mean and normal interval mean +- z * s / sqrt(n) per group (one aggregate)."""
    x = F.col(value).cast("double")
    st = (df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*by)
          .agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("_m"), F.stddev_samp(x).alias("_s")))
    half = F.lit(z) * F.col("_s") / F.sqrt(F.col("n").cast("double"))
    return st.select(*by, "n", F.round("_m", digits).alias("mean"),
                     F.round("_s", digits).alias("stddev"),
                     F.round(F.col("_m") - half, digits).alias("ci_lo"),
                     F.round(F.col("_m") + half, digits).alias("ci_hi")).orderBy(*by)

