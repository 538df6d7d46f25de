"""Smooth pictures of a distribution: automatic bins, a density curve, a gamma fit with location.

The data behind a distribution plot, without the values ever leaving the cluster: each step is an
aggregate, and what reaches the driver is a handful of sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.operators import quantiles
from lendscope.operators.distribution import histogram
from lendscope.session import materialize

#: Most bins an automatic histogram has.
MAX_BINS = 50


def _finite(df: DataFrame, col: str) -> DataFrame:
    """The finite values of a column as ``x``."""
    x = F.col(col).cast("double")
    return df.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))).select(x.alias("x"))


def _spread(values: DataFrame):
    """One row on the driver: n, lo, hi, mean, sd, iqr (exact); ``None`` without values."""
    row = values.agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg("x").alias("mean"),
                     F.stddev_samp("x").alias("sd")).first()
    if not row["n"]:
        return None
    q = quantiles.exact_quantiles(values, "x", [], [0.25, 0.75]).first()["q"]
    return {**row.asDict(), "iqr": q[1] - q[0]}


def auto_bins(df: DataFrame, col: str, most: int = MAX_BINS) -> int:
    """Number of histogram bins by the Freedman-Diaconis rule: the range over ``2 IQR / cube root of
    n``, at most ``most``; without an interquartile range the square root of n."""
    s = _spread(materialize(_finite(df, col), "bins"))
    return 1 if s is None else _bins(s, most)


def _bins(s: dict, most: int) -> int:
    if s["hi"] == s["lo"]:
        return 1
    if s["iqr"] > 0:
        return max(1, min(most, math.ceil((s["hi"] - s["lo"]) / (2 * s["iqr"] / s["n"] ** (1 / 3)))))
    return max(1, min(most, math.ceil(math.sqrt(s["n"]))))


def auto_histogram(df: DataFrame, col: str, most: int = MAX_BINS, digits: int = 6) -> DataFrame:
    """:func:`~lendscope.operators.distribution.histogram` of the finite values, with automatic bins."""
    values = materialize(_finite(df, col), "bins")
    s = _spread(values)
    if s is None:
        return histogram(values, "x", 1, digits=digits)
    return histogram(values, "x", _bins(s, most), s["lo"], s["hi"], digits)


def bandwidth(n: int, sd: float | None, iqr: float, digits: int = 6) -> float | None:
    """Silverman's rule ``0.9 min(sd, IQR / 1.34) n^(-1/5)``; ``None`` if all values are equal."""
    if not sd:
        return None
    return round(0.9 * (min(sd, iqr / 1.34) if iqr > 0 else sd) * n ** -0.2, digits) or None


def density_curve(df: DataFrame, col: str, points: int = 256, width: float | None = None, cut: float = 3.0,
                  digits: int = 12) -> DataFrame:
    """Gaussian kernel density on an even grid: (point, x, density), ``points`` rows.

    The grid reaches ``cut`` bandwidths past the smallest and the largest value. Each value is shared
    between its two neighbouring grid points (linear binning) in one aggregate of at most
    ``points`` groups; the kernel is then summed over the grid alone. ``width`` is the bandwidth,
    by default Silverman's rule with the exact interquartile range. A column without two different
    finite values has no curve, hence no rows.
    """
    values = materialize(_finite(df, col), "density")
    s = _spread(values)
    h = None if s is None else (width or bandwidth(s["n"], s["sd"], s["iqr"]))
    if h is None:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    lo = s["lo"] - cut * h
    step = (s["hi"] + cut * h - lo) / (points - 1)
    at = (F.col("x") - F.lit(lo)) / F.lit(step)
    cells = values.select(at.alias("at")).select(F.floor("at").cast("int").alias("cell"), (F.col("at") - F.floor("at")).alias("part"))
    shared = cells.groupBy("cell").agg(F.sum(1 - F.col("part")).alias("here"), F.sum("part").alias("next"))
    mass = (shared.select(F.inline(F.array(F.struct(F.col("cell").alias("g"), F.col("here").alias("w")),
                                           F.struct((F.col("cell") + 1).alias("g"), F.col("next").alias("w")))))
            .groupBy("g").agg(F.sum("w").alias("w")))
    # One row with at most ``points`` weights, then a row per grid point.
    grid = (mass.agg(F.sort_array(F.collect_list(F.struct("g", "w"))).alias("mass"))
            .select("mass", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")))
    z = lambda m: (F.col("point") - m["g"]) * F.lit(step) / F.lit(h)
    total = F.aggregate("mass", F.lit(0.0), lambda acc, m: acc + m["w"] * F.exp(F.lit(-0.5) * z(m) * z(m)))
    return grid.select("point", F.round(F.lit(lo) + F.col("point") * F.lit(step), 6).alias("x"),
                       F.round(total / F.lit(s["n"] * h * math.sqrt(2 * math.pi)), digits).alias("density")).orderBy("point")


# --- gamma with location -------------------------------------------------------------------------

def digamma(x: float) -> float:
    """Derivative of ln Gamma for x > 0: shifted past 10 by the recurrence, then its asymptotic series."""
    shift = 0.0
    while x < 10:
        shift -= 1 / x
        x += 1
    y = 1 / (x * x)
    return shift + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def trigamma(x: float) -> float:
    """Second derivative of ln Gamma for x > 0, in the same way."""
    shift = 0.0
    while x < 10:
        shift += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return shift + 1 / x + 0.5 * y + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y * (1 / 30 - y * 5 / 66))))


def gamma_shape(s: float) -> float:
    """The maximum-likelihood shape: the root of ``ln a - digamma(a) = s`` by Newton steps in 1/a."""
    a = (3 - s + math.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    for _ in range(20):
        step = (math.log(a) - digamma(a) - s) / (a * a * (1 / a - trigamma(a)))
        a = 1 / (1 / a + step)
        if abs(step) * a < 1e-14:
            break
    return a


def _profile(n: int, mean: float, t: float, low: float, mean_log: float, inverse: float, square: float) -> dict:
    """The profile likelihood at location ``low - t``: best shape and scale there, and the slope and
    curvature of the mean log-likelihood in the location."""
    location = low - t
    centre = mean - location
    s = math.log(centre) - mean_log
    a = gamma_shape(max(s, 1e-12))
    ds = inverse - 1 / centre
    da = ds / (1 / a - trigamma(a))
    slope = a / centre - (a - 1) * inverse
    curve = da / centre + a / centre ** 2 - da * inverse - (a - 1) * square
    scale = centre / a
    return {"t": t, "location": location, "shape": a, "scale": scale, "slope": slope, "curve": curve,
            "log_likelihood": (a - 1) * mean_log - a - a * math.log(scale) - math.lgamma(a)}


def gamma_log_likelihood(shape: float, scale: float, mean: float, mean_log: float) -> float:
    """Mean log-likelihood per row of a gamma distribution, from the two means it depends on (taken
    from the location on)."""
    return (shape - 1) * mean_log - mean / scale - shape * math.log(scale) - math.lgamma(shape)


def fit_gamma_location(df: DataFrame, col: str, digits: int = 6, tolerance: float = 1e-12, passes: int = 40) -> DataFrame:
    """Maximum-likelihood gamma fit with a free location: one row (n, location, shape, scale,
    log_likelihood, score_location, score_shape, score_scale).

    For a location the best shape and scale follow from three means; the location itself is the root
    of the profile likelihood's slope. Each pass over the value counts evaluates a whole set of
    locations: first a geometric grid of distances below the smallest value, from far to near, which
    brackets the first maximum, then points inside the bracket together with the Newton step
    (by digamma and trigamma) from the best of them. The likelihood has no bound where the location
    meets the smallest value, so the fit is this inner maximum; without one (no skew to the right)
    the parameters are NULL. ``log_likelihood`` and the scores (its slopes in each parameter, zero
    at a maximum) are means per row, summed over the data at the solution.
    """
    spark = df.sparkSession
    schema = ("n bigint, location double, shape double, scale double, log_likelihood double, "
              "score_location double, score_shape double, score_scale double")
    counts = materialize(_finite(df, col).groupBy("x").agg(F.count("*").alias("c")), "gamma-values")
    head = counts.agg(F.sum("c").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum(F.col("x") * F.col("c")).alias("sum")).first()
    none = spark.createDataFrame([(head["n"] or 0, *[None] * 7)], schema)
    if not head["n"] or head["lo"] == head["hi"]:
        return none
    n, low, mean = head["n"], head["lo"], head["sum"] / head["n"]

    def evaluate(distances: Sequence[float]) -> list[dict]:
        sums = []
        for j, t in enumerate(distances):
            y = F.col("x") - F.lit(low - t)
            sums += [F.sum(F.col("c") * F.ln(y)).alias(f"l{j}"), F.sum(F.col("c") / y).alias(f"i{j}"), F.sum(F.col("c") / (y * y)).alias(f"s{j}")]
        row = counts.agg(*sums).first()
        return [_profile(n, mean, t, low, row[f"l{j}"] / n, row[f"i{j}"] / n, row[f"s{j}"] / n) for j, t in enumerate(distances)]

    grid = evaluate([(mean - low) * 2.0 ** k for k in range(10, -14, -1)])
    rising = [(far, near) for far, near in zip(grid, grid[1:], strict=False) if far["slope"] > 0 >= near["slope"]]
    if not rising:
        return none
    far, near = rising[0]
    best = min(far, near, key=lambda p: abs(p["slope"]))
    for _ in range(passes):
        step = -best["slope"] / best["curve"] if best["curve"] else 0.0
        if abs(step) <= tolerance * best["t"] or far["t"] - near["t"] <= tolerance * far["t"]:
            break
        inner = [near["t"] + (far["t"] - near["t"]) * k / 6 for k in range(1, 6)]
        newton = best["t"] - step
        inner += [t for t in (newton, newton * (1 - 1e-6), newton * (1 + 1e-6)) if near["t"] < t < far["t"]]
        points = sorted([far, near, *evaluate(inner)], key=lambda p: -p["t"])
        far, near = next((a, b) for a, b in zip(points, points[1:], strict=False) if a["slope"] > 0 >= b["slope"])
        best = min(points, key=lambda p: abs(p["slope"]))
    a, b, loc = best["shape"], best["scale"], best["location"]
    y = F.col("x") - F.lit(loc)
    c = F.col("c") / F.lit(float(n))
    sums = counts.agg(F.sum(c * F.ln(y)).alias("l"), F.sum(c * y).alias("m"), F.sum(c * (F.lit(1 / b) - (a - 1) / y)).alias("g")).first()
    return spark.createDataFrame([(
        n, round(loc, digits), round(a, digits), round(b, digits),
        round((a - 1) * sums["l"] - sums["m"] / b - a * math.log(b) - math.lgamma(a), digits),
        round(sums["g"], digits) + 0.0, round(sums["l"] - math.log(b) - digamma(a), digits) + 0.0,
        round(sums["m"] / b ** 2 - a / b, digits) + 0.0)], schema)
