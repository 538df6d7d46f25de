"""Parsing, filling and distribution queries over the loan view."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendscope.constants import ZERO_BAL_STATUSES, ZERO_COLL_STATUSES
from lendscope.operators import bootstrap, density, distribution
from lendscope.plans.catalog import register
from lendscope.plans.curate import parse_strings
from lendscope.sources.fixtures import loans_view, with_loans

_PARSED_SQL = """parsed AS (
  SELECT *,
    TRY_CAST(string_split(issue_d, '-')[2] AS INTEGER) AS issue_d_year,
    TRY_CAST(trim(regexp_replace(emp_length, 'years|year|\\+|\\<', '', 'g')) AS INTEGER) AS emplength_clean,
    TRY_CAST(regexp_extract(term, '\\d+', 0) AS INTEGER) AS term_clean
  FROM loans)"""


def parsed_loans(spark, sf_dir):
    return parse_strings(loans_view(spark, sf_dir))


@register("parse_loan_strings", with_loans(
    "SELECT id, issue_d_year, emplength_clean, term_clean FROM parsed", _PARSED_SQL))
def parse_loan_strings(spark, sf_dir):
    return parsed_loans(spark, sf_dir).select("id", "issue_d_year", "emplength_clean", "term_clean")


def _in(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


@register("fill_balances", with_loans(f"""
SELECT id,
  CASE WHEN tot_coll_amt IS NULL AND loan_status IN ({_in(ZERO_COLL_STATUSES)}) THEN 0.0
       ELSE TRY_CAST(tot_coll_amt AS DOUBLE) END AS tot_coll_amt_clean,
  CASE WHEN tot_cur_bal IS NULL AND loan_status IN ({_in(ZERO_BAL_STATUSES)}) THEN 0.0
       ELSE TRY_CAST(tot_cur_bal AS DOUBLE) END AS tot_cur_bal_clean
FROM loans
"""))
def fill_balances(spark, sf_dir):
    from lendscope.plans.curate import fill_balances as fill
    return fill(loans_view(spark, sf_dir)).select("id", "tot_coll_amt_clean", "tot_cur_bal_clean")


@register("fill_zero", with_loans("""
SELECT id, loan_amnt, int_rate,
  CASE WHEN annual_inc IS NULL OR isnan(annual_inc) THEN 0.0 ELSE annual_inc END AS annual_inc
FROM loans
"""))
def fill_zero(spark, sf_dir):
    return loans_view(spark, sf_dir).na.fill(0).select("id", "loan_amnt", "int_rate", "annual_inc")


@register("histogram", with_loans("""
SELECT b.bin, round(r.lo + b.bin * r.w, 6) AS bin_lo, round(r.lo + (b.bin + 1) * r.w, 6) AS bin_hi,
       coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) b
CROSS JOIN rng r
LEFT JOIN (SELECT CAST(least(floor((loan_amnt - r.lo) / r.w), 19) AS INTEGER) AS bin, count(*) AS n
           FROM loans, rng r WHERE loan_amnt IS NOT NULL GROUP BY 1) c ON b.bin = c.bin
ORDER BY b.bin
""", "rng AS (SELECT min(loan_amnt) AS lo, (max(loan_amnt) - min(loan_amnt)) / 20 AS w FROM loans)"))
def histogram(spark, sf_dir):
    return distribution.histogram(loans_view(spark, sf_dir), "loan_amnt", bins=20)


@register("gamma_fit", with_loans("""
SELECT n, round(m, 6) AS mean, round(ml, 6) AS mean_log, round(s, 6) AS s,
       round((3 - s + sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s), 6) AS shape,
       round(m / ((3 - s + sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s)), 6) AS scale
FROM (SELECT n, m, ml, ln(m) - ml AS s FROM
       (SELECT count(*) AS n, avg(loan_amnt) AS m, avg(ln(loan_amnt)) AS ml FROM loans WHERE loan_amnt > 0))
"""))
def gamma_fit(spark, sf_dir):
    return distribution.fit_gamma(loans_view(spark, sf_dir), "loan_amnt")


def _box_sql(value, by, source="loans"):
    keys = ", ".join(by)
    kp = (keys + ", ") if by else ""
    grp = f"GROUP BY {keys}" if by else ""
    on = " AND ".join(f"r.{k} IS NOT DISTINCT FROM q.{k}" for k in by) or "TRUE"
    qsel = ", ".join(f"q.{k}" for k in by)
    qsel = (qsel + ", ") if by else ""
    return f"""
SELECT {qsel}q.n, round(q.q1, 6) AS q1, round(q.median, 6) AS median, round(q.q3, 6) AS q3, round(q.q3 - q.q1, 6) AS iqr,
       min(CASE WHEN r.x >= q.q1 - 1.5 * (q.q3 - q.q1) THEN r.x END) AS whisker_lo,
       max(CASE WHEN r.x <= q.q3 + 1.5 * (q.q3 - q.q1) THEN r.x END) AS whisker_hi,
       count(*) FILTER (WHERE r.x < q.q1 - 1.5 * (q.q3 - q.q1) OR r.x > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers,
       q.min_value, q.max_value
FROM (SELECT {kp}CAST({value} AS DOUBLE) AS x FROM {source}
      WHERE {value} IS NOT NULL AND NOT isnan(CAST({value} AS DOUBLE))) r
JOIN (SELECT {kp}count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3, min(x) AS min_value, max(x) AS max_value
      FROM (SELECT {kp}CAST({value} AS DOUBLE) AS x FROM {source}
            WHERE {value} IS NOT NULL AND NOT isnan(CAST({value} AS DOUBLE))) {grp}) q ON {on}
GROUP BY {qsel}q.n, q.q1, q.median, q.q3, q.min_value, q.max_value
"""


def _rounded(df):
    """Interpolation differs in the last bit from engine to engine."""
    return df.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3", "iqr")})


@register("box_stats", with_loans(_box_sql("loan_amnt", [])))
def box_stats(spark, sf_dir):
    return _rounded(distribution.box_stats(loans_view(spark, sf_dir), "loan_amnt"))


@register("box_stats_by", with_loans(_box_sql("loan_amnt", ["emplength_clean", "term_clean"], "parsed"),
                                     _PARSED_SQL))
def box_stats_by(spark, sf_dir):
    return _rounded(distribution.box_stats(parsed_loans(spark, sf_dir), "loan_amnt", ["emplength_clean", "term_clean"]))


@register("box_stats_facet", with_loans(_box_sql("int_rate", ["sub_grade", "grade"])))
def box_stats_facet(spark, sf_dir):
    return _rounded(distribution.box_stats(loans_view(spark, sf_dir), "int_rate", ["sub_grade", "grade"]))


@register("mean_ci", with_loans("""
SELECT sub_grade, count(*) AS n, round(avg(loan_amnt), 6) AS mean, round(stddev_samp(loan_amnt), 6) AS stddev,
       round(avg(loan_amnt) - 1.96 * stddev_samp(loan_amnt) / sqrt(CAST(count(*) AS DOUBLE)), 6) AS ci_lo,
       round(avg(loan_amnt) + 1.96 * stddev_samp(loan_amnt) / sqrt(CAST(count(*) AS DOUBLE)), 6) AS ci_hi
FROM loans WHERE loan_amnt IS NOT NULL AND NOT isnan(loan_amnt) GROUP BY sub_grade ORDER BY sub_grade
"""))
def mean_ci(spark, sf_dir):
    return distribution.mean_ci(loans_view(spark, sf_dir), "loan_amnt", ["sub_grade"])


_FINITE = "{c} IS NOT NULL AND NOT isnan({c}) AND NOT isinf({c})"
_SPREAD_SQL = """v AS MATERIALIZED (SELECT CAST({c} AS DOUBLE) AS x FROM loans WHERE """ + _FINITE + """),
s AS MATERIALIZED (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd,
  quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM v)"""


@register("auto_histogram", with_loans("""
SELECT CAST(b.bin AS INTEGER) AS bin, round(r.lo + b.bin * r.w, 6) AS bin_lo, round(r.lo + (b.bin + 1) * r.w, 6) AS bin_hi,
       coalesce(c.n, 0) AS n
FROM r, unnest(range(r.bins)) AS b(bin)
LEFT JOIN (SELECT least(floor((x - r.lo) / r.w), r.bins - 1) AS bin, count(*) AS n FROM v, r GROUP BY 1) c ON b.bin = c.bin
ORDER BY b.bin
""", _SPREAD_SQL.format(c="loan_amnt"), f"""r AS MATERIALIZED (SELECT lo, bins, (hi - lo) / bins AS w FROM (
  SELECT lo, hi, CAST(least({density.MAX_BINS}, ceil((hi - lo) / (2 * iqr / n ** (1.0 / 3)))) AS BIGINT) AS bins FROM s))"""))
def auto_histogram(spark, sf_dir):
    return density.auto_histogram(loans_view(spark, sf_dir), "loan_amnt")


def _density_sql(col, points=256):
    return with_loans(f"""
SELECT CAST(p.point AS INTEGER) AS point, round(g.lo + p.point * g.step, 6) AS x,
       round((SELECT sum(m.w * exp(-0.5 * ((p.point - m.cell) * g.step / g.h) ** 2)) FROM m) / (g.n * g.h * sqrt(2 * pi())), 12) AS density
FROM g, unnest(range({points})) AS p(point) ORDER BY 1
""", _SPREAD_SQL.format(c=col), f"""g AS MATERIALIZED (SELECT n, h, lo - 3 * h AS lo, (hi + 3 * h - (lo - 3 * h)) / {points - 1} AS step FROM (
  SELECT *, round(0.9 * least(sd, iqr / 1.34) * n ** -0.2, 6) AS h FROM s))""",
        """m AS MATERIALIZED (SELECT cell, sum(w) AS w FROM (
  SELECT floor((x - g.lo) / g.step) AS cell, 1 - ((x - g.lo) / g.step - floor((x - g.lo) / g.step)) AS w FROM v, g
  UNION ALL SELECT floor((x - g.lo) / g.step) + 1, (x - g.lo) / g.step - floor((x - g.lo) / g.step) FROM v, g) GROUP BY cell)""")


@register("density_curve", _density_sql("loan_amnt"))
def density_curve(spark, sf_dir):
    return density.density_curve(loans_view(spark, sf_dir), "loan_amnt")


@register("density_curve_rate", _density_sql("int_rate"))
def density_curve_rate(spark, sf_dir):
    return density.density_curve(loans_view(spark, sf_dir), "int_rate")


@register("gamma_fit_location", with_loans("""
SELECT count(*) AS n, round(avg(loan_amnt * int_rate / 100), 2) AS mean, 0 AS score_location, 0 AS score_shape, 0 AS score_scale, TRUE AS better
FROM loans WHERE loan_amnt IS NOT NULL
"""))
def gamma_fit_location(spark, sf_dir):
    """What a maximum-likelihood fit must satisfy, for the yearly interest of a loan: the fitted mean is
    the sample's, the slopes of the likelihood in all parameters are zero over the data, and it is
    likelier than the fit without location."""
    interest = loans_view(spark, sf_dir).select((F.col("loan_amnt") * F.col("int_rate") / 100).alias("interest"))
    fit = density.fit_gamma_location(interest, "interest")
    fixed = distribution.fit_gamma(interest, "interest").first()
    likelihood = density.gamma_log_likelihood(fixed["shape"], fixed["scale"], fixed["mean"], fixed["mean_log"])
    return fit.select("n", F.round(F.col("location") + F.col("shape") * F.col("scale"), 2).alias("mean"),
                      *[F.round(F.col(c), 6).cast("int").alias(c) for c in ("score_location", "score_shape", "score_scale")],
                      (F.col("log_likelihood") > likelihood).alias("better"))


def _bootstrap_sql(value, by, replicates=200, seed=0):
    mask, per_word = (1 << bootstrap.DRAW_BITS) - 1, bootstrap.DRAWS_PER_HASH // 2
    draws = ", ".join(f"struct_pack(r := c * {bootstrap.DRAWS_PER_HASH} + {i * per_word + j}, u := (w{i} >> {bootstrap.DRAW_BITS * j}) & {mask})"
                      for i in (0, 1) for j in range(per_word))
    weight = " + ".join(f"CASE WHEN d.u >= {t} THEN 1 ELSE 0 END" for t in bootstrap.poisson_thresholds())
    return with_loans(f"""
SELECT {by}, max(CASE WHEN r = -1 THEN w END) AS n, round(max(CASE WHEN r = -1 THEN m END), 6) AS mean,
       round(quantile_cont(CASE WHEN r >= 0 THEN m END, 0.025), 6) AS ci_lo, round(quantile_cont(CASE WHEN r >= 0 THEN m END, 0.975), 6) AS ci_hi
FROM (SELECT {by}, r, CAST(sum(w) AS BIGINT) AS w, sum(w * x) / sum(w) AS m FROM (
  SELECT {by}, x, d.r AS r, {weight} AS w FROM words, unnest([{draws}]) AS t(d)
  UNION ALL SELECT {by}, x, -1, 1 FROM vals) WHERE w > 0 AND r < {replicates} GROUP BY {by}, r)
GROUP BY {by} ORDER BY {by}
""", f"vals AS (SELECT id, {by}, {value} AS x FROM loans WHERE {value} IS NOT NULL AND NOT isnan({value}))",
        f"hashed AS (SELECT {by}, x, c, md5(id || ':{seed}:' || c) AS h FROM vals, unnest(range({-(-replicates // bootstrap.DRAWS_PER_HASH)})) AS t(c))",
        "words AS (SELECT *, CAST('0x' || substr(h, 1, 15) AS BIGINT) AS w0, CAST('0x' || substr(h, 16, 15) AS BIGINT) AS w1 FROM hashed)")


@register("bootstrap_ci", _bootstrap_sql("loan_amnt", "sub_grade"))
def bootstrap_ci(spark, sf_dir):
    return bootstrap.bootstrap_ci(loans_view(spark, sf_dir), "loan_amnt", ["sub_grade"])
