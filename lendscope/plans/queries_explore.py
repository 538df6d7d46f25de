"""Exploration queries over the loan view (yearly book, states, grades)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendscope.constants import DEFAULT_STATUSES, GRADES, SUB_GRADES
from lendscope.functions.order import ordinal
from lendscope.functions.parse import default_flag
from lendscope.operators import explore
from lendscope.plans.catalog import register
from lendscope.sources.fixtures import loans_view, with_loans

_BAD = ", ".join(f"'{s}'" for s in DEFAULT_STATUSES)


@register("loan_book_by_year", with_loans("""
SELECT CAST(string_split(issue_d, '-')[2] AS INTEGER) AS issue_d_year,
       count(*) AS n_loans,
       round(sum(loan_amnt), 2) AS total_loan_amnt,
       quantile_disc(loan_amnt, 0.5) AS median_loan_amnt,
       quantile_disc(int_rate, 0.5) AS median_int_rate
FROM loans GROUP BY 1 ORDER BY 1
"""))
def loan_book_by_year(spark, sf_dir):
    return explore.loan_book_by_year(loans_view(spark, sf_dir))


@register("default_flag", with_loans("""
SELECT id, loan_status,
       CASE WHEN loan_status IN (%s) THEN 1 ELSE 0 END AS target
FROM loans
""" % _BAD))
def default_flag_q(spark, sf_dir):
    return loans_view(spark, sf_dir).select("id", "loan_status", default_flag("loan_status").alias("target"))


@register("defaults_by_state", with_loans("""
SELECT addr_state, count(*) AS n_loans, CAST(sum(target) AS BIGINT) AS n_defaults,
       round(sum(CASE WHEN target = 1 THEN loan_amnt ELSE 0.0 END), 2) AS defaulted_amnt,
       round(CAST(sum(target) AS DOUBLE) / count(*), 6) AS default_rate
FROM labelled GROUP BY addr_state ORDER BY addr_state
""", """labelled AS (
  SELECT *, CASE WHEN loan_status IN (%s) THEN 1 ELSE 0 END AS target
  FROM loans)""" % _BAD))
def defaults_by_state(spark, sf_dir):
    df = explore.with_default_label(loans_view(spark, sf_dir))
    return explore.defaults_by(df, ["addr_state"])


_GRADE_LIST = ", ".join(f"'{g}'" for g in GRADES)
_CROSSTAB_SQL_CELLS = ",\n       ".join(f"count(*) FILTER (WHERE grade = '{g}') AS \"{g}\"" for g in GRADES)


@register("status_grade_crosstab", with_loans(f"""
SELECT coalesce(loan_status, 'null') AS loan_status_grade,
       {_CROSSTAB_SQL_CELLS},
       count(*) FILTER (WHERE grade NOT IN ({_GRADE_LIST})) AS other,
       count(*) FILTER (WHERE grade IS NULL) AS "null"
FROM loans GROUP BY 1 ORDER BY 1
"""))
def status_grade_crosstab(spark, sf_dir):
    return explore.crosstab(loans_view(spark, sf_dir), "loan_status", "grade", values=GRADES)


@register("status_grade_counts", with_loans("""
SELECT loan_status, grade, count(*) AS n FROM loans GROUP BY 1, 2
"""))
def status_grade_counts(spark, sf_dir):
    return explore.crosstab_long(loans_view(spark, sf_dir), "loan_status", "grade")


_SUB_GRADE_LIST = ", ".join(f"'{g}'" for g in SUB_GRADES)


@register("sub_grade_order", with_loans(f"""
SELECT sub_grade, CAST(nullif(list_position([{_SUB_GRADE_LIST}], sub_grade), 0) AS INTEGER) AS sub_grade_rank,
       count(*) AS n_loans, round(avg(int_rate), 6) AS mean_int_rate
FROM loans GROUP BY sub_grade ORDER BY sub_grade_rank
"""))
def sub_grade_order(spark, sf_dir):
    """Loans and mean rate per sub-grade with its place in the fixed A1..G5 order (the plot axis)."""
    return (loans_view(spark, sf_dir).groupBy("sub_grade")
            .agg(F.count(F.lit(1)).alias("n_loans"), F.round(F.avg("int_rate"), 6).alias("mean_int_rate"))
            .select("sub_grade", ordinal("sub_grade", SUB_GRADES).alias("sub_grade_rank"),
                    "n_loans", "mean_int_rate")
            .orderBy("sub_grade_rank"))
