"""Loan-book exploration: yearly book, defaults by key, contingency tables.

Every operator here aggregates on the map side first (at most one row per group
per task crosses the shuffle), so a hot group is collapsed before it crosses the
network; medians are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.functions.parse import default_flag, issue_year
from lendscope.operators import quantiles
from lendscope.session import materialize


def loan_book_by_year(df: DataFrame, amount: str = "loan_amnt", rate: str = "int_rate",
                      issue: str = "issue_d", **how) -> DataFrame:
    """Number of loans, total amount, median amount and median rate per issue year.

    Both medians are exact: the smallest value that half of the year's values do not exceed.
    Amount and rate are unpivoted, so one quantile pass serves both. Year, amount and rate are
    written once; what follows reads that layer.
    """
    rows = materialize(df.select(issue_year(issue).alias("issue_d_year"), F.col(amount).cast("double").alias("_amt"),
                                 F.col(rate).cast("double").alias("_rate")), "book")
    book = rows.groupBy("issue_d_year").agg(F.count(F.lit(1)).alias("n_loans"), F.round(F.sum("_amt"), 2).alias("total_loan_amnt"))
    long = rows.select("issue_d_year", F.inline(F.array(
        F.struct(F.lit("amt").alias("_of"), F.col("_amt").alias("_v")), F.struct(F.lit("rate").alias("_of"), F.col("_rate").alias("_v")))))
    medians = quantiles.exact_quantiles(long, "_v", ["issue_d_year", "_of"], [0.5], kind="disc", written=True, **how)
    median = lambda of: F.max(F.when(F.col("_of") == of, F.col("q")[0]))
    wide = medians.groupBy(F.col("issue_d_year").alias("_year")).agg(
        median("amt").alias("median_loan_amnt"), median("rate").alias("median_int_rate"))
    return (book.join(wide, book["issue_d_year"].eqNullSafe(wide["_year"]), "left")
            .select("issue_d_year", "n_loans", "total_loan_amnt", "median_loan_amnt", "median_int_rate")
            .orderBy("issue_d_year"))


def defaults_by(df: DataFrame, keys: Sequence[str], label: str = "target",
                amount: str = "loan_amnt") -> DataFrame:
    """Loans, defaults, default rate and defaulted exposure per key."""
    is_bad = F.col(label) == 1
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_loans"),
            F.sum(F.col(label)).cast("bigint").alias("n_defaults"),
            F.round(F.sum(F.when(is_bad, F.col(amount)).otherwise(F.lit(0.0))), 2)
            .alias("defaulted_amnt"),
        )
        .withColumn("default_rate", F.round(F.col("n_defaults") / F.col("n_loans"), 6))
        .orderBy(*keys)
    )


def with_default_label(df: DataFrame, status: str = "loan_status", label: str = "target") -> DataFrame:
    return df.withColumn(label, default_flag(status))


def crosstab_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """Contingency counts in long form: one row per pair that occurs, (row, col, n); NULL keys
    stay NULL. One aggregate with map-side combining, whatever the number of values."""
    return (df.groupBy(F.col(row).cast("string").alias(row), F.col(col).cast("string").alias(col))
            .agg(F.count(F.lit(1)).alias("n")))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str] | None = None, other: str = "other") -> DataFrame:
    """Contingency table in wide form, without losing a row: a column per value, one named ``null``
    for NULL and, with a list of ``values``, one named ``other`` for all values outside it.

    The first column is ``<row>_<col>`` with NULL rendered as ``null``. Without ``values`` the columns
    are the values found (a schema needs their names on the driver); for a column with very many
    values use :func:`crosstab_long`, which has the same counts.
    """
    cells = crosstab_long(df, row, col)
    if values is None:
        values = sorted(r[0] for r in cells.where(F.col(col).isNotNull()).select(col).distinct().collect())
        rest = []
    else:
        values = list(values)
        outside = F.col(col).isNotNull() & ~F.col(col).isin(values)
        rest = [F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias(other)]
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    key = F.coalesce(F.col(row), F.lit("null")).alias(f"{row}_{col}")
    return (cells.groupBy(key).agg(*[count(F.col(col) == v).alias(str(v)) for v in values], *rest,
                                   count(F.col(col).isNull()).alias("null")).orderBy(f"{row}_{col}"))
