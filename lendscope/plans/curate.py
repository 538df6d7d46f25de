"""The cleaning chain as composable DataFrame -> DataFrame steps.

raw (all text) -> valid rows (row rules) -> sparse/redundant columns dropped ->
parsed numbers -> balances filled + default label -> replaced/free-text/post-outcome
columns dropped -> numeric NULL/NaN filled with 0 (the curated layer).
Each step is lazy; Catalyst collapses the chain into one projection and filter
over a single scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.constants import (
    FREE_TEXT_DROP_STEP2, POST_OUTCOME_DROP_STEP2, REDUNDANT_DROP_STEP1, REPLACED_DROP_STEP2,
    ROW_RULES, SPARSE_DROP_STEP1, ZERO_BAL_STATUSES, ZERO_COLL_STATUSES,
)
from lendscope.functions.parse import default_flag, emp_length_years, issue_year, term_months
from lendscope.operators.columns import drop_columns
from lendscope.operators.quality import keep_matching


def clean_rows(df: DataFrame, rules=ROW_RULES) -> DataFrame:
    return keep_matching(df, rules)


def drop_sparse(df: DataFrame) -> DataFrame:
    return drop_columns(drop_columns(df, SPARSE_DROP_STEP1), REDUNDANT_DROP_STEP1)


def parse_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "issue_d_year": issue_year("issue_d"),
        "emplength_clean": emp_length_years("emp_length"),
        "term_clean": term_months("term"),
    })


def fill_balances(df: DataFrame, status: str = "loan_status") -> DataFrame:
    """Zero-fill NULL balances for statuses where NULL means nothing owed, then cast."""
    st = F.col(status)
    coll, bal = F.col("tot_coll_amt"), F.col("tot_cur_bal")
    return df.withColumns({
        "tot_coll_amt_clean": F.when(coll.isNull() & st.isin(*ZERO_COLL_STATUSES), F.lit(0.0))
        .otherwise(coll.try_cast("double")),
        "tot_cur_bal_clean": F.when(bal.isNull() & st.isin(*ZERO_BAL_STATUSES), F.lit(0.0))
        .otherwise(bal.try_cast("double")),
    })


def label(df: DataFrame, status: str = "loan_status", label_col: str = "target") -> DataFrame:
    return df.withColumn(label_col, default_flag(status))


def drop_replaced(df: DataFrame) -> DataFrame:
    df = drop_columns(df, REPLACED_DROP_STEP2)
    df = drop_columns(df, FREE_TEXT_DROP_STEP2)
    return drop_columns(df, POST_OUTCOME_DROP_STEP2)


def curate(raw: DataFrame) -> DataFrame:
    """Raw loans -> curated loans (labelled, parsed, filled)."""
    df = clean_rows(raw)
    df = drop_sparse(df)
    df = parse_strings(df)
    df = fill_balances(df)
    df = label(df)
    df = drop_replaced(df)
    return df.na.fill(0)
