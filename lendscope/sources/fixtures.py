"""The loan-shaped test view built from ``orders`` and ``customer``.

The driver's tables carry no dirt, so loan fields (and their typical defects:
shifted text, NULL, NaN, empty strings, ``n/a``) are derived from the order key
``k`` by fixed arithmetic. The same rules are given twice: as Spark column
expressions (:func:`loans_view`) and as DuckDB SQL (:data:`LOANS_SQL`) for the
oracle. Both must stay in step.

Scale: the view is an inner equi-join of the fact table to ``customer`` on the
customer key. No broadcast hint is given: Spark's size-checked planner
(``autoBroadcastJoinThreshold``) broadcasts ``customer`` only while its
estimated size is under the limit, and otherwise runs a sort-merge join;
AQE re-plans at runtime and splits a skewed customer key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.session import keep_methods_small
from lendscope.sources.tables import read_table

_STATUS_BY_K20 = [
    (0, "Charged Off"), (1, "Charged Off"), (2, "Default"), (3, "Late (31-120 days)"),
    (4, "Late (16-30 days)"), (5, "In Grace Period"),
    (6, "Does not meet the credit policy. Status:Charged Off"),
    (7, "Does not meet the credit policy. Status:Fully Paid"),
    (8, None), (9, "Current"), (10, "Current"), (11, "Current"),
]


def loans_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    cust = customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
    k = F.col("o_orderkey")
    k13 = k % 13
    k20 = k % 20
    status = F.lit("Fully Paid")
    for value, text in reversed(_STATUS_BY_K20):
        status = F.when(k20 == value, F.lit(text).cast("string")).otherwise(status)
    grade = F.translate(F.substring("o_orderpriority", 1, 1), "12345", "ABCDE")
    state_letter = F.chr(F.lit(65) + F.col("c_nationkey"))
    return j.select(
        k.alias("id"),
        F.col("o_totalprice").alias("loan_amnt"),
        (F.lit(5.0) + ((k * 37) % 2000).cast("double") / F.lit(100.0)).alias("int_rate"),
        F.date_format("o_orderdate", "MMM-yyyy").alias("issue_d"),
        F.when(k % 3 == 0, F.lit(" 60 months")).otherwise(F.lit(" 36 months")).alias("term"),
        F.when(k13 == 0, F.lit("< 1 year"))
        .when(k13 == 1, F.lit("1 year"))
        .when(k13 == 10, F.lit("10+ years"))
        .when(k13 == 11, F.lit("n/a"))
        .when(k13 == 12, F.lit(None).cast("string"))
        .otherwise(F.concat(k13.cast("string"), F.lit(" years"))).alias("emp_length"),
        status.alias("loan_status"),
        F.when(k % 71 == 0, F.lit(None).cast("string")).when(k % 73 == 0, F.lit("H"))
        .otherwise(grade).alias("grade"),
        F.concat(grade, ((F.col("o_custkey") % 5) + 1).cast("string")).alias("sub_grade"),
        F.when(k % 101 == 0, F.lit(None).cast("string"))
        .when(k % 103 == 0, F.lit(""))
        .when(k % 97 == 0, F.lit("car loan"))
        .otherwise(F.concat(state_letter, state_letter)).alias("addr_state"),
        F.when(k % 83 == 0, F.lit(None).cast("string"))
        .when(k % 89 == 0, F.lit("debt consolidation"))
        .otherwise(F.concat((k % 50).cast("string"), F.lit(".5"))).alias("dti"),
        F.when(k % 79 == 0, F.lit("OWN")).otherwise((k % 4).cast("string")).alias("delinq_2yrs"),
        F.when(k % 61 == 0, F.lit(float("nan")))
        .when(k % 59 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal")).alias("annual_inc"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .otherwise((k % 1000).cast("string")).alias("tot_coll_amt"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise((k % 9000).cast("string")).alias("tot_cur_bal"),
        F.when(k % 160 == 0, F.lit("COMPLETE")).otherwise(F.lit(None).cast("string"))
        .alias("settlement_status"),
        F.lit(None).cast("string").alias("member_id"),
        F.when(k % 25 == 0, F.lit("free text"))
        .when(k % 27 == 0, F.lit(""))
        .when(k % 29 == 0, F.lit("NULL"))
        .otherwise(F.lit(None).cast("string")).alias("desc_text"),
        F.col("c_mktsegment").alias("purpose"),
    )


def loans_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep_methods_small(spark)
    return loans_from(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))


# DuckDB form of the same rules (for the oracle); ``{orders}``/``{customer}`` are views.
LOANS_SQL = """
loans AS (
  SELECT
    o.o_orderkey AS id,
    o.o_totalprice AS loan_amnt,
    CAST(5 AS DOUBLE) + CAST((o.o_orderkey * 37) % 2000 AS DOUBLE) / CAST(100 AS DOUBLE) AS int_rate,
    strftime(o.o_orderdate, '%b-%Y') AS issue_d,
    CASE WHEN o.o_orderkey % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
    CASE o.o_orderkey % 13 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
         WHEN 11 THEN 'n/a' WHEN 12 THEN NULL
         ELSE CAST(o.o_orderkey % 13 AS VARCHAR) || ' years' END AS emp_length,
    CASE o.o_orderkey % 20 WHEN 0 THEN 'Charged Off' WHEN 1 THEN 'Charged Off' WHEN 2 THEN 'Default'
         WHEN 3 THEN 'Late (31-120 days)' WHEN 4 THEN 'Late (16-30 days)' WHEN 5 THEN 'In Grace Period'
         WHEN 6 THEN 'Does not meet the credit policy. Status:Charged Off'
         WHEN 7 THEN 'Does not meet the credit policy. Status:Fully Paid'
         WHEN 8 THEN NULL WHEN 9 THEN 'Current' WHEN 10 THEN 'Current' WHEN 11 THEN 'Current'
         ELSE 'Fully Paid' END AS loan_status,
    CASE WHEN o.o_orderkey % 71 = 0 THEN NULL WHEN o.o_orderkey % 73 = 0 THEN 'H'
         ELSE translate(substr(o.o_orderpriority, 1, 1), '12345', 'ABCDE') END AS grade,
    translate(substr(o.o_orderpriority, 1, 1), '12345', 'ABCDE') || CAST(o.o_custkey % 5 + 1 AS VARCHAR) AS sub_grade,
    CASE WHEN o.o_orderkey % 101 = 0 THEN NULL WHEN o.o_orderkey % 103 = 0 THEN ''
         WHEN o.o_orderkey % 97 = 0 THEN 'car loan'
         ELSE chr(65 + c.c_nationkey) || chr(65 + c.c_nationkey) END AS addr_state,
    CASE WHEN o.o_orderkey % 83 = 0 THEN NULL WHEN o.o_orderkey % 89 = 0 THEN 'debt consolidation'
         ELSE CAST(o.o_orderkey % 50 AS VARCHAR) || '.5' END AS dti,
    CASE WHEN o.o_orderkey % 79 = 0 THEN 'OWN' ELSE CAST(o.o_orderkey % 4 AS VARCHAR) END AS delinq_2yrs,
    CASE WHEN o.o_orderkey % 61 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o.o_orderkey % 59 = 0 THEN NULL
         ELSE c.c_acctbal END AS annual_inc,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE CAST(o.o_orderkey % 1000 AS VARCHAR) END AS tot_coll_amt,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(o.o_orderkey % 9000 AS VARCHAR) END AS tot_cur_bal,
    CASE WHEN o.o_orderkey % 160 = 0 THEN 'COMPLETE' ELSE NULL END AS settlement_status,
    CAST(NULL AS VARCHAR) AS member_id,
    CASE WHEN o.o_orderkey % 25 = 0 THEN 'free text' WHEN o.o_orderkey % 27 = 0 THEN ''
         WHEN o.o_orderkey % 29 = 0 THEN 'NULL' ELSE NULL END AS desc_text,
    c.c_mktsegment AS purpose
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)
"""


def with_loans(body: str, *ctes: str) -> str:
    """Prefix a DuckDB query with the loans CTE (and any further CTEs)."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {LOANS_SQL}{extra}\n{body}"


# Column names and Spark types of the loan view, in order (used to generate oracle SQL).
LOANS_SCHEMA = (
    ("id", "bigint"), ("loan_amnt", "double"), ("int_rate", "double"), ("issue_d", "string"),
    ("term", "string"), ("emp_length", "string"), ("loan_status", "string"), ("grade", "string"),
    ("sub_grade", "string"), ("addr_state", "string"), ("dti", "string"),
    ("delinq_2yrs", "string"), ("annual_inc", "double"), ("tot_coll_amt", "string"),
    ("tot_cur_bal", "string"), ("settlement_status", "string"), ("member_id", "string"),
    ("desc_text", "string"), ("purpose", "string"),
)


def sql_is_missing(name: str, dtype: str) -> str:
    """DuckDB form of :func:`lendscope.functions.missing.is_missing`."""
    if dtype == "string":
        return (f"({name} IS NULL OR {name} = '' OR contains({name}, 'None') "
                f"OR contains({name}, 'NULL'))")
    if dtype in ("double", "float"):
        return f"({name} IS NULL OR isnan({name}))"
    return f"({name} IS NULL)"
