"""Plan checks: pushdown, pruning, no Python in the hot path, partition-count invariance."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["issue_d_year", "n_loans", "total_loan_amnt", "median_loan_amnt", "median_int_rate"]


def test_oracle_keys_are_queries():
    assert set(oracle_sql()) <= set(queries())


def _plans_of(spark, monkeypatch, key):
    """The plans of all layers a query writes, and its own."""
    from lendscope import session
    from lendscope.operators import distribution, explore, quality, quantiles
    plans = []

    def spy(df, name):
        plans.append(_plan(df))
        return session.materialize(df, name)
    for module in (distribution, explore, quality, quantiles):
        monkeypatch.setattr(module, "materialize", spy)
    own = _plan(queries()[key](spark, SF001))
    return [*plans, own]


def test_scan_prunes_columns(spark, monkeypatch):
    plans = _plans_of(spark, monkeypatch, "loan_book_by_year")
    # the scan of orders reads only what year, amount and rate need
    assert sum("ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate" in p for p in plans) == 1
    assert not any("o_orderstatus" in p for p in plans)


@pytest.mark.parametrize("key", ["loan_book_by_year", "box_stats", "box_stats_by", "box_stats_facet", "column_quartiles", "profile_report"])
def test_the_joined_loans_are_computed_once(spark, monkeypatch, key):
    scans = [p.count("orders.parquet") for p in _plans_of(spark, monkeypatch, key)]
    assert sum(scans) == 1


def test_filter_pushdown_on_parquet(spark):
    from pyspark.sql import functions as F
    from lendscope.sources.tables import read_table
    df = read_table(spark, SF001, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in _plan(df)


@pytest.mark.parametrize("key", ["loan_book_by_year", "missing_census", "profile_columns", "describe_long",
                                 "category_values", "box_stats_facet", "keep_valid_rows", "curated_loans",
                                 "scrub_ascii", "histogram", "index_categories"])
def test_no_python_in_plan(spark, key):
    plan = _plan(queries()[key](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan


@pytest.mark.parametrize("key", ["loan_book_by_year", "defaults_by_state", "box_stats_by", "category_values",
                                 "column_quartiles", "distinct_estimates", "sub_grade_order",
                                 "replicated_columns", "distinct_counts", "auto_histogram"])
def test_same_result_any_partition_count(spark, key):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(sorted(map(repr, queries()[key](spark, SF001).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


def test_medians_do_not_gather_a_groups_values(spark):
    """``percentile`` keeps every distinct value of a group in one task."""
    for key in ("loan_book_by_year", "box_stats_facet", "column_quartiles"):
        assert "percentile" not in _plan(queries()[key](spark, SF001))
