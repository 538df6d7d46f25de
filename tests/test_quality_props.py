import numpy as np
"""Property tests on the loan view (sf0.01) and small frames."""

from pyspark.sql import functions as F

from lendscope.operators import columns, quality
from lendscope.sources.fixtures import LOANS_SCHEMA, loans_view
from tests.conftest import SF001


def test_loan_view_schema_and_counts(spark):
    df = loans_view(spark, SF001)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == list(LOANS_SCHEMA)
    assert df.count() == 15000
    assert df.where(F.col("emp_length").isNull()).count() == 1153
    assert quality.keep_matching(df).count() == 14174


def test_keep_plus_quarantine_is_input(spark):
    df = loans_view(spark, SF001)
    kept, rejected = quality.split_valid(df)
    assert kept.count() + rejected.count() == df.count()
    ids_k = {r.id for r in kept.select("id").collect()}
    ids_r = {r.id for r in rejected.select("id").collect()}
    assert not ids_k & ids_r


def test_census_bounded_by_rows(spark):
    df = loans_view(spark, SF001)
    n = df.count()
    for r in quality.missing_census(df).collect():
        assert 0 <= r.n_missing <= n
    member = [r for r in quality.missing_census(df).collect() if r.column_name == "member_id"][0]
    assert member.n_missing == n


def test_category_counts_sum_to_rows(spark):
    df = loans_view(spark, SF001)
    out = quality.category_values(df, ["grade", "loan_status"])
    sums = {r.column_name: r.s for r in out.groupBy("column_name").agg(F.sum("n").alias("s")).collect()}
    assert sums == {"grade": 15000, "loan_status": 15000}


def test_drop_columns_strict(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert columns.drop_columns(df, ["a", "il_util has"]).columns == ["b"]
    try:
        columns.drop_columns(df, ["a", "il_util has"], strict=True)
        raise AssertionError("strict drop should fail")
    except KeyError:
        pass


def test_redundant_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "x")], "a int, b string, c string")
    got = {r.column_name: r.reason for r in columns.redundant_columns(df).collect()}
    assert got == {"b": "empty", "c": "constant"}


def test_distinct_estimates_close(spark):
    df = spark.range(0, 20000).withColumn("m", F.col("id") % 100)
    got = {r.column_name: r.approx_distinct for r in quality.distinct_estimates(df).collect()}
    assert abs(got["id"] - 20000) / 20000 < 0.08
    assert abs(got["m"] - 100) <= 5


def test_describe_matches_builtin_counts(spark):
    df = loans_view(spark, SF001)
    mine = {(r.column_name, r.summary): r for r in quality.describe_long(df, ["loan_amnt", "dti"]).collect()}
    builtin = {r.summary: r for r in df.describe("loan_amnt").collect()}
    assert mine[("loan_amnt", "count")].value == float(builtin["count"].loan_amnt)
    assert abs(mine[("loan_amnt", "mean")].value - float(builtin["mean"].loan_amnt)) < 1e-3
    assert mine[("dti", "max")].text_value == "debt consolidation"


def _wide_frame(spark, n_cols=120):
    base = spark.range(0, 500)
    cols = {}
    for j in range(n_cols):
        if j % 3 == 0:
            cols[f"s{j}"] = F.when(F.col("id") % (j + 2) == 0, F.lit(None)).otherwise(
                F.concat(F.lit("v"), (F.col("id") % (j + 5)).cast("string")))
        elif j % 3 == 1:
            cols[f"d{j}"] = F.when(F.col("id") % (j + 3) == 0, F.lit(float("nan"))).otherwise(
                (F.col("id") % (j + 7)).cast("double"))
        else:
            cols[f"i{j}"] = F.when(F.col("id") % (j + 4) == 0, F.lit(None)).otherwise(F.col("id") % 11)
    return base.withColumns(cols).drop("id")


def test_wide_census_and_profile_span_several_passes(spark):
    df = _wide_frame(spark).persist()
    fields = df.schema.fields
    brute = df.agg(*[F.count_if(F.col(f.name).isNull() | (F.isnan(f.name) if f.name.startswith("d") else F.lit(False)))
                     .alias(f.name) for f in fields]).first().asDict()
    census = {r.column_name: (r.position, r.n_missing) for r in quality.missing_census(df).collect()}
    assert census == {f.name: (i, brute[f.name]) for i, f in enumerate(fields)}
    prof = {r.column_name: r for r in quality.profile(df).collect()}
    assert len(prof) == len(fields)
    for f in fields:
        assert prof[f.name].n == 500 and prof[f.name].n_missing == brute[f.name]
    d = df.where(~F.isnan("d1")).agg(F.min("d1"), F.max("d1")).first()
    assert (prof["d1"].min_value, prof["d1"].max_value) == (d[0], d[1])
    desc = quality.describe_long(df)
    assert desc.count() == 5 * len(fields)
    df.unpersist()


def test_odd_column_names_and_empty_selection(spark):
    df = spark.createDataFrame([("a", 1.0), (None, float("nan")), ("", 2.0)], "a string, b double") \
        .toDF("we`ird' na\\me", "x y")
    got = {r.column_name: r.n_missing for r in quality.missing_census(df).collect()}
    assert got == {df.columns[0]: 2, "x y": 1}
    assert {r.column_name for r in quality.describe_long(df).collect()} == set(df.columns)
    assert quality.missing_census(df, []).count() == 0
    assert quality.distinct_estimates(df, []).count() == 0


def test_persist_for_fit_runs_nothing_and_ignores_the_partitions(spark):
    from lendscope.operators.features import FIT_PARTITIONS, persist_for_fit
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("persist-test", "")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.range(1000, numPartitions=3).join(spark.range(1000).withColumnRenamed("id", "k"), F.col("id") == F.col("k"))
        one = persist_for_fit(joined.drop("k"))
        assert list(tracker.getJobIdsForGroup("persist-test")) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sparkContext._jsc.clearJobGroup()
    many = persist_for_fit(spark.range(0, 1000, numPartitions=16))
    layout = [df.select("id", F.spark_partition_id().alias("p")).collect() for df in (one, many)]
    assert layout[0] == layout[1] and len({r.p for r in layout[0]}) == FIT_PARTITIONS
    one.unpersist()
    many.unpersist()


def test_column_quartiles_brute_force(spark):
    import math
    rows = [(i, float(i % 37) if i % 5 else float("nan"), None, "t", i % 7 if i % 3 else None)
            for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b double, c double, s string, d int")
    got = {r.column_name: r for r in quality.column_quartiles(df).collect()}
    assert set(got) == {"a", "b", "c", "d"} and got["d"].position == 4

    def brute(vals, p):
        return float(np.quantile(vals, p))
    for j, name in [(0, "a"), (1, "b"), (4, "d")]:
        vals = [r[j] for r in rows if r[j] is not None and not (isinstance(r[j], float) and math.isnan(r[j]))]
        assert got[name].n == len(vals)
        assert (got[name].q1, got[name].median, got[name].q3) == tuple(brute(vals, p) for p in (0.25, 0.5, 0.75))
    assert got["c"].n == 0 and got["c"].median is None


def test_many_column_passes_compute_the_frame_once(spark):
    from lendscope.plans import catalog
    catalog.load_all()
    plan = catalog.QUERIES["describe_long"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan  # orders and customer are joined once, into the layer the passes read


def test_distinct_estimates_are_close_to_exact(spark):
    df = loans_view(spark, SF001)
    got = {r.column_name: r.approx_distinct for r in quality.distinct_estimates(df).collect()}
    exact = df.agg(*[F.countDistinct(c).alias(c) for c in df.columns]).first().asDict()
    for name, n in exact.items():
        assert abs(got[name] - n) <= max(1, 0.06 * n)


def test_sparsity_within_without_rows(spark):
    r = quality.sparsity_within(loans_view(spark, SF001), F.lit(False), "settlement_status", "loan_status").first()
    assert (r.n_rows, r.n_missing, r.filled_share) == (0, 0, None)


def test_crosstab_loses_no_row(spark):
    from lendscope.operators import explore
    df = spark.createDataFrame([("s1", "A"), ("s1", None), ("s2", "H"), ("s2", "B"), (None, "A")], "s string, g string")
    found = {r["s_g"]: r.asDict() for r in explore.crosstab(df, "s", "g").collect()}
    assert found["s1"] == {"s_g": "s1", "A": 1, "B": 0, "H": 0, "null": 1}
    listed = [r.asDict() for r in explore.crosstab(df, "s", "g", values=["A", "B"]).collect()]
    assert {r["s_g"]: r["other"] for r in listed} == {"s1": 0, "s2": 1, "null": 0}
    assert sum(v for r in listed for k, v in r.items() if k != "s_g") == df.count()
