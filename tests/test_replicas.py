"""Replicated columns and exact distinct counts against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lendscope.operators import quality, replicas
from lendscope.sources.fixtures import loans_view
from tests.conftest import SF001


def rows_of(found):
    return {r.column_name: (r.kind, r.of_column, r.n_distinct) for r in found.collect()}


def test_copies_and_recodings(spark):
    rng = random.Random(0)
    rows = []
    for i in range(400):
        a, b = rng.choice(["x", "y", "z", None]), rng.choice([0.0, -0.0, float("nan"), 1.5])
        code = {"x": 3, "y": 1, "z": 2, None: 9}[a]
        rows.append((i, a, a, code, f"n{code}", b, b, a if i else "q", "same", None, f"u{i * 7}"))
    df = spark.createDataFrame(rows, "id long, a string, a2 string, code int, code_text string, b double, b2 double, nearly string, "
                                     "fixed string, empty string, url string").repartition(5)
    assert rows_of(replicas.replicated_columns(df)) == {
        "a2": ("copy", "a", 4), "code": ("recoding", "a", 4), "code_text": ("recoding", "a", 4), "b2": ("copy", "b", 3), "url": ("recoding", "id", 400)}


def test_a_copy_of_a_recoding_names_the_column_it_copies(spark):
    df = spark.createDataFrame([(i, i % 3, f"g{i % 3}", f"g{i % 3}", bytes([i % 3])) for i in range(30)], "id long, a int, b string, c string, d binary")
    assert rows_of(replicas.replicated_columns(df)) == {"b": ("recoding", "a", 3), "c": ("copy", "b", 3), "d": ("recoding", "a", 3)}


def test_repeated_keys_are_confirmed_cell_by_cell(spark):
    """With a repeated key the fingerprints of two swapped cells cancel; the confirmation decides."""
    df = spark.createDataFrame([(1, "p", "q"), (1, "q", "p"), (2, "p", "p"), (3, "q", "q"), (4, "q", "q")], "id long, a string, b string")
    assert rows_of(replicas.replicated_columns(df)) == {}
    swapped = spark.createDataFrame([(1, "p", "q"), (1, "q", "p"), (1, "q", "p")], "id long, a string, b string")
    assert rows_of(replicas.replicated_columns(swapped)) == {"b": ("recoding", "a", 2)}


def test_long_values_names_and_empty_tables(spark):
    df = spark.createDataFrame([(i, "t" * 200 + str(i % 2), i % 2) for i in range(6)], ["id", "a `b`.c", "d"])
    assert rows_of(replicas.replicated_columns(df)) == {"d": ("recoding", "a `b`.c", 2)}
    assert replicas.replicated_columns(df.where(F.lit(False))).collect() == []
    assert replicas.replicated_columns(df, cols=[]).collect() == []


@pytest.mark.parametrize("parts", [1, 7])
def test_distinct_counts_are_exact(spark, parts):
    df = loans_view(spark, SF001).repartition(parts)
    got = {r.column_name: r.n_distinct for r in replicas.distinct_counts(df).collect()}
    want = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    assert got == want


def test_distinct_counts_of_odd_values(spark):
    values = [(None, None, None), (0.0, "", b""), (-0.0, "#" * 65, b"a"), (math.nan, "#" * 66, b"a"), (math.nan, " ", None)]
    df = spark.createDataFrame(values, "x double, t string, b binary")
    assert [tuple(r) for r in replicas.distinct_counts(df).orderBy("position").collect()] == [(0, "x", 2), (1, "t", 4), (2, "b", 2)]
    assert [r.n_distinct for r in replicas.distinct_counts(df.where(F.lit(False))).collect()] == [0, 0, 0]


def test_the_report_has_the_exact_counts(spark):
    df = loans_view(spark, SF001).select("id", "grade", "annual_inc", "member_id")
    got = {r.column_name: r.n_distinct for r in quality.profile_report(df).collect()}
    assert got == df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
