"""Unit rows from FIXTURES.md section 2 (ANSI mode on)."""

import math

from pyspark.sql import functions as F

from lendscope.functions import (
    default_flag, emp_length_years, is_missing, issue_year, scrub_ascii, term_months,
)
from lendscope.functions.parse import parse_double
from lendscope.operators.quality import keep_matching, missing_census, quarantine


def _vals(df, col):
    return [r[col] for r in df.orderBy("i").collect()]


def test_emp_length(spark):
    df = spark.createDataFrame([(0, "10+ years"), (1, "< 1 year"), (2, "1 year"), (3, "n/a"), (4, None)],
                               "i int, emp_length string")
    out = df.select("i", emp_length_years("emp_length").alias("y"))
    assert _vals(out, "y") == [10, 1, 1, None, None]
    out0 = df.select("i", emp_length_years("emp_length", under_one=0).alias("y"))
    assert _vals(out0, "y") == [10, 0, 1, None, None]


def test_term(spark):
    df = spark.createDataFrame([(0, " 36 months"), (1, " 60 months"), (2, ""), (3, None)], "i int, term string")
    assert _vals(df.select("i", term_months("term").alias("t")), "t") == [36, 60, None, None]


def test_issue_year(spark):
    df = spark.createDataFrame([(0, "Dec-2015"), (1, "bad"), (2, None)], "i int, issue_d string")
    assert _vals(df.select("i", issue_year("issue_d").alias("y")), "y") == [2015, None, None]


def test_row_rules_three_valued(spark):
    df = spark.createDataFrame(
        [(0, "12.5", "0", "CA"), (1, "7", "1", ""), (2, "x", "0", "CA"), (3, None, "0", "CA"),
         (4, "3", "0", "text"), (5, "3", "0", None)],
        "i int, dti string, delinq_2yrs string, addr_state string")
    kept = sorted(r.i for r in keep_matching(df).collect())
    assert kept == [0, 1]
    rej = {r.i: r.reject_reason for r in quarantine(df).collect()}
    assert rej == {2: "dti:pattern", 3: "dti:null", 4: "addr_state:pattern", 5: "addr_state:null"}
    # the SQL NOT REGEXP view leaves NULL rows out of both sets
    neg = sorted(r.i for r in keep_matching(df, [("dti", "[0-9]+")], negate=True).collect())
    assert neg == [2]


def test_missing_census_types(spark):
    df = spark.createDataFrame([(1.0, "abc"), (None, ""), (float("nan"), "NULL"), (2.0, "None"), (3.0, None)],
                               "x double, t string")
    got = {r.column_name: r.n_missing for r in missing_census(df).collect()}
    assert got == {"x": 2, "t": 4}
    assert df.where(is_missing("t", df.schema["t"].dataType)).count() == 4
    filled = [r.x for r in df.na.fill(0).collect()]
    assert filled == [1.0, 0.0, 0.0, 2.0, 3.0]


def test_default_flag(spark):
    statuses = ["Default", "Charged Off", "Late (31-120 days)", "Late (16-30 days)",
                "Does not meet the credit policy. Status:Charged Off", "In Grace Period",
                "Fully Paid", "Does not meet the credit policy. Status:Fully Paid", "Current", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(statuses)], "i int, s string")
    assert _vals(df.select("i", default_flag("s").alias("t")), "t") == [1] * 6 + [0] * 4


def test_scrub_ascii(spark):
    text = "a \U0001F600 b\tc  d\n  café  \r\nx y"
    df = spark.createDataFrame([(0, text), (1, ""), (2, None)], "i int, t string")
    got = _vals(df.select("i", scrub_ascii("t").alias("c")), "c")
    expected = "\n".join(" ".join(line.split()).encode("ascii", "ignore").decode()
                         for line in text.replace("\r\n", "\n").split("\n"))
    assert got[0] == expected == "a  b c d\ncaf\nx y"
    assert got[1] == "" and got[2] is None


def test_parse_double_matches_try_cast_on_numbers(spark):
    vals = ["1", " 2.5 ", "-3e2", ".5", "NaN", "inf", "abc", "", None, "12 months"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = _vals(df.select("i", parse_double("v").alias("d")), "d")
    assert got[:4] == [1.0, 2.5, -300.0, 0.5]
    assert math.isnan(got[4]) and got[5] == float("inf")
    assert got[6:] == [None, None, None, None]


def test_ordinal_custom_order(spark):
    from lendscope.constants import SUB_GRADES
    from lendscope.functions.order import ordinal
    df = spark.createDataFrame([("B2",), ("A1",), ("G5",), ("Z9",), (None,)], "g string")
    got = {r.g: r.rank for r in df.select("g", ordinal("g", SUB_GRADES).alias("rank")).collect()}
    assert got == {"B2": 7, "A1": 1, "G5": 35, "Z9": None, None: None}
    assert len(SUB_GRADES) == 35 and SUB_GRADES[:6] == ("A1", "A2", "A3", "A4", "A5", "B1")


def test_rename_positional_and_preview(spark):
    import pytest
    from lendscope.operators.columns import rename_positional
    from lendscope.operators.rows import preview
    df = spark.createDataFrame([(2016, 3.0), (2015, 1.0), (2017, 2.0)], "y int, v double")
    assert rename_positional(df, ["Year", "Median"]).columns == ["Year", "Median"]
    with pytest.raises(ValueError):
        rename_positional(df, ["Year"])
    assert [r.y for r in preview(df, 2, ["y"]).collect()] == [2015, 2016]


def test_issue_date(spark):
    import datetime

    from lendscope.functions import issue_date
    df = spark.createDataFrame([(0, "Dec-2015"), (1, "bad"), (2, None)], "i int, issue_d string")
    assert _vals(df.select("i", issue_date("issue_d").alias("d")), "d") == [
        datetime.date(2015, 12, 1), None, None]


def test_small_helpers(spark):
    from lendscope.functions import to_double
    from lendscope.operators.columns import feature_columns, schema_table
    from lendscope.operators.quality import missing_census_wide
    from lendscope.sources.loans_csv import register_view

    df = spark.createDataFrame([(0, "1.5", None, "Fully Paid", 1, "x"), (1, "n/a", 2.0, "Current", 0, "")],
                               "i int, s string, b double, st string, target int, t string")
    out = df.select("i", to_double("s").alias("d")).orderBy("i").collect()
    assert [r.d for r in out] == [1.5, None]
    assert feature_columns(df, "target", ids=["i"]) == ["b"]
    assert [tuple(r) for r in schema_table(spark, df).collect()][:2] == [(0, "i", "int", True), (1, "s", "string", True)]
    wide = missing_census_wide(df).first().asDict()
    assert wide == {"i": 0, "s": 0, "b": 1, "st": 0, "target": 0, "t": 1}
    register_view(df, "loans_helper_view")
    assert spark.sql("SELECT count(*) AS n FROM loans_helper_view WHERE target = 1").first().n == 1


def test_blank_set_is_pythons():
    from lendscope.constants import PY_BLANK_CHARS
    expected = "".join(chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in "\n\r")
    assert PY_BLANK_CHARS == expected


def test_scrub_matches_python_on_random_text(spark):
    """Brute force: Python's own per-line split/join and ASCII/ignore encode on random texts."""
    import random

    rnd = random.Random(11)
    alphabet = ["a", "b", "é", "\U0001F600", " ", "  ", "\t", "\n", "\r", "\r\n", "\x0b", "\x1c",
                "\x85", "\xa0", " ", "　", "z", "."]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = _vals(df.select("i", scrub_ascii("t").alias("c")), "c")
    for text, out in zip(texts, got):
        lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        assert out == "\n".join(" ".join(l.split()).encode("ascii", "ignore").decode() for l in lines)
