"""Column expressions that turn loan text into numbers and labels.

All casts are ``try_cast``-style so they behave the same with ANSI mode on (the
Spark 4 default): a value that does not parse becomes NULL instead of failing
the job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lendscope.constants import (
    DEFAULT_STATUSES,
    EMP_LENGTH_STRIP,
    TERM_DIGITS,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def issue_year(c: str | Column = "issue_d") -> Column:
    """Year out of ``MMM-yyyy`` text (``Dec-2015`` -> 2015); NULL if it does not parse."""
    return F.get(F.split(_col(c), "-"), 1).try_cast("int")


def issue_date(c: str | Column = "issue_d") -> Column:
    """First day of the issue month as a DATE, NULL if it does not parse."""
    return F.try_to_date(_col(c), "MMM-yyyy")


def emp_length_years(c: str | Column = "emp_length", under_one: int | None = None) -> Column:
    """``10+ years`` -> 10, ``< 1 year`` -> 1 (or ``under_one``), ``n/a`` -> NULL."""
    text = _col(c)
    years = F.trim(F.regexp_replace(text, EMP_LENGTH_STRIP, "")).try_cast("int")
    if under_one is None:
        return years
    return F.when(F.trim(text).startswith("<"), F.lit(under_one)).otherwise(years)


def term_months(c: str | Column = "term") -> Column:
    """First digit run of the term (`` 36 months`` -> 36); NULL when there is none."""
    return F.regexp_extract(_col(c), TERM_DIGITS, 0).try_cast("int")


def to_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def default_flag(c: str | Column = "loan_status",
                 bad_statuses: Iterable[str] = DEFAULT_STATUSES) -> Column:
    """1 for a defaulted status, else 0 (a NULL status is 0)."""
    return F.when(_col(c).isin(*bad_statuses), F.lit(1)).otherwise(F.lit(0))


def cast_columns(df, names: Iterable[str], new_type: str | DataType):
    """Bulk cast in one projection (``try_cast``; unknown names are an error)."""
    return df.withColumns({name: F.col(name).try_cast(new_type) for name in names})


# Text that can be a double: decimal / exponent forms, NaN and infinities (any case).
NUMBER_TEXT = r"^\s*[-+]?((\d+\.?\d*|\.\d+)([eE][-+]?\d+)?|(?i:nan|inf|infinity))\s*$"


def parse_double(c: str | Column) -> Column:
    """``try_cast(double)`` behind a cheap shape test.

    For columns that are mostly words (e.g. profiling every text column) a failed
    cast costs far more than a regex test, so only number-shaped text is cast.
    """
    col = _col(c)
    return F.when(col.rlike(NUMBER_TEXT), col.try_cast("double"))
