"""Column expressions (JVM-side built-ins only; no Python UDF)."""

from lendscope.functions.missing import is_missing, is_numeric_type
from lendscope.functions.parse import (
    cast_columns,
    default_flag,
    emp_length_years,
    issue_date,
    issue_year,
    term_months,
    to_double,
)
from lendscope.functions.order import ordinal
from lendscope.functions.text import scrub_ascii, scrub_line

__all__ = [
    "cast_columns", "default_flag", "emp_length_years", "is_missing",
    "is_numeric_type", "issue_date", "issue_year", "ordinal", "scrub_ascii", "scrub_line", "term_months",
    "to_double",
]
