"""Type-aware tests for a missing value.

A value counts as missing when it is SQL NULL; for float/double also NaN; for
text also the empty string or a value containing the words ``None`` / ``NULL``.
Applying each test only to the types it makes sense for keeps the expressions
valid under ANSI mode (``isnan`` on text and ``== ''`` on numbers both fail there).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType


def is_missing(name: str, dtype: DataType) -> Column:
    c = F.col(name)
    cond = c.isNull()
    if isinstance(dtype, (DoubleType, FloatType)):
        cond = cond | F.isnan(c)
    elif isinstance(dtype, StringType):
        cond = cond | (c == "") | c.contains("None") | c.contains("NULL")
    return cond


def is_numeric_type(dtype: DataType) -> bool:
    return dtype.typeName() in {"byte", "short", "integer", "long", "float", "double"} or \
        dtype.typeName().startswith("decimal")
