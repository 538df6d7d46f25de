"""Custom category order: a rank column instead of a driver-side categorical type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordinal(c: str | Column, order: Sequence[str]) -> Column:
    """1-based position of the value in ``order``; NULL for values not in it (and NULL).

    Sorting by this column gives the order of the list (e.g. grades A1 < A2 < ... < G5
    as a plot axis wants them) without collecting anything; the list is a literal
    array inside the expression.
    """
    col = F.col(c) if isinstance(c, str) else c
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), col)
    return F.when(pos > 0, pos.cast("int"))
