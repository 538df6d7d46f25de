"""Text scrub: what ``' '.join(line.split())`` + an ASCII/ignore writer does, per line.

Each line of the value (lines end at ``\\n``, ``\\r\\n`` or ``\\r``) has its runs of
the blanks Python knows collapsed to one space and trimmed, and then every non-ASCII
character is dropped (in that order, so ``a <emoji> b`` becomes ``a``, two blanks,
``b``). Lines stay separate, joined by ``\\n``.

The whole text is processed at once, without splitting it into an array of
lines: line breaks are normalised and line ends trimmed by literal replacement,
blanks are mapped to spaces by ``translate`` (a per-character table lookup), and
only the rare runs of two or more spaces and the non-ASCII characters go
through a regular expression. Everything is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendscope.constants import NON_ASCII_CLASS, PY_BLANK_CHARS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _spaces(text: Column) -> Column:
    """Every blank a space, runs of spaces one space."""
    spaced = F.translate(text, PY_BLANK_CHARS, " " * len(PY_BLANK_CHARS))
    return F.regexp_replace(spaced, " {2,}", " ")


def scrub_line(line: str | Column) -> Column:
    """One line (no line breaks inside): collapse blanks, trim, drop non-ASCII."""
    return F.regexp_replace(F.trim(_spaces(_col(line))), NON_ASCII_CLASS, "")


def scrub_ascii(c: str | Column) -> Column:
    """Every line of a multi-line text scrubbed as :func:`scrub_line` does."""
    nl = F.lit("\n")
    lines = F.replace(F.replace(_col(c), F.lit("\r\n"), nl), F.lit("\r"), nl)
    collapsed = _spaces(lines)
    # After the collapse a line has at most one space at each end.
    trimmed = F.trim(F.replace(F.replace(collapsed, F.lit(" \n"), nl), F.lit("\n "), nl))
    return F.regexp_replace(trimmed, NON_ASCII_CLASS, "")
