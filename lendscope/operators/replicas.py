"""Columns that repeat each other: copies, one-to-one recodings; exact distinct counts.

Every row is unpivoted to one (column, value) pair per column and the pairs are grouped by column and
value, partially inside each task, so a hot value crosses the network once per task. A group carries
its number of rows and order-free fingerprints (exclusive ors of 64-bit hashes of the row's key).
The set of a column's group fingerprints tells how it splits the rows, whatever its values are
called: two columns with the same split are recodings of each other. A fingerprint of the cells
tells copies apart. What the fingerprints find is then confirmed cell by cell.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DateType, DoubleType, FloatType, StringType, StructField, TimestampNTZType, TimestampType,
)

from lendscope.functions.missing import is_numeric_type
from lendscope.operators.quality import sql_name, sql_text
from lendscope.session import materialize

#: Longer values are grouped by their SHA-256, so that no shuffle carries long texts.
_LONG_VALUE = 64


def _comparable(f: StructField) -> bool:
    return is_numeric_type(f.dataType) or isinstance(
        f.dataType, (StringType, BooleanType, DateType, TimestampType, TimestampNTZType, BinaryType))


def _value_text(f: StructField) -> str:
    """A column's value as text: equal values, and only they, have equal texts."""
    c = sql_name(f.name)
    if isinstance(f.dataType, (DoubleType, FloatType)):
        return f"CAST({c} + CAST(0 AS {f.dataType.simpleString()}) AS STRING)"  # one zero
    if isinstance(f.dataType, BinaryType):
        return f"hex({c})"
    if isinstance(f.dataType, StringType):
        return f"IF(octet_length({c}) > {_LONG_VALUE}, concat('#', sha2({c}, 256)), {c})"
    return f"CAST({c} AS STRING)"


def _fields(df: DataFrame, cols: Iterable[str] | None) -> list[tuple[int, StructField]]:
    wanted = None if cols is None else set(cols)
    return [(i, f) for i, f in enumerate(df.schema.fields) if (wanted is None or f.name in wanted) and _comparable(f)]


def _pairs(fields, more: str = "") -> str:
    return "inline(array(" + ", ".join(
        f"named_struct('position', {i}, 'value', {_value_text(f)}{more})" for i, f in fields) + "))"


def distinct_counts(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Exact number of distinct values of every column, NULL left out: (position, column_name,
    n_distinct). NaN is one value, and so are the two zeros.

    One shuffle of at most a row per distinct value and task, spread over all columns and values;
    for estimates without it see :func:`~lendscope.operators.quality.distinct_estimates`.
    """
    fields = _fields(df, cols)
    if not fields:
        return df.sparkSession.createDataFrame([], "position int, column_name string, n_distinct bigint")
    values = df.selectExpr(_pairs(fields)).where("value IS NOT NULL").groupBy("position", "value").agg(F.lit(1).alias("one"))
    counts = values.groupBy("position").agg(F.count("*").alias("n_distinct"))
    rows = ", ".join(f"named_struct('position', {i}, 'column_name', {sql_text(f.name)})" for i, f in fields)
    names = df.sparkSession.range(1).selectExpr(f"inline(array({rows}))")
    return (names.join(counts, "position", "left")
            .select("position", "column_name", F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct")))


def _signs(layer: DataFrame, keys: Sequence[str], fields) -> dict[int, tuple]:
    """For each column (distinct values with NULL as one, split fingerprint, cell fingerprint): one
    row per column on the driver."""
    key = ", ".join(sql_name(k) for k in keys)
    rows = layer.selectExpr(f"xxhash64({key}) AS r1", f"xxhash64('again', {key}) AS r2", _pairs(fields))
    groups = rows.groupBy("position", "value").agg(
        F.count("*").alias("n"), F.bit_xor("r1").alias("f1"), F.bit_xor("r2").alias("f2"),
        F.bit_xor(F.xxhash64("r1", "value")).alias("c1"), F.bit_xor(F.xxhash64("r2", "value")).alias("c2"))
    found = groups.groupBy("position").agg(
        F.count("*").alias("n_distinct"), F.bit_xor(F.xxhash64("n", "f1", "f2")).alias("p1"), F.bit_xor(F.xxhash64("f2", "n", "f1")).alias("p2"),
        F.bit_xor("c1").alias("c1"), F.bit_xor("c2").alias("c2"))
    return {r["position"]: (r["n_distinct"], (r["p1"], r["p2"]), (r["c1"], r["c2"])) for r in found.collect()}


def replicated_columns(df: DataFrame, keys: Sequence[str] = ("id",), cols: Iterable[str] | None = None) -> DataFrame:
    """Columns that replicate an earlier one: (position, column_name, of_position, of_column, kind,
    n_distinct), one row each.

    ``copy``: equal in every row (NULLs too) and of the same type as the first such column before
    it. ``recoding``: not a copy, but its values stand for those of the first column of its kind one
    to one, NULL counting as a value. Columns of one value only say nothing and are left to
    :func:`~lendscope.operators.columns.redundant_columns`. ``keys`` tell the rows apart; where they
    do not, a fingerprint may suggest too much, never too little, and the confirmation decides.
    A unique column is a recoding of any other unique column.
    """
    schema = "position int, column_name string, of_position int, of_column string, kind string, n_distinct bigint"
    spark, fields = df.sparkSession, _fields(df, cols)
    if not fields:
        return spark.createDataFrame([], schema)
    names = dict.fromkeys([*keys, *[f.name for _, f in fields]])
    layer = materialize(df.select(*[F.col(sql_name(c)) for c in names]), "replicas")
    signs, by_position = _signs(layer, keys, fields), dict(fields)
    copies, recodings, same_split, same_cells = [], [], {}, {}
    for i, (n, split, cells) in sorted(signs.items()):
        if n < 2:
            continue
        same_split.setdefault(split, []).append(i)
        same_cells.setdefault((cells, by_position[i].dataType.simpleString()), []).append(i)
    for group in same_cells.values():
        copies += [(i, group[0]) for i in group[1:]]
    copied = {i for i, _ in copies}
    for group in same_split.values():
        recodings += [(i, group[0]) for i in group[1:] if i not in copied]
    confirmed = _equal_cells(layer, copies, by_position)
    recodings += [(i, first) for group in same_split.values() for i, first in ((i, group[0]) for i in group[1:])
                  if i in copied and (i, dict(copies)[i]) not in confirmed]
    one_to_one = _matched_values(layer, recodings, by_position, {i: s[0] for i, s in signs.items()})
    rows = [(i, by_position[i].name, of, by_position[of].name, kind, signs[i][0])
            for kind, found in (("copy", confirmed), ("recoding", one_to_one)) for i, of in found]
    return spark.createDataFrame(sorted(rows), schema)


def _equal_cells(layer: DataFrame, pairs, by_position) -> list[tuple[int, int]]:
    """The pairs of columns that differ in no row; one pass over all pairs."""
    if not pairs:
        return []
    differ = layer.selectExpr(*[f"count_if(NOT ({sql_name(by_position[i].name)} <=> {sql_name(by_position[j].name)})) AS d{k}"
                                for k, (i, j) in enumerate(pairs)]).first()
    return [pair for k, pair in enumerate(pairs) if differ[f"d{k}"] == 0]


def _matched_values(layer: DataFrame, pairs, by_position, n_distinct) -> list[tuple[int, int]]:
    """The pairs of columns whose values match one to one: as many distinct pairs of values as
    distinct values on either side, NULL being one."""
    if not pairs:
        return []
    both = ", ".join(f"named_struct('k', {k}, 'a', {_value_text(by_position[i])}, 'b', {_value_text(by_position[j])})"
                     for k, (i, j) in enumerate(pairs))
    met = layer.selectExpr(f"inline(array({both}))").groupBy("k", "a", "b").agg(F.lit(1).alias("one"))
    counts = {r["k"]: r["count"] for r in met.groupBy("k").count().collect()}
    return [(i, j) for k, (i, j) in enumerate(pairs) if counts[k] == n_distinct[i] == n_distinct[j]]
