"""Row and column quality: regex row rules, quarantine, missing-value census, profiles.

Column-wise statistics are global aggregates over groups of columns (map-side
partial aggregation, one row per task in the shuffle), turned into tidy rows
with a generator over each single result row. Nothing row-level goes to the
driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType, StructField

from lendscope.constants import MAX_MISSING_SHARE, ROW_RULES
from lendscope.functions.missing import is_numeric_type
from lendscope.functions.parse import NUMBER_TEXT
from lendscope.operators import quantiles
from lendscope.session import materialize

# --------------------------------------------------------------------------- row rules


def rule_holds(col: str, pattern: str) -> Column:
    """TRUE / FALSE / NULL (three-valued, as SQL REGEXP is)."""
    return F.col(col).rlike(pattern)


def keep_matching(df: DataFrame, rules: Sequence[tuple[str, str]] = ROW_RULES,
                  negate: bool = False) -> DataFrame:
    """Keep rows where every rule matches (a NULL field fails, as ``filter(rlike)`` does).

    With ``negate=True`` keep the rows whose fields do *not* match (the SQL
    ``NOT REGEXP`` view: NULL rows are in neither set).
    All rules form one conjunction, so Spark evaluates them in one Filter.
    """
    conds = [rule_holds(c, p) for c, p in rules]
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    if negate:
        neg = [~c for c in conds]
        cond = neg[0]
        for c in neg[1:]:
            cond = cond | c
    return df.where(cond)


def reject_reason(rules: Sequence[tuple[str, str]] = ROW_RULES) -> Column:
    """First failing rule as ``<col>:null`` or ``<col>:pattern``; NULL when all hold."""
    reason = F.lit(None).cast("string")
    for col, pattern in reversed(list(rules)):
        reason = (F.when(F.col(col).isNull(), F.lit(f"{col}:null"))
                  .when(~rule_holds(col, pattern), F.lit(f"{col}:pattern"))
                  .otherwise(reason))
    return reason


def quarantine(df: DataFrame, rules: Sequence[tuple[str, str]] = ROW_RULES,
               reason_col: str = "reject_reason") -> DataFrame:
    """Rows failing any rule, with the first failing rule; NULL fields are reported too.

    ``keep_matching(df) ∪ quarantine(df)`` is exactly ``df`` (disjoint).
    """
    return df.withColumn(reason_col, reject_reason(rules)).where(F.col(reason_col).isNotNull())


def split_valid(df: DataFrame, rules: Sequence[tuple[str, str]] = ROW_RULES,
                reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    tagged = df.withColumn(reason_col, reject_reason(rules))
    return (tagged.where(F.col(reason_col).isNull()).drop(reason_col),
            tagged.where(F.col(reason_col).isNotNull()))


# --------------------------------------------------------------------------- census / profile
#
# Column-wise statistics are built as Spark SQL expression text (a few calls into
# the JVM per pass, however many columns) and evaluated as global aggregates,
# one pass per group of columns. A group is kept under ``MAX_BUFFER_FIELDS``
# aggregation-buffer fields, so the heavy per-row stage stays in whole-stage
# code generation: one aggregate over all 149 columns of a raw loan file
# fails to compile and runs interpreted, several times slower per row. When
# there is more than one pass, the frame is written once as a Parquet layer of the
# needed columns, so its scan, joins and parsing run once; each pass then reads
# only its own columns, together one copy of the layer.

MAX_BUFFER_FIELDS = 96


def sql_name(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A Python string as a Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_is_missing(name: str, dtype: DataType) -> str:
    """SQL form of :func:`lendscope.functions.missing.is_missing`."""
    c = sql_name(name)
    if isinstance(dtype, (DoubleType, FloatType)):
        return f"({c} IS NULL OR isnan({c}))"
    if isinstance(dtype, StringType):
        return f"({c} IS NULL OR {c} = '' OR contains({c}, 'None') OR contains({c}, 'NULL'))"
    return f"({c} IS NULL)"


def _columns(df: DataFrame, cols: Iterable[str] | None):
    fields = {f.name: f for f in df.schema.fields}
    names = list(cols) if cols is not None else [f.name for f in df.schema.fields]
    return [(i, fields[n]) for i, n in enumerate(names)]


def _groups(fields, width: Callable[[StructField], int], budget: int):
    group, used = [], 0
    for i, f in fields:
        w = width(f)
        if group and used + w > budget:
            yield group
            group, used = [], 0
        group.append((i, f))
        used += w
    if group:
        yield group


def per_column_rows(df: DataFrame, fields, *, inputs, aggs, rows, width, schema: str,
                    budget: int = MAX_BUFFER_FIELDS) -> DataFrame:
    """Tidy rows of per-column statistics, one global aggregate per group of columns.

    For each ``(position, field)``: ``inputs`` gives the SQL projections computed
    once per row (``expr AS name``), ``aggs`` the aggregate expressions over them,
    ``rows`` the ``named_struct`` output rows over the aggregates, and ``width``
    the aggregation-buffer fields the column needs. The result of each pass is a
    single row before it is unpacked, so only one row per task crosses the shuffle.
    """
    parts, groups = [], list(_groups(fields, width, budget))
    if len(groups) > 1:  # the frame is computed once; the passes read disjoint columns of the layer
        df = materialize(df.select(*[F.col(sql_name(f.name)) for _, f in fields]), "columns")
    for group in groups:
        projected = df.selectExpr(*[e for i, f in group for e in inputs(i, f)])
        one_row = projected.selectExpr(*[a for i, f in group for a in aggs(i, f)])
        structs = ", ".join(r for i, f in group for r in rows(i, f))
        parts.append(one_row.selectExpr(f"inline(array({structs}))"))
    if not parts:
        return df.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def missing_census(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Missing values per column (type-aware): (position, column_name, n_missing)."""
    return per_column_rows(
        df, _columns(df, cols),
        inputs=lambda i, f: [f"{sql_is_missing(f.name, f.dataType)} AS m{i}"],
        aggs=lambda i, f: [f"count_if(m{i}) AS m{i}"],
        rows=lambda i, f: [f"named_struct('position', {i}, 'column_name', {sql_text(f.name)}, "
                           f"'n_missing', m{i})"],
        width=lambda f: 1,
        schema="position int, column_name string, n_missing bigint")


def missing_census_wide(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """The notebook's form: one row, one count per column, named like the column."""
    fields = _columns(df, cols)
    return df.selectExpr(*[f"count_if({sql_is_missing(f.name, f.dataType)}) AS {sql_name(f.name)}"
                           for _, f in fields])


def _as_double(f: StructField) -> str:
    c = sql_name(f.name)
    return f"CAST({c} AS DOUBLE)" if is_numeric_type(f.dataType) else f"try_cast({c} AS DOUBLE)"


def profile(df: DataFrame, cols: Iterable[str] | None = None, digits: int = 6) -> DataFrame:
    """Per-column profile.

    Columns: position, column_name, data_type, n, n_missing, p_missing, n_zeros,
    min_value, max_value, mean, stddev (numeric statistics are NULL for text;
    NaN is left out of them).
    """
    def inputs(i, f):
        out = [f"{sql_is_missing(f.name, f.dataType)} AS m{i}"]
        if is_numeric_type(f.dataType):
            x = _as_double(f)
            out.append(f"CASE WHEN NOT isnan({x}) THEN {x} END AS x{i}")
        return out

    def aggs(i, f):
        out = [f"count(1) AS n{i}", f"count_if(m{i}) AS m{i}"]
        if is_numeric_type(f.dataType):
            out += [f"count_if(x{i} = 0) AS z{i}", f"min(x{i}) AS lo{i}", f"max(x{i}) AS hi{i}",
                    f"avg(x{i}) AS mu{i}", f"stddev_samp(x{i}) AS sd{i}"]
        return out

    def rows(i, f):
        if is_numeric_type(f.dataType):
            num = (f"z{i}, 'min_value', lo{i}, 'max_value', hi{i}, 'mean', round(mu{i}, {digits}), "
                   f"'stddev', round(sd{i}, {digits})")
        else:
            num = ("CAST(NULL AS BIGINT), 'min_value', CAST(NULL AS DOUBLE), 'max_value', "
                   "CAST(NULL AS DOUBLE), 'mean', CAST(NULL AS DOUBLE), 'stddev', CAST(NULL AS DOUBLE)")
        return [f"named_struct('position', {i}, 'column_name', {sql_text(f.name)}, "
                f"'data_type', {sql_text(f.dataType.simpleString())}, 'n', n{i}, 'n_missing', m{i}, "
                f"'p_missing', round(try_divide(m{i}, n{i}), {digits}), 'n_zeros', {num})"]

    return per_column_rows(
        df, _columns(df, cols), inputs=inputs, aggs=aggs, rows=rows,
        width=lambda f: 11 if is_numeric_type(f.dataType) else 2,
        schema=("position int, column_name string, data_type string, n bigint, n_missing bigint, "
                "p_missing double, n_zeros bigint, min_value double, max_value double, "
                "mean double, stddev double"))


def profile_report(df: DataFrame, cols: Iterable[str] | None = None, digits: int = 6) -> DataFrame:
    """One report per column: :func:`profile`, exact quartiles and the exact number of distinct values
    together, over one written copy of the columns."""
    from lendscope.operators.replicas import distinct_counts
    names = list(cols) if cols is not None else df.columns
    layer = materialize(df.select(*[F.col(sql_name(c)) for c in names]), "profile")
    quartiles = column_quartiles(layer).select("position", *[F.round(c, digits).alias(c) for c in ("q1", "median", "q3")])
    return (profile(layer, digits=digits).join(quartiles, "position", "left")
            .join(distinct_counts(layer).drop("column_name"), "position", "left"))


def sparse_columns(df: DataFrame, max_missing: float = MAX_MISSING_SHARE,
                   cols: Iterable[str] | None = None, digits: int = 6) -> DataFrame:
    """Columns whose missing share is above ``max_missing`` (default 10%)."""
    shares = per_column_rows(
        df, _columns(df, cols),
        inputs=lambda i, f: [f"{sql_is_missing(f.name, f.dataType)} AS m{i}"],
        aggs=lambda i, f: [f"count(1) AS n{i}", f"count_if(m{i}) AS m{i}"],
        rows=lambda i, f: [f"named_struct('position', {i}, 'column_name', {sql_text(f.name)}, "
                           f"'p_missing', round(try_divide(m{i}, n{i}), {digits}))"],
        width=lambda f: 2,
        schema="position int, column_name string, p_missing double")
    return shares.where(F.col("p_missing") > max_missing)


def describe_long(df: DataFrame, cols: Iterable[str] | None = None, digits: int = 6) -> DataFrame:
    """``describe`` as tidy rows: (column_name, summary, value, text_value).

    count / mean / stddev / min / max per column. Text columns get mean and
    stddev of the values that parse as numbers (as ``describe`` does) and min / max
    as text in ``text_value``; numeric columns carry everything in ``value``.
    A text value is tested and parsed once per row (a cheap shape test first: a
    failed cast costs far more than the regex).
    """
    def inputs(i, f):
        c = sql_name(f.name)
        if isinstance(f.dataType, StringType):
            return [f"{c} AS s{i}",
                    f"CASE WHEN {c} RLIKE {sql_text(NUMBER_TEXT)} THEN try_cast({c} AS DOUBLE) END AS x{i}"]
        return [f"{c} AS s{i}", f"{_as_double(f)} AS x{i}"]

    def aggs(i, f):
        text = isinstance(f.dataType, StringType)
        lo, hi = (f"min(s{i})", f"max(s{i})") if text else (f"min(x{i})", f"max(x{i})")
        return [f"count(s{i}) AS c{i}", f"avg(x{i}) AS mu{i}", f"stddev_samp(x{i}) AS sd{i}",
                f"{lo} AS lo{i}", f"{hi} AS hi{i}"]

    def rows(i, f):
        name = sql_text(f.name)

        def row(stat, value, text="CAST(NULL AS STRING)"):
            return (f"named_struct('column_name', {name}, 'summary', '{stat}', 'value', {value}, "
                    f"'text_value', {text})")
        out = [row("count", f"CAST(c{i} AS DOUBLE)"), row("mean", f"round(mu{i}, {digits})"),
               row("stddev", f"round(sd{i}, {digits})")]
        if isinstance(f.dataType, StringType):
            out += [row("min", "CAST(NULL AS DOUBLE)", f"lo{i}"), row("max", "CAST(NULL AS DOUBLE)", f"hi{i}")]
        else:
            out += [row("min", f"lo{i}"), row("max", f"hi{i}")]
        return out

    return per_column_rows(
        df, _columns(df, cols), inputs=inputs, aggs=aggs, rows=rows, width=lambda f: 8,
        schema="column_name string, summary string, value double, text_value string")


def category_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values with counts for several columns in one shuffle: (column_name, value, n).

    Each row is expanded to one (column, value) pair per column and partially
    aggregated before the shuffle, so the shuffle carries at most one row per
    distinct value per task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    return (df.select(F.inline(pairs)).groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("column_name", "value"))


def sparsity_within(df: DataFrame, where: Column, col: str, count_col: str) -> DataFrame:
    """Share of rows matching ``where`` that have ``col`` filled.

    E.g. how many charged-off loans carry settlement data. One row:
    n_rows (COUNT(count_col) under the predicate), n_missing, filled_share (NULL without rows).
    """
    sub = df.where(where)
    return sub.agg(
        F.count(F.col(count_col)).alias("n_rows"),
        F.count_if(F.col(col).isNull() & F.col(count_col).isNotNull()).alias("n_missing"),
    ).withColumn("filled_share",
                 F.round(F.lit(1.0) - F.try_divide("n_missing", "n_rows"), 6))


def column_quartiles(df: DataFrame, cols: Iterable[str] | None = None, **how) -> DataFrame:
    """Quartiles of every numeric column: (position, column_name, n, q1, median, q3).

    Each row is unpivoted to one (position, value) pair per numeric column and the exact
    interpolated quartiles are taken by position (see :mod:`lendscope.operators.quantiles`).
    ``n`` counts the values used: NULL and NaN are left out, and a column without values gets
    NULL quartiles.
    """
    fields = [(i, f) for i, f in _columns(df, cols) if is_numeric_type(f.dataType)]
    if not fields:
        return df.sparkSession.createDataFrame(
            [], "position int, column_name string, n bigint, q1 double, median double, q3 double")
    pairs = ", ".join(f"named_struct('position', {i}, 'x', CAST({sql_name(f.name)} AS DOUBLE))"
                      for i, f in fields)
    values = materialize(df.select(*[F.col(sql_name(f.name)) for _, f in fields]), "quartiles")
    q = quantiles.exact_quantiles(values.selectExpr(f"inline(array({pairs}))"), "x", ["position"], written=True, **how)
    rows = ", ".join(f"named_struct('position', {i}, 'column_name', {sql_text(f.name)})" for i, f in fields)
    names = df.sparkSession.range(1).selectExpr(f"inline(array({rows}))")
    return (names.join(q, "position", "left")
            .select("position", "column_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                    F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
            .orderBy("position"))


def distinct_estimates(df: DataFrame, cols: Iterable[str] | None = None,
                       lg_k: int = 12) -> DataFrame:
    """Approximate distinct count per column (HyperLogLog): (position, column_name, approx_distinct).

    Each row is unpivoted to one (position, 64-bit hash of the value) pair per
    column; a mergeable HLL sketch per column is built on the map side and merged
    in two levels (see :mod:`lendscope.operators.quantiles`), so the task that
    finishes a column merges a bounded number of ~2 KB sketches. ``lg_k`` = 12
    gives about 1.6% relative error; small counts are exact. Exact distinct counts
    of every column at once would shuffle rows x columns.
    """
    fields = _columns(df, cols)
    if not fields:
        return df.sparkSession.createDataFrame([], "position int, column_name string, approx_distinct bigint")
    pairs = ", ".join(
        f"named_struct('position', {i}, 'h', CASE WHEN {sql_name(f.name)} IS NOT NULL "
        f"THEN xxhash64({sql_name(f.name)}) END)" for i, f in fields)
    names = ", ".join(f"{i}, {sql_text(f.name)}" for i, f in fields)
    sketches = quantiles.two_level(
        df.selectExpr(f"inline(array({pairs}))"), ["position"],
        partial=[F.hll_sketch_agg("h", lg_k).alias("s")],
        final=[F.hll_union_agg("s").alias("s")])
    return (sketches
            .selectExpr("position", f"element_at(map({names}), position) AS column_name",
                        "hll_sketch_estimate(s) AS approx_distinct")
            .orderBy("position"))
