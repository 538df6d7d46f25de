"""Exact quantiles and mergeable sketches that stay bounded when one group holds a third of all rows.

Spark's exact ``percentile`` keeps every distinct value of a group in the one task that finishes
it. :func:`exact_quantiles` brackets each wanted rank by a small KLL sketch per group, then counts:
values below the bracket collapse to one row per task, values inside it are grouped with their
counts, and a running sum finds the rank. The counts prove whether the rank lies inside the
bracket; where it does not the bracket is widened and the pass repeated, so no result is the
sketch's own value and the result is the same for any partitioning.

Sketches (DataSketches KLL for quantiles, HLL for distinct counts, both built into Spark) are
merged first within ``salts`` sets of map tasks (``spark_partition_id() % salts``) and then per
group, so the task that finishes a group merges a bounded number of sketches of bounded size.
NaN and NULL are left out; a group without values gets no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from lendscope.session import materialize

#: Size of the bracketing sketches; a smaller one gives wider brackets, never other results.
BRACKET_K = 2048
DEFAULT_SALTS = 512


def two_level(df: DataFrame, by: Sequence[str], partial: Sequence[Column],
              final: Sequence[Column], salts: int = DEFAULT_SALTS) -> DataFrame:
    """Aggregate by (``by``, map-task salt) with ``partial``, then by ``by`` with ``final``.

    ``final`` merges the columns ``partial`` produced (sums of counts, merges of
    sketches, min of mins, ...). Map-side partial aggregation still applies at the
    first level, so each map task sends one row per group.
    """
    salt = (F.spark_partition_id() % F.lit(salts)).alias("_salt")
    return df.groupBy(*by, salt).agg(*partial).groupBy(*by).agg(*final)


def kll(x: Column | str, k: int = BRACKET_K) -> Column:
    """Partial quantile sketch of a double column (NULL and NaN left out)."""
    return F.kll_sketch_agg_double(x, k)


def kll_merge(sketch: str) -> Column:
    return F.kll_merge_agg_double(sketch)


def kll_quantile(sketch: str, p: float) -> Column:
    """The quantile at ``p``; NULL for a sketch without values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0,
                  F.kll_sketch_get_quantile_double(sketch, F.lit(p)))


def kll_quantiles(sketch: str, ps: Sequence[float]) -> Column:
    """An array of quantiles at ``ps``; NULL for a sketch without values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0,
                  F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(p)) for p in ps])))


def _literal(value) -> Column:
    if isinstance(value, list):
        return F.array(*[_literal(v) for v in value])
    if isinstance(value, Row):
        return F.struct(*[_literal(v).alias(c) for c, v in value.asDict().items()])
    return F.lit(value)


def with_group_columns(rows: DataFrame, table: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``rows`` with ``columns`` of ``table`` (one row per group). Without keys the one row's values
    become literals; else an unhinted null-safe join, whose plan Spark picks by size."""
    if not by:
        row = table.select(*columns).first()
        return rows.where(F.lit(row is not None)).withColumns(
            {c: _literal(None if row is None else row[c]).cast(table.schema[c].dataType) for c in columns})
    g = table.select(*[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)], *columns)
    cond = [rows[k].eqNullSafe(g[f"_by{i}"]) for i, k in enumerate(by)]
    return rows.join(g, cond).drop(*[f"_by{i}" for i in range(len(by))])


def exact_quantiles(df: DataFrame, value: str, by: Sequence[str] = (), probs: Sequence[float] = (0.25, 0.5, 0.75),
                    kind: str = "cont", k: int = BRACKET_K, error: float = 0.002,
                    window_rows: int = 1_000_000, written: bool = False) -> DataFrame:
    """One row per group: ``by``, ``n``, ``q`` (an array in the order of ``probs``), ``min_value``,
    ``max_value``.

    ``kind`` "cont" interpolates between the two values around rank ``p * (n - 1)`` (SQL
    ``percentile_cont``); "disc" takes the first value whose share of values at or below it
    reaches ``p`` (``percentile_disc``). Groups and values are written once as a layer, so that the
    input is computed once, and read twice (sketch, count) unless a bracket has to be widened;
    ``written`` says that ``df`` reads such a layer already. A bracket that holds more than ``window_rows`` distinct values is narrowed
    by counts over equal ranges before its values are put in order in one task.
    """
    by, probs = list(by), [float(p) for p in probs]
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(*by, x.alias("_x"))
    if not written:
        rows = materialize(rows, "quantile-values")
    base = materialize(two_level(
        rows, by,
        partial=[F.count(F.lit(1)).alias("n"), kll("_x", k).alias("_k"), F.min("_x").alias("lo"), F.max("_x").alias("hi")],
        final=[F.sum("n").alias("n"), kll_merge("_k").alias("_k"), F.min("lo").alias("min_value"),
               F.max("hi").alias("max_value")]).where("n > 0"), "quantile-sketches")

    def rank(p):
        """(first rank from 0, weight of the one after it)"""
        n = F.col("n")
        if kind == "disc":
            return F.greatest(F.ceil(n * F.lit(p)) - 1, F.lit(0)).cast("bigint"), F.lit(0.0)
        at = (n - 1) * F.lit(p)
        return F.floor(at).cast("bigint"), at - F.floor(at)

    targets = F.array(*[F.struct(F.lit(j).alias("j"), rank(p)[0].alias("rank"),
                                 rank(p)[1].alias("part")) for j, p in enumerate(probs)])
    todo = base.select(*by, "n", "_k", "min_value", "max_value", F.inline(targets))
    done = None
    while True:
        # Brackets by rank from the sketch (which wants literals); past its ends they reach to the
        # smallest or largest value.
        lo, hi = F.col("min_value"), F.col("max_value")
        for i, p in enumerate(probs):
            if p - error > 0:
                lo = F.when(F.col("j") == i, F.kll_sketch_get_quantile_double("_k", F.lit(p - error))).otherwise(lo)
            if p + error < 1:
                hi = F.when(F.col("j") == i, F.kll_sketch_get_quantile_double("_k", F.lit(p + error))).otherwise(hi)
        bracket = todo.select(*by, "j", "rank", "part", "n", lo.alias("lo"), hi.alias("hi"))
        wide = bracket.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("j", "lo", "hi"))).alias("_b"))
        inside = with_group_columns(rows, wide, by, ["_b"]).select(*by, "_x", F.inline("_b")).where("_x <= hi")
        key = F.when(F.col("_x") >= F.col("lo"), F.col("_x"))  # NULL: somewhere below the bracket
        counted = materialize(inside.groupBy(*by, "j", key.alias("_v")).agg(F.count(F.lit(1)).alias("c")), "quantile-counts")
        checked = materialize(_match(bracket, counted.groupBy(*by, "j").agg(
            F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("c"))), F.lit(0)).alias("below"),
            F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("c"))), F.lit(0)).alias("held"),
            F.count("_v").alias("values")), by), "quantile-brackets")
        fits = (F.col("rank") >= F.col("below")) & (F.least(F.col("rank") + 1, F.col("n") - 1) < F.col("below") + F.col("held"))
        good = checked.where(fits)
        found = _ranked(_narrowed(counted, good, by, window_rows), by)
        done = found if done is None else done.unionByName(found)
        missed = checked.where(~fits)
        if missed.isEmpty():
            break
        error *= 8
        todo = _match(todo, missed.select(*by, "j"), by)
    quantile = done.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("j", "q"))).alias("_q"))
    return with_group_columns(base.select(*by, "n", "min_value", "max_value"), quantile, by, ["_q"]).select(
        *by, "n", F.transform("_q", lambda s: s["q"]).alias("q"), "min_value", "max_value")


def _match(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of both with the same group and ``j``."""
    keys = [*by, "j"]
    g = right.withColumnsRenamed({c: f"_r{i}" for i, c in enumerate(keys)})
    cond = [left[c].eqNullSafe(g[f"_r{i}"]) for i, c in enumerate(keys)]
    return left.join(g, cond).drop(*[f"_r{i}" for i in range(len(keys))])


def _narrowed(counted: DataFrame, brackets: DataFrame, by: Sequence[str], window_rows: int) -> DataFrame:
    """Rows (``by``, ``j``, ``_v``, ``c``, ``rank``, ``part``, ``below``) of the brackets' values, where
    ``below`` counts the group's values before them. A bracket with too many distinct values is cut
    into equal ranges, whose counts tell the range that holds the rank; values past it are left out
    only up to the next value, which interpolation needs."""
    held = _match(brackets.select(*by, "j", "rank", "part", "below", "values"), counted.where("_v IS NOT NULL"), by)
    for _ in range(8):
        if held.where(F.col("values") > window_rows).isEmpty():
            break
        group = [*by, "j"]
        span = held.groupBy(*group).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        cut = _match(held, span, by)
        width = F.col("_hi") - F.col("_lo")
        cut = cut.withColumn("_r", F.when((F.col("values") > window_rows) & (width > 0), F.least(
            F.floor((F.col("_v") - F.col("_lo")) / width * 1024), F.lit(1023))).otherwise(0)).drop("_lo", "_hi")
        ranges = cut.groupBy(*group, "_r").agg(F.sum("c").alias("_c"), F.count(F.lit(1)).alias("_n"),
                                               F.first("rank").alias("_rank"), F.first("below").alias("_below"))
        order = Window.partitionBy(*group).orderBy("_r")
        ranges = ranges.withColumn("_before", F.col("_below") + F.coalesce(
            F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        # The range of the rank, and the one after it if the next rank is its first value.
        has = (F.col("_before") <= F.col("_rank") + 1) & (F.col("_rank") < F.col("_before") + F.col("_c"))
        kept = (ranges.where(has).groupBy(*group).agg(F.min("_before").alias("_start"), F.sum("_n").alias("_values"),
                                                      F.collect_list("_r").alias("_keep")))
        held = (_match(cut, kept, by).where(F.array_contains("_keep", F.col("_r")))
                .select(*group, "rank", "part", F.col("_start").alias("below"), F.col("_values").alias("values"), "_v", "c"))
    return held


def _ranked(held: DataFrame, by: Sequence[str]) -> DataFrame:
    group = [*by, "j"]
    upto = F.col("below") + F.sum("c").over(Window.partitionBy(*group).orderBy("_v"))
    at = held.withColumn("_upto", upto)
    first = F.min(F.when(F.col("_upto") > F.col("rank"), F.col("_v")))
    second = F.min(F.when(F.col("_upto") > F.col("rank") + 1, F.col("_v")))
    both = at.groupBy(*group).agg(first.alias("_a"), second.alias("_b"), F.first("part").alias("_p"))
    mixed = F.when((F.col("_p") == 0) | F.col("_b").isNull(), F.col("_a")).otherwise(
        F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_p"))
    return both.select(*group, mixed.alias("q"))
