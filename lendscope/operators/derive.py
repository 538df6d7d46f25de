"""Features derived from a frame's schema and data, hashed into one sparse vector.

Nobody lists columns: each one gets a route from its type and its exact number of distinct values.
Numbers (and text that mostly reads as numbers) are scaled to unit deviation and get an indicator
where they are missing; text of few values is one-hot; text of many values is split into tokens;
columns that say nothing are left out. Every feature is named ``column=value``, so columns have
namespaces of their own, and an md5 of that name gives its slot and its sign: collisions cancel on
average instead of adding up. The vector is a pair of arrays (slots, values) built by plain
expressions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StringType, TimestampNTZType, TimestampType

from lendscope.constants import HASHED_FEATURES
from lendscope.functions.missing import is_missing, is_numeric_type
from lendscope.operators.features import LABEL_COPIES, guard_features
from lendscope.operators.quality import sql_name
from lendscope.operators.replicas import distinct_counts
from lendscope.session import materialize

#: Text with at most this many distinct values is one-hot, with more it is split into tokens.
ONE_HOT_VALUES = 64
#: Text is read as numbers if at least this share of its values can be.
NUMBER_SHARE = 0.9
TOKEN_GAP = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Route:
    """How a column becomes features: ``kind`` is number, category, tokens or none."""
    position: int
    column: str
    kind: str
    n_distinct: int
    n_missing: int
    scale: float | None  # one over the deviation of a number


def _as_number(name: str, dtype) -> Column:
    c = F.col(sql_name(name))
    if isinstance(dtype, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")) / 1e6
    x = c.try_cast("double") if isinstance(dtype, StringType) else c.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def derive_routes(df: DataFrame, label: str = "target", ids: Sequence[str] = ("id",), exclude: Sequence[str] = (),
                  one_hot_values: int = ONE_HOT_VALUES) -> list[Route]:
    """The route of every column but the label, its copies, the ids and ``exclude``, in the frame's
    order. Two passes over one written copy of the columns; one row per column on the driver."""
    banned = {label, *LABEL_COPIES, *ids, *exclude}
    fields = [(i, f) for i, f in enumerate(df.schema.fields) if f.name not in banned]
    guard_features([f.name for _, f in fields], label)
    layer = materialize(df.select(*[F.col(sql_name(f.name)) for _, f in fields]), "derive")
    distinct = {r["column_name"]: r["n_distinct"] for r in distinct_counts(layer).collect()}
    sums = []
    for i, f in fields:
        numeric = is_numeric_type(f.dataType) or isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))
        text = isinstance(f.dataType, StringType)
        x = _as_number(f.name, f.dataType) if numeric or text else F.lit(None).cast("double")
        sums += [F.count_if(is_missing(sql_name(f.name), f.dataType)).alias(f"m{i}"), F.count(x).alias(f"c{i}"), F.stddev_samp(x).alias(f"s{i}")]
    row = layer.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    routes = []
    for i, f in fields:
        known, parsed, sd, values = row["n"] - row[f"m{i}"], row[f"c{i}"], row[f"s{i}"], distinct.get(f.name, 0)
        if values < 2:
            kind = "none"
        elif isinstance(f.dataType, BooleanType):
            kind = "category"
        elif isinstance(f.dataType, StringType):
            kind = "number" if parsed >= NUMBER_SHARE * known and parsed else "category" if values <= one_hot_values else "tokens"
        else:
            kind = "number" if parsed else "none"
        scale = 1 / sd if kind == "number" and sd else None
        routes.append(Route(i, f.name, kind if kind != "number" or scale else "none", values, row[f"m{i}"], scale))
    return routes


def routes_table(spark: SparkSession, routes: Sequence[Route]) -> DataFrame:
    """The routes as rows (position, column_name, route, n_distinct, n_missing)."""
    return spark.createDataFrame([(r.position, r.column, r.kind, r.n_distinct, r.n_missing) for r in routes],
                                 "position int, column_name string, route string, n_distinct bigint, n_missing bigint")


def slot_and_sign(name: str, width: int = HASHED_FEATURES) -> tuple[int, int]:
    """The slot and the sign of a feature: eight hex digits of its name's md5, and the next one."""
    digest = hashlib.md5(name.encode(), usedforsecurity=False).hexdigest()
    return int(digest[:8], 16) % width, -1 if int(digest[8], 16) >= 8 else 1


def _entry(digest: Column, width: int, value: Column | None = None) -> Column:
    """:func:`slot_and_sign` of a name that differs by row, by its md5, as an (at, value) struct."""
    sign = F.when(F.substring(digest, 9, 1) >= "8", F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.struct((F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % width).cast("int").alias("at"),
                    (sign if value is None else sign * value).alias("value"))


def _fixed(name: str, width: int, value: Column) -> Column:
    slot, sign = slot_and_sign(name, width)
    return F.struct(F.lit(slot).alias("at"), (value * F.lit(float(sign))).alias("value"))


def hashed_features(df: DataFrame, routes: Sequence[Route], keep: Sequence[str] = ("id", "target"), width: int = HASHED_FEATURES) -> DataFrame:
    """``keep``, ``at``, ``value``: slots and values of each row's features, in the routes' order.

    A number x gives ``column`` with x over its deviation (nothing for 0); a missing number or
    category gives ``column=missing``; a category ``column=value``; a token ``column=token`` with its
    count. Two features of a row may share a slot; they add up wherever the vector is used.
    """
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    parts, none = [], F.array().cast("array<struct<at:int,value:double>>")
    # The tokens are a column of their own: inside the count they would be split again for every token.
    stem = "_tokens"
    while any(c.lower().startswith(stem) for c in df.columns):
        stem = "_" + stem
    split = {r.column: f"{stem}_{r.position}" for r in routes if r.kind == "tokens"}
    df = df.withColumns({name: F.filter(F.split(F.lower(F.col(sql_name(c))), TOKEN_GAP), lambda t: t != "") for c, name in split.items()})
    for r in routes:
        c = F.col(sql_name(r.column))
        missing = F.array(_fixed(f"{r.column}=missing", width, F.lit(1.0)))
        if r.kind == "number":
            x = _as_number(r.column, dtypes[r.column])
            parts.append(F.when(x.isNull(), missing).when(x == 0, none).otherwise(F.array(_fixed(r.column, width, x * F.lit(r.scale)))))
        elif r.kind == "category":
            text = F.concat(F.lit(r.column + "="), c.cast("string"))
            parts.append(F.when(is_missing(sql_name(r.column), dtypes[r.column]), missing).otherwise(F.array(_entry(F.md5(text), width))))
        elif r.kind == "tokens":
            tokens = F.col(split[r.column])
            named = F.transform(F.array_distinct(tokens), lambda t: F.struct(
                F.md5(F.concat(F.lit(r.column + "="), t)).alias("digest"), F.size(F.filter(tokens, lambda u: u == t)).cast("double").alias("n")))
            counted = F.transform(named, lambda e: _entry(e["digest"], width, e["n"]))
            parts.append(F.when(is_missing(sql_name(r.column), dtypes[r.column]), missing).otherwise(counted))
    entries = F.concat(*parts) if parts else none
    return df.select(*keep, entries.alias("_e")).select(*keep, F.col("_e.at").alias("at"), F.col("_e.value").alias("value"))
