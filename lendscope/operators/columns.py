"""Column-level operators: drop lists, redundant columns, feature lists, schema table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DataType, DateType, StringType, TimestampNTZType, TimestampType,
)

from lendscope.functions.missing import is_numeric_type
from lendscope.operators.quality import distinct_estimates, per_column_rows, sql_name, sql_text


def drop_columns(df: DataFrame, cols: Iterable[str], strict: bool = False) -> DataFrame:
    """Drop a list of columns; unknown names are ignored unless ``strict``.

    ``strict=True`` raises on names the frame does not have (it would have caught
    a misspelt entry in a hand-written drop list).
    """
    cols = list(dict.fromkeys(cols))
    if strict:
        unknown = [c for c in cols if c not in df.columns]
        if unknown:
            raise KeyError(f"unknown columns: {unknown}")
    return df.drop(*cols)


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the columns new names by position (the notebook's ``frame.columns = [...]``)."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def _orderable(dtype: DataType) -> bool:
    return (is_numeric_type(dtype) or isinstance(dtype, (StringType, BooleanType, DateType,
            TimestampType, TimestampNTZType, BinaryType)))


def redundant_columns(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Columns that carry no information: all NULL ('empty') or one value ('constant').

    count / min / max per column (see :func:`~lendscope.operators.quality.per_column_rows`).
    Free-text columns with nearly as many values as rows are found with
    :func:`~lendscope.operators.quality.distinct_estimates`.
    """
    wanted = None if cols is None else set(cols)
    fields = [f for f in df.schema.fields if (wanted is None or f.name in wanted) and _orderable(f.dataType)]

    def row(i, f):
        return [f"named_struct('position', {i}, 'column_name', {sql_text(f.name)}, 'reason', "
                f"CASE WHEN c{i} = 0 THEN 'empty' WHEN k{i} THEN 'constant' END)"]

    out = per_column_rows(
        df, list(enumerate(fields)),
        inputs=lambda i, f: [f"{sql_name(f.name)} AS v{i}"],
        aggs=lambda i, f: [f"count(v{i}) AS c{i}", f"min(v{i}) = max(v{i}) AS k{i}"],
        rows=row, width=lambda f: 3,
        schema="position int, column_name string, reason string")
    return out.where(F.col("reason").isNotNull())


def high_cardinality_columns(df: DataFrame, share: float = 0.5, cols: Iterable[str] | None = None) -> DataFrame:
    """Text columns with more distinct values than ``share`` of their rows, by the distinct estimate
    (about 2% error): (position, column_name), free text to drop before one-hot encoding."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and (cols is None or f.name in set(cols))]
    places = {n: i for i, n in enumerate(df.columns)}
    n = df.count()
    position = F.element_at(F.create_map(*[F.lit(x) for n in names for x in (n, places[n])]), F.col("column_name"))
    return distinct_estimates(df, names).where(F.col("approx_distinct") > share * n).select(position.alias("position"), "column_name")


def feature_columns(df: DataFrame, label: str, ids: Sequence[str] = ("id",),
                    categoricals: Sequence[str] = (), exclude: Sequence[str] = ()) -> list[str]:
    """Numeric feature names by name (never by position); the label and its copies are out."""
    banned = {label, *ids, *categoricals, *exclude}
    out = [f.name for f in df.schema.fields
           if f.name not in banned and is_numeric_type(f.dataType)]
    assert label not in out
    return out


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as rows: (position, column_name, data_type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
