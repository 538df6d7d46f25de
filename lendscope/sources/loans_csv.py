"""Loan CSV reader, layered writers, single-file export, SQL views, text scrub job.

Raw loan files are wide and dirty: free text with unescaped quotes and commas
shifts later fields to the right. The reader therefore takes a declared schema
(all text by default; parsing to numbers is a separate, visible step), sets
quote/escape/multiLine, and keeps malformed lines in a corrupt-record column
instead of guessing. Schema inference (an extra full scan) is opt-in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lendscope.functions.text import scrub_line

CORRUPT_COL = "_corrupt_record"


def text_schema(columns: Sequence[str], corrupt_col: str | None = CORRUPT_COL) -> StructType:
    """All-text schema for the named columns (plus the corrupt-record column)."""
    fields = [StructField(c, StringType(), True) for c in columns]
    if corrupt_col:
        fields.append(StructField(corrupt_col, StringType(), True))
    return StructType(fields)


def typed_schema(columns: Sequence[tuple[str, str]], corrupt_col: str | None = None) -> StructType:
    ddl = ", ".join(f"`{n}` {t}" for n, t in columns)
    schema = StructType.fromDDL(ddl) if hasattr(StructType, "fromDDL") else None
    if schema is None:  # pragma: no cover - older pyspark
        from pyspark.sql.types import _parse_datatype_string
        schema = _parse_datatype_string(ddl)
    if corrupt_col:
        schema = schema.add(corrupt_col, StringType(), True)
    return schema


def read_loans(spark: SparkSession, path: str, schema: StructType | None = None,
               infer: bool = False, sep: str = ",", multiline: bool = False,
               corrupt_col: str = CORRUPT_COL, keep_empty_strings: bool = True) -> DataFrame:
    """Read loan CSV files (header line, RFC-4180 quoting, PERMISSIVE).

    With a declared ``schema`` a line with too many or too few fields, or a
    value that does not fit its type, lands in ``corrupt_col`` (when the schema
    carries that column). ``infer=True`` reproduces the notebook's inferred read; it scans every file
    once more to find the types, and one odd value makes a whole column text.

    ``keep_empty_strings``: an unquoted empty field is NULL and a quoted one
    (``""``) is the empty string, so NULL and '' survive a write/read round trip
    (by default both would come back as NULL).

    Scale: files split at line boundaries across tasks, and a record broken by a line break
    inside quotes lands in ``corrupt_col``. With ``multiline=True`` quoted fields may hold line
    breaks, but then a file cannot be split and is read by one task - for many files of
    moderate size only.
    """
    reader = (spark.read.option("header", True).option("sep", sep).option("quote", '"')
              .option("escape", '"').option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if keep_empty_strings:
        reader = reader.option("nullValue", None)
    if infer:
        reader = reader.option("inferSchema", True)
    elif schema is not None:
        reader = reader.schema(schema)
        if corrupt_col in schema.fieldNames():
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.csv(path)


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by: Sequence[str] | None = None) -> str:
    """Write a layer in parallel (one file per task). CSV gets a header line.

    Parquet is the internal format (columnar: pruning, pushdown, vectorised reads);
    partitioning by a low-cardinality key (e.g. issue year) lets later filters
    skip whole folders. A partitioned write is rebalanced on its partition columns
    first: without it every task would write one file per key it holds (tasks x
    keys small files); a plain repartition by key would put a year holding a third
    of the rows into one task. AQE's rebalance splits such a key into chunks of the
    advisory partition size and merges small ones.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # Keep blanks as they are (the writer trims them by default) and tell an
        # empty string ("") from a missing value (nothing).
        w = (w.option("header", True).option("quote", '"').option("escape", '"')
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def export_single_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """One CSV file for download. The final write is one task by design; the plan
    above it stays parallel (``repartition(1)``, not ``coalesce(1)``, which would
    pull the whole upstream computation into that single task)."""
    (df.repartition(1).write.mode(mode).option("header", True).option("quote", '"')
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def register_view(df: DataFrame, name: str) -> DataFrame:
    """(Re)register a temp view; call again after changing ``df`` (a view is a plan snapshot)."""
    df.createOrReplaceTempView(name)
    return df


def scrub_text_files(spark: SparkSession, src: str, dst: str, mode: str = "errorifexists") -> str:
    """Distributed text scrub: per line, collapse blanks, trim, drop non-ASCII characters.

    Files are split across tasks by Spark's line reader; no line is handled twice
    and no file passes through the driver.
    """
    lines = spark.read.text(src)
    lines.select(scrub_line(F.col("value")).alias("value")).write.mode(mode).text(dst)
    return dst
