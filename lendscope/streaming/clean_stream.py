"""The row-level cleaning rules on a Structured Streaming source.

Row rules, parsing and the default label are pure column expressions, so the
same functions used in batch apply unchanged to a streaming DataFrame. Each
micro-batch is split into valid and quarantined rows and written to two
Parquet folders; a batch is written under its own ``batch_id`` folder with
overwrite, so a batch that is retried after a failure replaces its own output
(idempotent) and the checkpoint in shared storage lets the query resume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lendscope.constants import ROW_RULES
from lendscope.operators.quality import reject_reason
from lendscope.plans.curate import fill_balances, label, parse_strings


def loan_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of loan records (CSV with header, or Parquet)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = (reader.option("header", True).option("quote", '"').option("escape", '"')
                  .option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def tag_rows(df: DataFrame, rules=ROW_RULES) -> DataFrame:
    """Add ``reject_reason`` (NULL for valid rows), parsed numbers and the label."""
    out = df.withColumn("reject_reason", reject_reason(rules))
    return label(fill_balances(parse_strings(out)))


def write_split_batch(batch: DataFrame, batch_id: int, valid_path: str, reject_path: str) -> None:
    """Write one micro-batch's valid and quarantined rows under its own batch id.

    Overwrite mode makes a retried batch replace what an earlier attempt wrote. The batch is
    persisted for its two writes, so source, joins and rules run once.
    """
    batch = batch.persist()
    try:
        valid = batch.where(F.col("reject_reason").isNull()).drop("reject_reason")
        rejects = batch.where(F.col("reject_reason").isNotNull())
        valid.write.mode("overwrite").parquet(f"{valid_path}/batch_id={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{reject_path}/batch_id={batch_id}")
    finally:
        batch.unpersist()


def write_valid_and_rejects(tagged: DataFrame, valid_path: str, reject_path: str,
                            checkpoint: str, available_now: bool = True) -> StreamingQuery:
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_split_batch(batch, batch_id, valid_path, reject_path)

    writer = tagged.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def defaults_by_window(tagged: DataFrame, ts_col: str, window: str = "30 days",
                       watermark: str = "60 days") -> DataFrame:
    """Loans and defaults per event-time window, closed once the watermark passes."""
    return (tagged.withWatermark(ts_col, watermark)
            .groupBy(F.window(ts_col, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_loans"), F.sum("target").alias("n_defaults"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_loans", "n_defaults"))
