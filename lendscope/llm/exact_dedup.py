"""Exact dedup by content sort, in DataFrame functions only.

Normalised texts are range-partitioned at sampled splitters, each partition is sorted
externally, equal texts then lie next to each other, and a window that compares neighbours in
full keeps one row of each run. A group that holds more than ``hot_share`` of all rows is cut
into pieces before the sort (at most ``1 / hot_share`` groups can be that large, so their list
has a proven bound and is broadcast); the pieces' winners are merged afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import ASCII_SPACE, fresh_names, materialize


def normalized(text) -> F.Column:
    """The text without any of ``[\\x20\\x09-\\x0D]``; null is the empty text."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), ASCII_SPACE, "")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hot_share: float = 1 / 1024) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their normalised bytes are. Of a group the row with the most code
    points in its original text stays, then the smallest id (a null id loses to any other).
    Null text counts as empty; empty texts form one group. Rows repeated in id and text are
    rows of their own in ``group_size``; exactly the first of them is ``kept``. An empty table
    gives no rows; other columns are not read.
    """
    return decide(df, id_col, text_col, hot_share).drop("n_cp")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df`` that ``exact_dedup`` keeps, with all their columns; of rows repeated in
    id and text one. Null, empty and very long texts as in ``exact_dedup``; columns of any name keep
    their values."""
    sha, key, cp = fresh_names(df, "_sha", "_id", "_cp")
    kept = (decide(df, id_col, text_col, **how).where("kept")
            .select(F.col("doc_id").alias(key), F.col("n_cp").alias(cp), F.col("text_sha256").alias(sha)))
    rows = df.withColumns({sha: F.sha2(normalized(df[text_col]), 256), key: df[id_col].cast("long"),
                           cp: F.char_length(F.coalesce(df[text_col].cast("string"), F.lit("")))})
    same = (rows[sha] == kept[sha]) & rows[key].eqNullSafe(kept[key]) & (rows[cp] == kept[cp])
    return rows.join(kept, same, "left_semi").dropDuplicates([sha, key, cp]).select(*df.columns)


def decide(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_share: float = 1 / 1024) -> DataFrame:
    """The rows of ``exact_dedup`` and ``n_cp``, the code points of the original text."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    rows = (df.select(df[id_col].cast("long").alias("doc_id"), normalized(df[text_col]).alias("norm"),
                      F.char_length(text).alias("n_cp"))
            .withColumn("h", F.xxhash64("norm")))
    limit = max(1.0, df.select(F.lit(1)).count() * hot_share)
    hot = (rows.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > limit)
           .select("h", F.ceil(F.col("n") / limit).cast("int").alias("pieces")))
    # The splitters are sampled from short leading columns; equal texts agree in them.
    keyed = (rows.join(F.broadcast(hot), "h", "left")
             .select("doc_id", "norm", "n_cp", "h", F.substring("norm", 1, 32).alias("lead"),
                     F.col("pieces").isNotNull().alias("hot"),
                     F.coalesce(F.pmod(F.xxhash64("doc_id", "n_cp"), F.col("pieces")), F.lit(0)).alias("piece")))
    same_text = Window.partitionBy("lead", "h", "piece", "norm")
    run = same_text.orderBy(F.desc("n_cp"), F.asc_nulls_last("doc_id"))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = (keyed.repartitionByRange("lead", "h", "piece")
             .select("doc_id", "n_cp", "hot", F.sha2("norm", 256).alias("text_sha256"),
                     F.first("doc_id").over(whole).alias("keep_id"), F.first("n_cp").over(whole).alias("keep_cp"),
                     F.count(F.lit(1)).over(whole).alias("group_size"),
                     (F.row_number().over(run) == 1).alias("kept")))
    local = materialize(local, "exact-dedup")
    best = F.struct(F.col("keep_cp").alias("cp"), F.col("keep_id").isNotNull().alias("known"),
                    (-F.col("keep_id")).alias("minus"), F.col("keep_id").alias("id"))
    merged = (local.where("hot AND kept").groupBy("text_sha256")
              .agg(F.max(best).alias("best"), F.sum("group_size").alias("size"))
              .select("text_sha256", F.col("best.id").alias("best_id"), F.col("best.cp").alias("best_cp"), "size"))
    # A repeat of the winner in another piece has the same id and length: the pieces hash
    # by id and length, so such rows share a piece and only one of them is ``kept`` there.
    wins = F.col("keep_id").eqNullSafe(F.col("best_id")) & (F.col("keep_cp") == F.col("best_cp"))
    return (local.join(F.broadcast(merged), "text_sha256", "left")
            .select("doc_id", F.when(F.col("hot"), F.col("best_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("size", "group_size").alias("group_size"),
                    (F.col("kept") & (~F.col("hot") | wins)).alias("kept"), "text_sha256", "n_cp"))


ORACLE = r"""
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM (
  SELECT doc_id, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS rn,
         count(*) OVER (PARTITION BY norm) AS group_size, sha256(norm) AS text_sha256
  FROM (SELECT doc_id, coalesce(text, '') AS t,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
  WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST))
"""
