"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets come from weights under a cap of ``max_repeat`` times a source's size. The words of the
mix go to the sources one by one: word k of a source is allocated when its quotient
``target / (2k - 1)`` is among the highest. A second apportionment hands a source's words to its
shards by the shards' sizes in blocks of equal length, and what whole blocks leave over to the
last shards that have room. In a shard the documents lie in a seeded order as one stream, and its
words are taken from a seeded starting word on, around the end.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import WORD_PATTERN, fresh_names, materialize

#: Fixed values of the registered mix: weights of the sources by code point, repeating.
MIX_WEIGHTS = (5, 2, 1)
MIX_SHARE = 1.5
MIX_MAX_REPEAT = 2


def sainte_lague(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Integer seats by highest quotients ``weight / (2k - 1)``, none above its cap.

    Starts from the rounded shares and adds or takes single seats by quotient, so the work
    follows the number of weights, not of seats. Ties go to the earlier entry.
    """
    weights = np.asarray(weights, dtype=float)
    caps = np.asarray(caps, dtype=np.int64)
    seats = int(min(seats, caps.sum()))
    if seats <= 0 or weights.sum() <= 0:
        return np.zeros(len(weights), dtype=np.int64)
    got = np.minimum(np.floor(weights / weights.sum() * seats + 0.5).astype(np.int64), caps)
    missing = seats - int(got.sum())
    while missing > len(weights):  # capped entries leave much behind: share it out again
        free = got < caps
        more = np.floor(weights * free / max((weights * free).sum(), 1e-300) * missing).astype(np.int64)
        new = np.minimum(got + more, caps)
        if (new == got).all():
            break
        got, missing = new, seats - int(new.sum())
    if missing > 0:
        heap = [(-weights[i] / (2 * got[i] + 1), i) for i in range(len(weights)) if got[i] < caps[i]]
        heapq.heapify(heap)
        while missing and heap:
            _, i = heapq.heappop(heap)
            got[i] += 1
            missing -= 1
            if got[i] < caps[i]:
                heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    elif missing < 0:
        heap = [(weights[i] / (2 * got[i] - 1), -i) for i in range(len(weights)) if got[i] > 0]
        heapq.heapify(heap)
        while missing:
            _, minus = heapq.heappop(heap)
            got[-minus] -= 1
            missing += 1
            if got[-minus] > 0:
                heapq.heappush(heap, (weights[-minus] / (2 * got[-minus] - 1), minus))
    return got


def source_targets(sizes: DataFrame, weights=MIX_WEIGHTS, share: float = MIX_SHARE,
                   max_repeat: int = MIX_MAX_REPEAT) -> DataFrame:
    """``source, source_size, target``: ``share`` of all words by weight; what a source's cap
    leaves over goes to the others by weight until none is above its cap.

    Sorted by cap per weight, the capped sources come first; a source is capped when the level
    that would serve it and all after it lies above its cap. One row per source.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    position = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    values = F.array(*[F.lit(float(w)) for w in weights])
    named = total.select("source", "source_size", F.get(values, F.pmod(position, F.lit(len(weights)))).alias("w"),
                         (F.col("source_size") * F.lit(float(max_repeat))).alias("cap"))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    level = ((F.lit(share) * F.sum("source_size").over(everything)
              - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    leveled = named.withColumn("level", level).withColumn("capped", F.col("level") >= F.col("cap") / F.col("w"))
    final = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return leveled.select("source", "source_size",
                          F.when(F.col("capped"), F.col("cap")).otherwise(final * F.col("w")).alias("target"))


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=MIX_WEIGHTS, share: float = MIX_SHARE, max_repeat: int = MIX_MAX_REPEAT,
                block_words: int = 64, shard_docs: int = 1024, seed: int = 8) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, taken, ranges``.

    ``size`` counts words (null text: 0); sources are ordered by code point, null last, and get
    ``weights`` in turn. ``taken`` counts the words the mix takes of the row, repeats included;
    it never exceeds ``max_repeat * size``. ``ranges`` has the words (start from 0, length) that it takes
    beyond whole passes over the row, in the order of the selection. The outcome depends on ids, sizes, sources and the
    seed only, so reruns agree. A source's words add up to its target, rounded, whatever the size
    of the table. Rows with a null or repeated id take part like any others; documents without
    words take nothing; an empty table gives no rows.
    """
    sized = materialize(df.select(df[id_col].cast("long").alias("doc_id"), df[source_col].cast("string").alias("source"),
                                  word_count(df[text_col].cast("string")).alias("size")), "mix-sizes")
    # Shards of about ``shard_docs`` documents, as many as a source needs.
    counts = sized.groupBy(F.col("source").alias("of")).agg(F.ceil(F.count("*") / F.lit(shard_docs)).alias("shards"))
    salted = (sized.join(counts, sized["source"].eqNullSafe(counts["of"]))
              .select("doc_id", "source", "size", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("shards")).alias("shard")))
    targets = source_targets(sized, weights, share, max_repeat)

    def per_source(pdf: pd.DataFrame) -> pd.DataFrame:
        first = sorted(range(len(pdf)), key=lambda i: (pd.isna(pdf["source"].iloc[i]), str(pdf["source"].iloc[i]).encode()))
        pdf = pdf.iloc[first]
        size = pdf["source_size"].to_numpy()
        got = sainte_lague(pdf["target"].to_numpy(), math.floor(share * int(size.sum()) + 0.5), size * max_repeat)
        return pdf.assign(source_words=got)

    quotas = targets.groupBy().applyInPandas(per_source, "source string, source_size long, target double, source_words long")

    def per_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard", ignore_index=True)
        words, total = pdf["words"].to_numpy(), int(pdf["source_words"].iloc[0])
        got = sainte_lague(words, total // block_words, words * max_repeat // block_words) * block_words
        free = words * max_repeat - got
        before = np.cumsum(free[::-1])[::-1] - free  # the last shards fill up first
        got += np.clip(total - int(got.sum()) - before, 0, free)
        return pdf.assign(quota=got)[["source", "shard", "source_size", "target", "quota"]]

    shard_words = salted.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    same = shard_words["source"].eqNullSafe(quotas["source"])
    plan = (shard_words.join(quotas, same).select(shard_words["source"], "shard", "words", "source_size", "target", "source_words")
            .groupBy("source").applyInPandas(per_shard, "source string, shard long, source_size long, target double, quota long"))
    plan = materialize(plan, "mix-plan")

    joined = (salted.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))
                                     & (F.col("d.shard") == F.col("p.shard")))
              .select("d.doc_id", "d.source", "d.size", "d.shard", "source_size", "target", "quota",
                      F.xxhash64(F.lit(seed + 1), "d.doc_id").alias("place"),
                      F.pmod(F.xxhash64(F.lit(seed + 2), "d.source", "d.shard"), F.lit(1 << 40)).alias("turn")))
    # A shard's documents as one stream of words: where each begins and ends, by a window per shard.
    shard = Window.partitionBy("source", "shard")
    ends = F.sum("size").over(shard.orderBy("place", F.asc_nulls_last("doc_id"), "size").rowsBetween(Window.unboundedPreceding, 0))
    laid = joined.withColumns({"begin": ends - F.col("size"), "end": ends, "length": F.sum("size").over(shard)}).where("size > 0")
    rest, first = F.col("quota") % F.col("length"), F.col("turn") % F.col("length")
    laid = laid.withColumns({"passes": F.floor(F.col("quota") / F.col("length")), "first": first, "last": first + rest})
    # The selection from ``first`` on, and what of it goes on from the start of the stream.
    ahead = F.greatest(F.least("end", "last", "length") - F.greatest("begin", "first"), F.lit(0))
    around = F.greatest(F.least(F.col("end"), F.col("last") - F.col("length")) - F.col("begin"), F.lit(0))
    laid = laid.withColumns({"ahead": ahead, "around": around}).withColumn("taken", F.expr("passes * size + ahead + around"))
    runs = F.array(F.struct(F.greatest(F.col("first") - F.col("begin"), F.lit(0)).alias("start"), F.col("ahead").alias("length")),
                   F.struct(F.lit(0).cast("long").alias("start"), F.col("around").alias("length")))
    partly = F.when(F.col("taken") % F.col("size") != 0, F.filter(runs, lambda r: r["length"] > 0))
    given = ["doc_id", "source", "size", "source_size", "target"]
    nothing = F.array().cast("array<struct<start:long,length:long>>")
    taken = laid.select(*given, F.col("taken").cast("long").alias("taken"), F.coalesce(partly, nothing).alias("ranges"))
    return taken.unionByName(joined.where("size = 0").select(*given, F.lit(0).cast("long").alias("taken"), nothing.alias("ranges")))


def apply_mix(df: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` as the mix takes them: a whole pass over a document gives one row with
    its whole text, what is taken beyond that gives a row for each range of its words (without
    ``ranges``, its first words); what is not taken gives none. A document without words (null or
    empty text too) has nothing to take and goes. Rows that agree in id, source and number of words
    are taken alike, as the one of them that the mix takes most of, null ids among them; a text is
    cut as a whole, however long. Columns of any name keep their values, ``n_chars`` is counted anew.
    An empty table gives no rows."""
    key, source, size, pieces, words, piece = fresh_names(df, "mix_id", "mix_source", "mix_size", "mix_pieces", "mix_words", "mix_piece")
    if "ranges" not in mixed.columns:
        mixed = mixed.withColumn("ranges", F.expr("IF(taken % size > 0, ARRAY(NAMED_STRUCT('start', 0L, 'length', taken % size)), ARRAY())"))
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("length")),
                           F.floor(F.col("taken") / F.col("size")).cast("int"))
    took = (mixed.where("taken > 0").withColumn("pieces", F.concat(whole, F.col("ranges")))
            .groupBy(F.col("doc_id").alias(key), F.col("source").alias(source), F.col("size").alias(size))
            .agg(F.max(F.struct("taken", "pieces"))["pieces"].alias(pieces)))
    sized = df.withColumn(words, word_count(df[text_col].cast("string")))
    joined = sized.join(took, sized[id_col].cast("long").eqNullSafe(took[key]) & (sized[words] == took[size])
                        & sized[source_col].cast("string").eqNullSafe(took[source]))
    at = F.col(piece)
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all(text_col, F.lit(WORD_PATTERN), 0),
                                   (at["start"] + 1).cast("int"), at["length"].cast("int")))
    text = F.when(at["length"] == F.col(words), F.col(text_col)).otherwise(cut)
    columns = [text.alias(c) if c == text_col else F.char_length(text).cast("long").alias(c) if c == "n_chars" else F.col(c)
               for c in df.columns]
    return joined.withColumn(piece, F.explode(pieces)).select(*columns)
