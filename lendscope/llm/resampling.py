"""Importance resampling towards a target distribution.

Features of a text are its runs of one and two words, hashed into buckets. Counts over the whole
source and the whole target give each bucket a gain, the scaled logarithm of the smoothed share in
the target over that in the source. An array of all gains scores whole batches of documents at
once; noise from a hash of the id makes the highest scores a sample without replacement.

The cutoff of the draw comes from a weighted median of medians: each task gives the median of its
keys that are still in question and their number; of the medians, weighted by those numbers, the
weighted median leaves at least a quarter of the keys on either side, so counting the keys up to it
discards a guaranteed share in every round, until the exact cutoff key is known. Only the winners
are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import materialize, slices, text_buffer, word_spans

BUCKETS = 10_000
MIN_WORDS = 20
DRAW_PERCENT = 25
SEED = 7

#: Words are runs of bytes outside 00-2F, 3A-60 and 7B-7F, after lower-casing A-Z.
_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[0x00:0x30] = _BETWEEN[0x3A:0x61] = _BETWEEN[0x7B:0x80] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()
#: Words of more bytes go through the library one by one, so that the loop over places stays short.
_LONG_WORD = 64
#: A longer text is cut into pieces of about so many bytes; neighbouring pieces share one word.
_PIECE_BYTES = 4 << 20


def _crc_on(state: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC registers after the spans' bytes, all spans one byte further at a time."""
    lengths = ends - starts
    short = np.flatnonzero(lengths <= _LONG_WORD)
    order = short[np.argsort(-lengths[short], kind="stable")]
    at, register = starts[order], state[order]
    alive = np.searchsorted(-lengths[order], -np.arange(_LONG_WORD), side="left")
    for i, n in enumerate(alive.tolist()):
        if n == 0:
            break
        register[:n] = _CRC[(register[:n] ^ raw[at[:n] + i]) & np.uint32(255)] ^ (register[:n] >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = register
    for i in np.flatnonzero(lengths > _LONG_WORD).tolist():
        out[i] = zlib.crc32(raw[starts[i]:ends[i]].tobytes(), int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return out


def word_buckets(raw: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, bucket of each word with the next one, whether that one belongs to the
    same text, index of each text's first word) of lower-cased texts that lie in a row."""
    starts, ends, first = word_spans(raw, offsets, _BETWEEN)
    fresh = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    one = _crc_on(fresh, raw, starts, ends)
    blank = _CRC[(one ^ np.uint32(32)) & np.uint32(255)] ^ (one >> np.uint32(8))
    two = np.zeros_like(one)
    two[:-1] = _crc_on(blank[:-1], raw, starts[1:], ends[1:])
    same = np.ones(len(starts), dtype=bool)
    same[first[1:][first[1:] > 0] - 1] = False  # the last word of a text
    flip = np.uint32(0xFFFFFFFF)
    return (one ^ flip).astype(np.int64) % buckets, (two ^ flip).astype(np.int64) % buckets, same, first


def _pieces(raw: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """Parts of one long text and whether a part's first word was already in the one before."""
    lo, shared = 0, False
    while True:
        size = _PIECE_BYTES
        while lo + size < len(raw):
            solid = ~_BETWEEN[raw[lo:lo + size]]
            begins = np.flatnonzero(solid & np.r_[True, ~solid[:-1]])
            if len(begins) > 2:
                break
            size *= 2  # huge words, or hardly any
        if lo + size >= len(raw):
            yield raw[lo:], shared
            return
        yield raw[lo:lo + begins[-1]], shared  # the last word may go on, the one before is whole
        lo, shared = lo + int(begins[-2]), True


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(lower-cased bytes, offsets, whether the first word was counted already) of the texts of a
    slice; of a single long text its pieces."""
    raw, offsets = text_buffer(batch.column(column))
    raw = _LOWER[raw]
    if len(offsets) == 2 and len(raw) > _PIECE_BYTES:
        for piece, shared in _pieces(raw):
            yield piece, np.array([0, len(piece)]), shared
    else:
        yield raw, offsets, False


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> dict[int, int]:
    """Features of all texts by bucket. A task counts into one array and gives a row per bucket at
    its end; at most ``buckets`` rows reach the driver. Null texts have no features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches):
            for raw, offsets, shared in _texts(batch, 0):
                one, two, same, _ = word_buckets(raw, offsets, buckets)
                counts += np.bincount(one[1:] if shared else one, minlength=buckets)
                counts += np.bincount(two[:-1][same[:-1]], minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    rows = df.select(df[text_col].cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return {r["bucket"]: r["n"] for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket ``floor(1000 * ln(share in the target / share in the source))``, smoothed by one."""
    all_source, all_target = sum(source.values()) + buckets, sum(target.values()) + buckets
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1) * all_source / ((source.get(b, 0) + 1) * all_target)))
                     for b in range(buckets)], dtype=np.int64)


def weigh(df: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row: the floored mean gain of its features."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n_words, total = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            for raw, offsets, shared in _texts(batch, 1):
                one, two, same, first = word_buckets(raw, offsets, buckets)
                value = gains[one] + np.where(same, gains[two], 0)
                if shared and len(value):
                    value[0] -= gains[one[0]]
                upto = np.r_[0, np.cumsum(value)]
                total += upto[first[1:]] - upto[first[:-1]]
                n_words += np.diff(first) - (1 if shared and len(value) else 0)
            n_features = np.maximum(2 * n_words - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features), pa.array(total // np.maximum(n_features, 1))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return (df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))


# --- the draw ---------------------------------------------------------------------------------

Key = tuple[int, int, int]
_KEY = ("ka", "kb", "kc")


def _below(key: Key, inclusive: bool = False) -> F.Column:
    left, right = F.struct(*_KEY), F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(_KEY, key, strict=True)])
    # The first part once more on its own: a filter that reaches the Parquet scan.
    return ((left <= right) if inclusive else (left < right)) & (F.col("ka") <= key[0])


def _above(key: Key) -> F.Column:
    left, right = F.struct(*_KEY), F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(_KEY, key, strict=True)])
    return (left > right) & (F.col("ka") >= key[0])


def _task_medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The middle key of a task and the number of its keys."""
    held = [[batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)] for batch in batches if batch.num_rows]
    if held:
        a, b, c = (np.concatenate(parts) for parts in zip(*held, strict=True))
        middle = np.lexsort((c, b, a))[(len(a) - 1) // 2]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a[middle:middle + 1], b[middle:middle + 1], c[middle:middle + 1], np.array([len(a)]))],
                                         names=[*_KEY, "n"])


def cutoff_key(keys: DataFrame, k: int, finish_rows: int = 1 << 14) -> Key | None:
    """The ``k``-th smallest of the distinct keys ``ka, kb, kc`` (from 1); ``None`` if there is none.

    Each round brings one row per task to the driver. At least a quarter of the remaining keys lie
    on either side of the weighted median of the tasks' medians, so at least that share is
    discarded; the last ``finish_rows`` (a bound) are read and put in order.
    """
    if k <= 0:
        return None
    left = keys.select(*_KEY)
    need = k
    while True:
        medians = sorted((r["ka"], r["kb"], r["kc"], r["n"]) for r in left.mapInArrow(_task_medians, "ka long, kb long, kc long, n long").collect())
        total = sum(m[3] for m in medians)
        if need > total:
            return None
        if total <= finish_rows:
            return tuple(sorted(tuple(r) for r in left.collect())[need - 1])
        half, seen = (total + 1) // 2, 0
        for *pivot, n in medians:
            seen += n
            if seen >= half:
                break
        pivot = tuple(pivot)
        upto = left.where(_below(pivot, inclusive=True)).count()
        if need == upto:
            return pivot
        if need < upto:
            left = left.where(_below(pivot))
        else:
            left, need = left.where(_above(pivot)), need - upto


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = DRAW_PERCENT, seed: int = SEED,
             finish_rows: int = 1 << 14) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_features, weight, score, rank``.

    Of the N rows with at least ``min_words`` words the ``percent * N // 100`` with the highest scores
    are drawn and ranked from 1, ties to the smaller id; the others have no rank. Null and empty
    texts have no features and weight 0. A null id is hashed as the text ``null`` and comes after all
    ids; rows that repeat an id take part on their own, and of rows equal in all this any may come
    first. Very long texts are scored whole, in pieces. Other columns of either table are not read;
    an empty table gives no rows, an empty target leaves the smoothing alone.
    """
    gains = bucket_gains(bucket_counts(df, text_col, buckets), bucket_counts(target, target_text_col, buckets), buckets)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), name).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = materialize(weigh(df, gains, id_col, text_col)
                         .withColumns({"score": F.col("weight") + noise, "row": F.monotonically_increasing_id()}), "resample-scores")
    last = F.lit((1 << 63) - 1)
    keys = scored.where(F.col("n_words") >= min_words).select(
        (-F.col("score")).alias("ka"), F.coalesce("doc_id", last).alias("kb"), F.col("row").alias("kc"))
    keys = materialize(keys, "resample-keys")
    cutoff = cutoff_key(keys, keys.count() * percent // 100, finish_rows)
    if cutoff is None:
        return scored.select("doc_id", "n_words", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    # Winners in ranges of the key: a rank is the rows of the ranges before and the place within.
    winners = (keys.where(_below(cutoff, inclusive=True)).repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
               .withColumn("part", F.spark_partition_id()))
    winners = materialize(winners, "resample-winners")
    sizes = winners.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select(F.col("part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*_KEY))
    ranked = (winners.withColumn("place", place).join(before, "part")
              .select(F.col("kc").alias("row"), (F.col("before") + F.col("place")).cast("long").alias("rank")))
    return scored.join(ranked, "row", "left").select("doc_id", "n_words", "n_features", "weight", "score", "rank")
