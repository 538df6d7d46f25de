"""SimHash near-dedup with bit-sliced comparison.

Fingerprints: every shingle's XXH64 votes on 64 bits. Distinct fingerprints are dealt to
buckets: with ``radius + 1`` blocks of bits, two fingerprints within the radius agree on one
block at least. Buckets beyond ``bucket_rows`` are dealt again by blocks of their remaining
bits, and what is still larger is compared tile by tile, so no bucket is capped and no link
lost. In a task the rows of a bucket lie as vertical bit planes, 64 rows to a machine word;
carry-save counters add the differing bits of a row against 64 others at once, and a block of
64 is abandoned as soon as all its distances exceed the radius. Each task returns a spanning
forest of its links, never all pairs; components come from alternating star contractions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import fresh_names, materialize, slices

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 seed: int = 42) -> DataFrame:
    """``doc_id, key_text, fp`` of every row: a hash of the text that tells rows of one id apart,
    and the fingerprint's 64 bits as a signed long.

    Words are runs of bytes other than ASCII space after lower-casing A-Z; a shingle is
    ``shingle`` of them joined by one space, repeats included; a shorter text is one shingle,
    a text without words (or null) has fingerprint zero. A bit is set if it is set in over
    half of the shingles' hashes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        digest = xxhash.xxh64_intdigest
        for batch in slices(batches):
            hashes, counts = [], []
            for text in batch.column(1).to_pylist():
                words = text.encode().lower().split() if text else []
                joined = b" ".join(words)
                ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
                if not words:
                    counts.append(0)
                elif len(words) <= shingle:
                    hashes.append(digest(joined, seed))
                    counts.append(1)
                else:
                    tails = ends[shingle - 1:]
                    heads = [0, *[e + 1 for e in ends[:len(tails) - 1]]]
                    hashes.extend([digest(joined[s:e], seed) for s, e in zip(heads, tails, strict=True)])
                    counts.append(len(tails))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(majority(np.array(hashes, dtype=np.uint64), np.array(counts)).view(np.int64))],
                names=["doc_id", "key_text", "fp"])

    rows = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    return rows.withColumn("key_text", F.xxhash64("text")).mapInArrow(run, "doc_id long, key_text long, fp long")


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` hashes the bits set in over half of them; 0 for an empty run."""
    out = np.zeros(len(counts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.cumsum(counts[some]) - counts[some]
        votes = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        won = votes * 2 > counts[some][:, None]
        out[some] = np.packbits(won, axis=1).view(">u8").astype(np.uint64).ravel()
    return out


# --- bit-sliced comparison ------------------------------------------------------------------

def bit_planes(values: np.ndarray, words: np.ndarray, lanes: np.ndarray, n_words: int) -> np.ndarray:
    """Vertical storage: bit ``lane`` of ``planes[b, word]`` is bit b of the row put there."""
    planes = np.zeros((64, n_words), dtype=np.uint64)
    if len(values) == 0:
        return planes
    edges = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    for b in range(64):
        put = ((values >> np.uint64(b)) & np.uint64(1)) << lanes
        planes[b, words[edges]] = np.bitwise_or.reduceat(put, edges)
    return planes


def _carry_save(a, b, c):
    """(sum, carry) of three bit vectors."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def within_radius(planes: np.ndarray, words: np.ndarray, values: np.ndarray, radius: int) -> np.ndarray:
    """For each pair (word, value): the lanes of the word whose rows differ from the value in
    at most ``radius`` bits, as a mask. Blocks whose lanes all exceed the radius are abandoned."""
    n_counters = max(1, int(radius).bit_length())
    result = np.zeros(len(words), dtype=np.uint64)
    alive = np.arange(len(words))
    counters = [np.zeros(len(words), dtype=np.uint64) for _ in range(n_counters)]
    beyond = np.zeros(len(words), dtype=np.uint64)

    def add(level, carry):
        nonlocal beyond
        for i in range(level, n_counters):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        beyond = beyond | carry

    def exceeded():
        over, equal = beyond.copy(), np.full(len(alive), FULL)
        for i in reversed(range(n_counters)):
            if radius >> i & 1:
                equal &= counters[i]
            else:
                over |= equal & counters[i]
                equal &= ~counters[i]
        return over

    for b in range(0, 64, 4):
        x = [planes[b + j, words] ^ (np.uint64(0) - ((values >> np.uint64(b + j)) & np.uint64(1))) for j in range(4)]
        counters[0], two = _carry_save(counters[0], x[0], x[1])
        counters[0], more = _carry_save(counters[0], x[2], x[3])
        if n_counters > 1:
            counters[1], four = _carry_save(counters[1], two, more)
            add(2, four)
        else:
            beyond = beyond | two | more
        if b % 8 == 4 and b < 60:
            keep = exceeded() != FULL
            if not keep.all():
                alive, words, values, beyond = alive[keep], words[keep], values[keep], beyond[keep]
                counters = [c[keep] for c in counters]
                if not len(alive):
                    return result
    result[alive] = ~exceeded()
    return result


def bucket_links(values: np.ndarray, buckets: np.ndarray, radius: int, left: np.ndarray | None = None,
                 pairs_at_once: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (row, smallest linked row) among rows of one bucket each; ``buckets`` is
    sorted. ``left``: rows compared with all others of their bucket (default: each row)."""
    n = len(values)
    first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    sizes = np.diff(np.r_[first, n])
    n_words = -(-sizes // 64)
    word0 = np.cumsum(n_words) - n_words
    bucket = np.repeat(np.arange(len(first)), sizes)
    place = np.arange(n) - first[bucket]
    word, lane = word0[bucket] + place // 64, (place % 64).astype(np.uint64)
    planes = bit_planes(values, word, lane, int(n_words.sum()))
    filled = np.zeros(planes.shape[1], dtype=np.uint64)
    np.bitwise_or.at(filled, word, np.uint64(1) << lane)
    # A row meets its own word and those after it: each pair is compared once.
    todo = (word0 + n_words)[bucket] - word
    label = np.arange(n)
    begin = 0
    total = np.cumsum(todo)
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + pairs_at_once, side="right")))
        rows = np.repeat(np.arange(begin, stop), todo[begin:stop])
        shift = np.arange(len(rows)) - np.repeat(np.cumsum(todo[begin:stop]) - todo[begin:stop], todo[begin:stop])
        against = word[rows] + shift
        mask = within_radius(planes, against, values[rows], radius) & filled[against]
        hit = np.flatnonzero(mask)
        bits = np.unpackbits(mask[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, lanes = np.nonzero(bits)
        word_bucket = np.searchsorted(word0, against[hit], side="right") - 1
        other = first[word_bucket[at]] + (against[hit][at] - word0[word_bucket[at]]) * 64 + lanes
        label = _join(label, rows[hit][at], other)
        begin = stop
    rows = np.flatnonzero(label != np.arange(n))
    return rows, label[rows]


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest-row labels after the links (a, b): hook roots, then follow to the roots."""
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            break
        a, b = a[differ], b[differ]
        low, high = np.minimum(x, y)[differ], np.maximum(x, y)[differ]
        np.minimum.at(label, high, low)
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt
    return label


# --- candidates, links, components ------------------------------------------------------------

def _cuts(width: int, parts: int) -> list[tuple[int, int]]:
    """``width`` bits in ``parts`` runs (low bit, length)."""
    edges = [round(i * width / parts) for i in range(parts + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def _bits(value, lo: int, length: int):
    return F.shiftrightunsigned(value, lo).bitwiseAND(F.lit((1 << length) - 1)) if length < 64 else value


def _blocks(value, width: int, parts: int, prefix=None):
    """One struct per block: which block, and the value of its bits."""
    return [F.struct(F.lit(i).alias("block"), _bits(value, lo, n).alias("bits")) for i, (lo, n) in enumerate(_cuts(width, parts))]


def _links_in_buckets(dealt: DataFrame, radius: int) -> DataFrame:
    """Links among the rows of equal ``bucket``; the partitions hold whole buckets, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(keys, values):
            rows, roots = bucket_links(values.view(np.uint64), keys, radius)
            return pa.RecordBatch.from_arrays([pa.array(values[rows]), pa.array(values[roots])], names=["a", "b"])

        held_k, held_v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys, values = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            held_k, held_v = np.r_[held_k, keys], np.r_[held_v, values]
            cut = int(np.searchsorted(held_k, held_k[-1]))  # the last bucket may go on
            if cut >= 1 << 14:
                yield emit(held_k[:cut], held_v[:cut])
                held_k, held_v = held_k[cut:], held_v[cut:]
        if len(held_k):
            yield emit(held_k, held_v)

    return dealt.repartition("bucket").sortWithinPartitions("bucket", "fp").select("bucket", "fp").mapInArrow(run, "a long, b long")


def fingerprint_links(distinct: DataFrame, radius: int = 4, bucket_rows: int = 1 << 15) -> DataFrame:
    """Links ``a, b`` (fingerprints) that connect all distinct fingerprints within ``radius``
    differing bits of each other; transitively the same as all such pairs."""
    parts = radius + 1
    if parts >= 64:
        raise ValueError("the radius must be below 63")
    dealt = (distinct.select("fp", F.explode(F.array(*_blocks(F.col("fp"), 64, parts))).alias("k"))
             .select("fp", F.col("k.block").alias("block"), F.col("k.bits").alias("bits")))
    large = dealt.groupBy("block", "bits").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows).select("block", "bits")
    large = materialize(large, "simhash-large")
    links = None
    plain = dealt
    if not large.isEmpty():
        plain = dealt.join(large, ["block", "bits"], "left_anti")
        again = dealt.join(large, ["block", "bits"])
        rest_parts = []
        for i, (lo, n) in enumerate(_cuts(64, parts)):  # the bits outside block i, moved together
            low = _bits(F.col("fp"), 0, lo) if lo else F.lit(0).cast("long")
            high = F.shiftleft(F.shiftrightunsigned("fp", lo + n), lo) if lo + n < 64 else F.lit(0).cast("long")
            rest_parts.append(F.when(F.col("block") == i, F.array(*[
                F.struct(F.lit(j).alias("sub"), _bits(low.bitwiseOR(high), l2, n2).alias("sub_bits"))
                for j, (l2, n2) in enumerate(_cuts(64 - n, parts))])))
        finer = (again.select("fp", "block", "bits", F.explode(F.coalesce(*rest_parts)).alias("s"))
                 .select("fp", "block", "bits", "s.sub", "s.sub_bits"))
        key = ["block", "bits", "sub", "sub_bits"]
        tiles = (finer.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows)
                 .select(*key, F.ceil(F.col("n") / bucket_rows).cast("int").alias("tiles")))
        sized = finer.join(tiles, key, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
        # Tile (i, j) holds parts i and j: every pair of parts meets in one tile.
        tiled = (sized.withColumn("mine", mine)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
                 .select("fp", F.xxhash64(*key, F.least("mine", "other"), F.greatest("mine", "other")).alias("bucket")))
        links = _links_in_buckets(tiled, radius)
    small = _links_in_buckets(plain.select("fp", F.xxhash64("block", "bits").alias("bucket")), radius)
    return (small.unionByName(links) if links is not None else small).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root``: for each node of the links ``a, b`` the smallest node it reaches.

    Alternates large-star (neighbours above a node move to its smallest neighbour) and
    small-star (those at or below it do) until nothing changes; each round is written to the
    shared folder. A hub's neighbours are aggregated before the shuffle and joined by a sort
    merge join whose large partitions Spark can split.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, "cc")
        sign = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == seen:
            break
        seen = sign
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       radius: int = 4, seed: int = 42, bucket_rows: int = 1 << 15) -> DataFrame:
    """One row per input row: ``doc_id, key_text, fp, root, component_id``, the smallest fingerprint and the
    smallest id among all rows that links of at most ``radius`` differing bits reach (the row itself included).

    Equal fingerprints are one node, so copies cost nothing; null and empty texts share the
    fingerprint zero, which links like any other. A null id never names a component unless all
    its ids are null; repeated rows keep one output row each; an empty table gives none.
    """
    rows = materialize(fingerprints(df, id_col, text_col, shingle, seed), "simhash")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "simhash-nodes")
    found = components(fingerprint_links(nodes.select("fp"), radius, bucket_rows))
    named = (nodes.join(found, nodes["fp"] == found["node"], "left")
             .select("fp", "low_id", F.coalesce("root", "fp").alias("root")))
    smallest = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    of_fp = named.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(of_fp, "fp").select("doc_id", "key_text", "fp", "root", "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of ``df`` per component, with all its columns: the one with the smallest id, then
    the smallest text hash; of rows repeated in id and text one. Null, empty and very long texts as
    in ``simhash_components``; columns of any name keep their values."""
    key, text = fresh_names(df, "_id", "_text")
    rows = simhash_components(df, id_col, text_col, **how)
    # A component is told by its root: an id may occur in several components, or in none.
    first = (rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("root", F.col("component_id").alias(key))
             .agg(F.min("key_text").alias(text)).select(key, text))
    keyed = df.withColumns({key: df[id_col].cast("long"), text: F.xxhash64(df[text_col].cast("string"))})
    same = keyed[key].eqNullSafe(first[key]) & (keyed[text] == first[text])
    return keyed.join(first, same, "left_semi").dropDuplicates([key, text]).select(*df.columns)


def near_duplicates(df: DataFrame, **how) -> DataFrame:
    """``doc_id, fingerprint, component_id`` with the fingerprint as 16 lower-case hex digits."""
    return simhash_components(df, **how).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
