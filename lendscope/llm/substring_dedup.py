"""Substring dedup with prefix-partitioned suffix trees over words.

Every window of ``min_words`` words is a suffix cut at that depth. Suffixes are grouped by a
prefix: the ``k`` words at the window's anchor, the place in it where the hash of ``k`` words is
smallest. Equal windows have equal anchors at equal offsets, and the windows around one anchor
lie side by side, so a run of them travels as one piece of text. Anchors that occur once have a
subtree of one leaf and are dropped before any text moves. The others are dealt into groups
that fit in memory; a prefix with more than ``group_pieces`` different pieces is lengthened to
the whole window, at which depth its subtree is a single node and a distributed count does.
In a group the suffixes are sorted by doubling ranks, and the nodes of the tree at full depth
with two leaves or more are the repeats; covered words are removed from their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import SpanHasher, doc_key, materialize, mix64, slices, text_buffer, word_spans

ANCHOR_WORDS = 8
_STEP = 0xD6E8FEB86659FD93
_UP: list[np.ndarray] = []


def _word_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _UP or len(_UP[0]) < n:
        size = 1 << max(16, n.bit_length())
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            _UP.append(table)
        del _UP[:-2]
    return _UP[0], _UP[1]


class RunHasher:
    """64-bit hashes of runs of words, from running sums over the words' own hashes."""

    def __init__(self, words: np.ndarray):
        up, self.down = _word_powers(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * up[:len(words)], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


def _anchor_words(min_words: int) -> int:
    """Words of the prefix: ``ANCHOR_WORDS``, or as many as keep an anchor's windows within 62."""
    return max(min(ANCHOR_WORDS, min_words), min_words - 61)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values (one entry per full window)."""
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:len(least) - reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def pieces_of(words: np.ndarray, first: np.ndarray, min_words: int):
    """Pieces of a slice of documents: (document, first word in the slice, windows, prefix hash,
    hash of all the piece's words). Windows that share their anchor form a piece."""
    k = _anchor_words(min_words)
    width = min_words - k + 1
    n = len(words)
    empty = np.zeros(0, dtype=np.int64)
    if n < min_words:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    run = RunHasher(words)
    at = np.arange(n - k + 1)
    prefix = run(at, at + k)
    # The place in the low half: of equal hashes the leftmost wins, as in any equal window.
    least = sliding_least((prefix & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), width)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[:len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + min_words <= first[owner + 1])
    if not len(starts):
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(starts) != 1)])
    begin, count = starts[edge], np.diff(np.r_[edge, len(starts)])
    return owner[begin], begin, count, prefix[anchor[edge]], run(begin, begin + count + min_words - 1)


def _words(batch_text: pa.Array):
    raw, offsets = text_buffer(batch_text)
    starts, ends, first = word_spans(raw, offsets)
    return SpanHasher(raw)(starts, ends), first


def _find_pieces(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        hashes, first = _words(batch.column(batch.schema.get_field_index("text")))
        owner, begin, count, prefix, content = pieces_of(hashes, first, min_words)
        rows = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [pa.array(prefix.view(np.int64)), pa.array(content.view(np.int64)),
             batch.column(batch.schema.get_field_index("key_id")).take(rows),
             batch.column(batch.schema.get_field_index("key_text")).take(rows),
             pa.array((begin - first[owner]).astype(np.int32)), pa.array(count.astype(np.int32))],
            names=["prefix", "content", "key_id", "key_text", "begin", "windows"])


_TEXT = pa.schema([("prefix", pa.int64()), ("content", pa.int64()), ("copies", pa.int64()), ("windows", pa.int32()),
                   ("piece", pa.binary()), ("place", pa.int32()), ("window1", pa.int64()), ("window2", pa.int64())])
_TEXT_SQL = ("prefix long, content long, copies long, windows int, piece binary, place int, window1 long, window2 long")


def _fetch(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """The text of the wanted pieces; for lengthened prefixes two hashes of each window."""
    for batch in slices(batches):
        out: list[tuple] = []
        wanted = batch.column(batch.schema.get_field_index("wanted")).to_pylist()
        for text, pieces in zip(batch.column(batch.schema.get_field_index("text")).to_pylist(), wanted, strict=True):
            words = text.encode().split()
            hashers = None
            for p in pieces:
                begin, windows = p["begin"], p["windows"]
                if not p["long"]:
                    piece = b" ".join(words[begin:begin + windows + min_words - 1])
                    out.append((p["prefix"], p["content"], p["copies"], windows, piece, None, None, None))
                    continue
                if hashers is None:
                    own, _ = _words(pa.array([text], pa.string()))
                    hashers = RunHasher(own), RunHasher(mix64(own + np.uint64(1)))
                at = np.arange(begin, begin + windows)
                one, two = (h(at, at + min_words).view(np.int64).tolist() for h in hashers)
                out += [(p["prefix"], p["content"], p["copies"], windows, None, i, a, b) for i, (a, b) in enumerate(zip(one, two, strict=True))]
                if len(out) > 1 << 16:
                    yield _rows(out)
                    out = []
        if out:
            yield _rows(out)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TEXT.types, strict=True)], schema=_TEXT)


def subtree_repeats(pieces: list[bytes], windows: np.ndarray, copies: np.ndarray, prefixes: np.ndarray, min_words: int) -> np.ndarray:
    """For each piece a mask of its windows that are leaves of a node at depth ``min_words`` with
    two occurrences or more, in the subtrees of the pieces' prefixes.

    Ranks of suffixes cut at 1, 2, 4, ... words are the tree's nodes at those depths; the last
    rank, at full depth, comes from two overlapping ones.
    """
    names: dict[bytes, int] = {}
    split = [p.split() for p in pieces]
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    rank = np.array([names.setdefault(w, len(names)) for s in split for w in s], dtype=np.int64)
    depth = 1

    def deepen(rank, shift):
        pair = rank[:len(rank) - shift] * (int(rank.max()) + 1) + rank[shift:]
        return np.unique(pair, return_inverse=True)[1]

    while 2 * depth <= min_words:
        rank = deepen(rank, depth)
        depth *= 2
    if depth < min_words:
        rank = deepen(rank, min_words - depth)
    owner = np.repeat(np.arange(len(pieces)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    leaf = rank[(np.cumsum(sizes) - sizes)[owner] + place]
    _, node = np.unique(np.stack([prefixes[owner], leaf]), axis=1, return_inverse=True)
    leaves = np.bincount(node.ravel(), weights=copies[owner])
    repeated = leaves[node.ravel()] >= 2
    mask = np.zeros(len(pieces), dtype=np.int64)
    np.bitwise_or.at(mask, owner[repeated], np.int64(1) << place[repeated])
    return mask


def _subtrees(batches: Iterator[pa.RecordBatch], min_words: int, group_words: int) -> Iterator[pa.RecordBatch]:
    """Builds the subtrees of whole prefixes, as many at a time as fit ``group_words``; the rows
    come sorted by prefix and content."""
    held: list[tuple] = []
    size = 0

    def build(rows):
        prefix, content, copies, windows, pieces = zip(*rows, strict=True)
        mask = subtree_repeats(list(pieces), np.array(windows), np.array(copies), np.array(prefix), min_words)
        some = np.flatnonzero(mask)
        return pa.RecordBatch.from_arrays([pa.array(np.array(prefix)[some]), pa.array(np.array(content)[some]), pa.array(mask[some])],
                                          names=["prefix", "content", "mask"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if held and row[0] != held[-1][0] and size >= group_words:
                yield build(held)
                held, size = [], 0
            if held and row[:2] == held[-1][:2]:
                continue  # the same piece fetched from a repeated row
            held.append(row)
            size += row[3] + min_words
    if held:
        yield build(held)


def repeated_windows(docs: DataFrame, min_words: int, group_pieces: int = 2048, group_words: int = 1 << 18) -> DataFrame:
    """``key_id, key_text, found``: for each document with a repeated window an array of
    (begin, mask): bit i says that the window at word ``begin + i`` occurs elsewhere too.

    ``docs`` has ``doc_id, key_id, key_text, text``.
    """
    pieces = docs.mapInArrow(lambda it: _find_pieces(it, min_words),
                             "prefix long, content long, key_id long, key_text long, begin int, windows int")
    pieces = materialize(pieces, "substring-pieces")
    # Counts and joins are written in turn: a join whose two sides are plain exchanges can have its
    # large partitions split, one with an aggregate on top or below can't.
    often = materialize(pieces.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1").select("prefix"), "substring-often")
    kept = materialize(pieces.join(often, "prefix"), "substring-kept")
    different = kept.groupBy("prefix", "content").agg(
        F.count("*").alias("copies"), F.first("key_id").alias("key_id"), F.first("key_text").alias("key_text"),
        F.first("begin").alias("begin"), F.first("windows").alias("windows"))
    different = materialize(different, "substring-different")
    per_prefix = materialize(different.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1"), "substring-sizes")
    sized = different.join(per_prefix, "prefix")
    item = F.struct("prefix", "content", "copies", "begin", "windows", (F.col("n") > group_pieces).alias("long"))
    wanted = sized.groupBy("key_id", "key_text").agg(F.collect_list(item).alias("wanted"))
    fetched = docs.join(wanted, ["key_id", "key_text"]).mapInArrow(lambda it: _fetch(it, min_words), _TEXT_SQL)
    fetched = materialize(fetched, "substring-fetched")
    short = (fetched.where("piece IS NOT NULL").select("prefix", "content", "copies", "windows", "piece")
             .repartition("prefix").sortWithinPartitions("prefix", "content")
             .mapInArrow(lambda it: _subtrees(it, min_words, group_words), "prefix long, content long, mask long"))
    key = ["prefix", "window1", "window2"]
    windows = fetched.where("piece IS NULL").select("content", "copies", "place", *key).dropDuplicates(["content", "place", *key])
    twice = windows.groupBy(*key).agg(F.sum("copies").alias("n")).where("n > 1").select(*key)
    long = (windows.join(twice, key).groupBy("prefix", "content")
            .agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask")))
    masks = short.unionByName(long)
    everything = F.expr("shiftleft(1L, windows) - 1")
    result = (different.join(masks, ["prefix", "content"], "left")
              .select("prefix", "content", F.when(F.col("copies") > 1, everything).otherwise(F.col("mask")).alias("mask"))
              .where("mask <> 0"))
    result = materialize(result, "substring-result")
    return (kept.join(result, ["prefix", "content"]).groupBy("key_id", "key_text")
            .agg(F.collect_list(F.struct("begin", "mask")).alias("found")))


def _remove(batches: Iterator[pa.RecordBatch], min_words: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        column = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names) if n in ("text", "found")}
        n_words, n_removed, digests, texts, spans = [], [], [], [], []
        for text, found in zip(column["text"], column["found"], strict=True):
            words = text.encode().split()
            covered = np.zeros(len(words) + 1, dtype=np.int64)
            for f in found or ():
                mask = f["mask"]
                starts = np.array([f["begin"] + i for i in range(mask.bit_length()) if mask >> i & 1])
                np.add.at(covered, starts, 1)
                np.add.at(covered, starts + min_words, -1)
            gone = np.cumsum(covered)[:-1] > 0
            edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
            if len(edges):
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            kept = b" ".join(words)
            n_words.append(len(gone))
            n_removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(kept).hexdigest())
            spans.append([{"begin": b, "end": e} for b, e in edges.reshape(-1, 2).tolist()])
            texts.append(kept.decode() if with_text else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("doc_id")), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(digests, pa.string()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
             pa.array(texts, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed", "kept_text"])


def substring_dedup(df: DataFrame, min_words: int = 35, id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = False, **sizes) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256, removed, kept_text``.

    A word goes if a window of ``min_words`` words that covers it starts anywhere else too, the
    same document included; ``removed`` are the maximal runs of such words as (begin, end) word
    numbers. Windows are judged on the input. ``kept_text`` (only ``with_text``) joins the kept
    words with one space. Null text has no words; documents shorter than a window keep all of
    theirs; rows repeated in id and text count as occurrences of each other; null ids are kept;
    an empty table gives no rows.
    """
    if min_words < 2:
        raise ValueError("a window has two words at least")
    docs = (df.select(df[id_col].cast("long").alias("doc_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))
            .select("doc_id", *doc_key("doc_id", "text"), "text"))
    found = repeated_windows(docs, min_words, **sizes)
    return docs.join(found, ["key_id", "key_text"], "left").mapInArrow(
        lambda it: _remove(it, min_words, with_text),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<begin:long,end:long>>, kept_text string")
