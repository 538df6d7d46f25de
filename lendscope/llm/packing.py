"""Packing documents into token windows by best-fit decreasing.

Overlong documents are first cut into full windows. What best-fit decreasing does with the
rest depends on the lengths alone, so it runs on the histogram of lengths (at most one entry
per window size): a segment tree over remaining capacities finds the tightest open window,
and equal pieces meeting equal windows are placed in one step. The outcome is a plan of rank
ranges per length, whose size is bounded by the window size and not by the corpus; each piece
finds its place by its rank among pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import materialize, slices
from lendscope.llm.tokens import document_ids

WINDOW_TOKENS = 4096


class CapacityTree:
    """Segment tree indexed by remaining capacity; leaves count the open windows."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.base)

    def add(self, capacity: int, n: int) -> None:
        at = self.base + capacity
        while at:
            self.counts[at] += n
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that has an open window."""
        at = self.base + length
        if self.counts[at]:
            return length
        while at > 1:  # climb to the first subtree on the right that holds a window
            if at & 1 == 0 and self.counts[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.base:
            at = 2 * at if self.counts[2 * at] else 2 * at + 1
        return at - self.base


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """The plan ``(length, first rank, first window, pieces per window, offset)``, sorted by
    length and rank: pieces from that rank on fill windows in order, that many in each.

    Places what piece-by-piece best-fit decreasing would: a window that took a piece and still
    has room for another of the same length is the tightest, so it is filled first.
    """
    tree, open_windows, plan, windows = CapacityTree(capacity), {}, [], 0

    def put(capacity_left: int, first: int, n: int) -> None:
        if capacity_left and n:
            open_windows.setdefault(capacity_left, []).append((first, n))
            tree.add(capacity_left, n)

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                first, n = windows, -(-left // each)
                windows += n
            else:
                each = room // length
                first, n = open_windows[room].pop()
                tree.add(room, -n)
            full = min(n, left // each)
            if full:
                plan.append((length, rank, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # fewer than ``each`` remain: one window takes them
                plan.append((length, rank, first + full, each, capacity - room))
                put(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(room, first + full, n - full)
    return sorted(plan)


def cut_documents(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                  capacity: int = WINDOW_TOKENS) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens``: full windows, then the rest."""
    last = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = 4 * capacity
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), document_ids(path, batch.column(1).to_pylist()), strict=True):
                ids += last
                for at in range(0, len(ids), step):
                    part = ids[at:at + step]
                    rows.append((doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return (df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"))


def pack(df: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = WINDOW_TOKENS, rank_rows: int = 4096) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every document is its token ids and ``end_id``; each id lies in exactly one piece; the
    pieces of a sequence lie side by side from 0. A null or empty text is its end id alone.
    Ranks within a length come from hashed parts of about ``rank_rows`` pieces, so a length
    that many documents share is not ranked in one task. Rows with null or repeated ids are
    documents of their own; an empty table gives no rows.
    """
    pieces = materialize(cut_documents(df, path, end_id, id_col, text_col, capacity), "pack-pieces")
    parts = max(1, -(-pieces.count() // rank_rows))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts)))
    by_part = materialize(dealt.groupBy("length", "part").agg(F.count("*").alias("n")), "pack-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # At most one row per length up to the window size.
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(best_fit_decreasing(histogram, capacity) or np.zeros((0, 5)), dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = (plan[:, 0] << 48) + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(order, (length << 48) + rank, side="right") - 1
            inside = rank - plan[at, 1]
            sequence = plan[at, 2] + inside // plan[at, 3]
            offset = plan[at, 4] + inside % plan[at, 3] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                                             names=[*batch.schema.names[:5], "sequence_id", "offset"])

    local = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = (dealt.withColumn("local", local).join(starts, ["length", "part"])
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("local")).alias("rank")))
    return ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long")
