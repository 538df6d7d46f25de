"""Shared helpers: layers in the shared folder, slices of Arrow batches, words as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.session import materialize

__all__ = ["ASCII_SPACE", "WORD_PATTERN", "SpanHasher", "doc_key", "fresh_names", "materialize", "mix64", "slices", "text_buffer", "word_spans"]

#: The six ASCII characters that separate words, ``[\x20\x09-\x0D]``.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[ord(c) for c in ASCII_SPACE]] = True


def slices(batches: Iterator[pa.RecordBatch], text_col: str = "text",
           max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``max_bytes`` of text (one document
    at least), which bounds the working arrays whatever the batch size."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text_col))
        ends = _offsets(column)[1:]
        start = 0
        while start < n:
            base = ends[start - 1] if start else _offsets(column)[0]
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(column.buffers()[1], dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, offsets with one more entry than texts); null is empty."""
    if column.null_count:
        column = column.fill_null("")
    offsets = _offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray, between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of every word, and for each text the index of its first
    word (one more entry than texts). A word ends where its text ends. ``between``: for each
    byte value whether it separates words."""
    solid = np.empty(len(raw) + 2, dtype=np.int8)
    solid[0] = solid[-1] = 0
    solid[1:-1] = ~between[raw]
    begins = (solid[1:] > solid[:-1])[:len(raw)]
    finishes = (solid[:-1] > solid[1:])
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    joined = inner[(solid[inner] == 1) & (solid[inner + 1] == 1)]  # solid is shifted by one
    begins[joined] = True
    finishes[joined] = True
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes)
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of a splitmix generator: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = (_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size))
    return _POWERS[size]


class SpanHasher:
    """64-bit hashes of byte spans: a polynomial modulo 2^64 read off running sums, shifted back
    by the inverse power, then mixed. Equal bytes get equal hashes wherever they lie."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _power_tables(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def fresh_names(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` does not have yet (whatever their case), one for each stem."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        while stem.lower() in taken:
            stem = "_" + stem
        taken.add(stem.lower())
        out.append(stem)
    return out


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two columns that tell rows apart: the id (null as the smallest long) and a hash of the
    text. Rows that agree in both are repeats of each other and get the same answers."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("key_id"),
            F.xxhash64(F.col(text_col)).alias("key_text")]
