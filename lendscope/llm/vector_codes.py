"""Vector codes: each of a vector's parts is replaced by its nearest codebook entry.

Components become integers, so distances are exact. The nearest entry comes from slicing and
intersecting bitmasks: for every dimension the entries lie in the order of their coordinate, and a
prefix mask tells which entries the first i of them are. A radius around a value selects a range of
that order, whose entries are the difference of two prefix masks; the masks of all dimensions ANDed
as 64-bit words leave the candidates, and only these are measured. An entry nearer than the radius
lies in every range, so a candidate within it settles the search with all its ties; otherwise the
radius grows to the distance found, or doubles if there was no candidate.

Codebooks are bounded by a parameter, so a round (assign, sum by entry, replace) sends the tasks one
small table and brings one back, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import materialize

ENTRIES = 256
PARTS = 4
ROUNDS = 4
SCALE = 1024
#: Integers beyond this count as this, so that sums of squares fit in 64 bits up to 4,096 dimensions.
LIMIT = 1 << 24

_CHUNK = 2048


class Slicer:
    """Search among the entries of one part (``book``: entries x dimensions, integers)."""

    def __init__(self, book: np.ndarray):
        self.book = np.ascontiguousarray(book, dtype=np.int64)
        n, width = self.book.shape
        words = -(-n // 64)
        order = np.argsort(self.book, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.book, order, axis=0)
        self.prefix = []
        for d in range(width):
            single = np.zeros((n + 1, words), dtype=np.uint64)
            single[np.arange(1, n + 1), order[:, d] // 64] = np.uint64(1) << (order[:, d] % 64).astype(np.uint64)
            self.prefix.append(np.bitwise_or.accumulate(single, axis=0))
        self.all = np.zeros(words, dtype=np.uint64)
        np.bitwise_or.at(self.all, np.arange(n) // 64, np.uint64(1) << (np.arange(n) % 64).astype(np.uint64))

    def candidates(self, rows: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry) of every entry within ``radius`` of the row in each dimension, by row."""
        mask = np.repeat(self.all[None, :], len(rows), axis=0)
        for d, prefix in enumerate(self.prefix):
            coordinate = np.ascontiguousarray(self.sorted[:, d])
            lo = np.searchsorted(coordinate, rows[:, d] - radius, side="left")
            hi = np.searchsorted(coordinate, rows[:, d] + radius, side="right")
            mask &= prefix[hi] ^ prefix[lo]
        bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        return np.nonzero(bits)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for each row; ties go to the lower entry."""
        entry, distance = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        if not len(rows):
            return entry, distance
        some = rows[:: max(1, len(rows) // 16)][:16]
        near = ((some[:, None, :] - self.book[None]) ** 2).sum(2).min(1)
        radius = np.full(len(rows), math.isqrt(int(np.sort(near)[len(near) * 3 // 4])) + 1, dtype=np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            x, r = rows[todo], radius[todo]
            row, found = self.candidates(x, r)
            d = ((x[row] - self.book[found]) ** 2).sum(1)
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][:len(row)])
            has = row[first]
            best = np.minimum.reduceat(d, first) if len(first) else d
            ties = np.flatnonzero(d == np.repeat(best, np.diff(np.r_[first, len(row)])))
            low = ties[np.r_[True, row[ties][1:] != row[ties][:-1]][:len(ties)]]  # entries ascend within a row
            settled = best <= r[has] ** 2
            entry[todo[has[settled]]], distance[todo[has[settled]]] = found[low][settled], best[settled]
            wider = 2 * r
            wider[has] = np.ceil(np.sqrt(best)).astype(np.int64) + 1
            radius[todo] = wider
            left = np.ones(len(todo), dtype=bool)
            left[has[settled]] = False
            todo = todo[left]
        return entry, distance


def _bounds(width: int, parts: int) -> list[int]:
    return [i * width // parts for i in range(parts + 1)]


def _vectors(batch: pa.RecordBatch, column: int, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, width)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _CHUNK):
            yield batch.slice(at, _CHUNK)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, q``: rows whose vector has no null and only finite components, each the
    integer ``floor(scale * x)``."""
    raw = df.select(df[id_col].cast("long").alias("vec_id"), df[label_col].alias("label"), df[vector_col].cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    bounded = lambda x: F.floor(F.least(F.greatest(x * float(scale), F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("int")
    return raw.where(F.col("v").isNotNull() & whole).select("vec_id", "label", F.transform("v", bounded).alias("q"))


def _sums(kept: DataFrame, books: list[np.ndarray], bounds: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each part (rows by entry, component sums by entry) of an assignment of all vectors."""
    width, n = bounds[-1], len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slicers = [Slicer(b) for b in books]
        count = np.zeros((len(books), n), dtype=np.int64)
        total = np.zeros((n, width), dtype=np.int64)
        for batch in _chunks(batches):
            rows = _vectors(batch, 0, width)
            for p, slicer in enumerate(slicers):
                part = rows[:, bounds[p]:bounds[p + 1]]
                entry, _ = slicer.nearest(part)
                count[p] += np.bincount(entry, minlength=n)
                np.add.at(total[:, bounds[p]:bounds[p + 1]], entry, part)
        flat = np.r_[count.ravel(), total.ravel()]
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], names=["slot", "value"])

    # At most entries x (parts + dimensions) rows.
    table = kept.select("q").mapInArrow(run, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
    flat = np.zeros(len(books) * n + n * width, dtype=np.int64)
    flat[table["slot"].to_numpy()] = table["value"].to_numpy()
    count, total = flat[:len(books) * n].reshape(len(books), n), flat[len(books) * n:].reshape(n, width)
    return [(count[p], total[:, bounds[p]:bounds[p + 1]]) for p in range(len(books))]


def train_codebooks(kept: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of every part after ``rounds`` of assigning all vectors of ``kept`` and moving
    each used entry to the floored mean of its parts, from the ``entries`` smallest ids on."""
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "q").select("q").limit(entries).collect()
    start = np.array([r["q"] for r in first], dtype=np.int64).reshape(len(first), -1)
    bounds = _bounds(start.shape[1], parts)
    books = [start[:, lo:hi] for lo, hi in zip(bounds, bounds[1:], strict=False)]
    for _ in range(rounds):
        books = [np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], book)
                 for book, (count, total) in zip(books, _sums(kept, books, bounds), strict=True)]
    return books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def encode(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per usable vector: ``vec_id, code, error, label_error, codebooks_sha256``.

    ``code`` has two hex digits for each part, ``error`` the squared distances to the entries summed
    over the parts, ``label_error`` the errors of all rows with an equal label (nulls together).
    Rows whose vector is null or holds a null or non-finite component are dropped, and so are rows
    whose vector has another length than most (ties: the longer length); scaled components beyond
    2^24 count as that. Parts differ by one component at most where the length doesn't divide. Null
    ids sort last; repeated ids sort by their vector; repeated rows keep one row each. With fewer
    vectors than ``entries`` the codebooks have as many entries as vectors. Other columns are not
    read; no usable vector gives no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    kept = materialize(integer_vectors(df, id_col, vector_col, label_col, scale), "codes-vectors")
    schema = f"vec_id long, label {kept.schema['label'].dataType.simpleString()}, code string, error long"
    usual = kept.groupBy(F.size("q").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if usual is None:
        return df.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    kept = kept.where(F.size("q") == usual["width"])
    books = train_codebooks(kept, entries, parts, rounds)
    bounds = _bounds(usual["width"], parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slicers = [Slicer(b) for b in books]
        for batch in _chunks(batches):
            rows = _vectors(batch, 2, bounds[-1])
            found = [s.nearest(rows[:, lo:hi]) for s, lo, hi in zip(slicers, bounds, bounds[1:], strict=False)]
            digits = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            step = 2 * parts
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([digits[i:i + step] for i in range(0, len(digits), step)], pa.string()),
                 pa.array(sum(d for _, d in found))], names=["vec_id", "label", "code", "error"])

    coded = materialize(kept.select("vec_id", "label", "q").mapInArrow(run, schema), "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")))


def _oracle(entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL of the same codes: all distances of every round."""
    def assigned(i):
        return (f"a{i} AS MATERIALIZED (SELECT x.rid, x.p, any_value(x.v) AS v, min(CAST(list_dot_product(x.v, x.v) "
                f"- 2 * list_dot_product(x.v, c.v) + list_dot_product(c.v, c.v) AS HUGEINT) * {entries} + c.e) AS best "
                f"FROM parts x JOIN c{i} c ON x.p = c.p GROUP BY x.rid, x.p)")

    def moved(i):
        return (f"m{i} AS (SELECT p, best % {entries} AS e, j, floor(sum(v[j]) / count(*)) AS m FROM a{i - 1}, w, "
                f"unnest(range(1, w.w + 1)) AS t(j) GROUP BY ALL), "
                f"c{i} AS MATERIALIZED (SELECT c.p, c.e, coalesce(n.v, c.v) AS v FROM c{i - 1} c LEFT JOIN "
                f"(SELECT p, e, list(m ORDER BY j) AS v FROM m{i} GROUP BY p, e) n ON n.p = c.p AND n.e = c.e)")

    steps = ", ".join(f"{assigned(i)}, {moved(i + 1)}" for i in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
         [floor({scale} * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
w AS (SELECT any_value(len(q)) // {parts} AS w FROM kept),
parts AS MATERIALIZED (SELECT rid, p, q[p * w.w + 1:(p + 1) * w.w] AS v FROM kept, w, unnest(range({parts})) AS t(p)),
c0 AS MATERIALIZED (SELECT p, rid - 1 AS e, v FROM parts WHERE rid <= {entries}), {steps}, {assigned(rounds)},
coded AS (SELECT rid, string_agg(format('{{:02x}}', CAST(best % {entries} AS INTEGER)), '' ORDER BY p) AS code,
          CAST(sum(best // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY rid),
digest AS (SELECT sha256(string_agg(CAST(CAST(v[j] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS d
           FROM c{rounds}, w, unnest(range(1, w.w + 1)) AS t(j))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256
FROM coded JOIN kept USING (rid), digest
"""


ORACLE = _oracle()
