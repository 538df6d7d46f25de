"""k-means for many k at once: every pass over the data serves all of them.

The centres of all runs lie in one table. A task measures its rows against the whole table by one
matrix product and returns, for each centre, how many rows chose it, their sum and their squared
distances; the driver holds nothing but centres. A run whose centres stand still leaves the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from lendscope.operators.rows import hash_bits
from lendscope.session import materialize

#: Rows that the starting centres are drawn from (a bound on what the driver reads).
START_ROWS = 2048
_CHUNK = 4096


def as_arrays(df: DataFrame, features: str, key: str = "id") -> DataFrame:
    """``key, x``: the feature vectors as arrays, written once for all passes."""
    return materialize(df.select(F.col(key).alias("key"), vector_to_array(F.col(features)).alias("x")), "sweep")


def starting_centres(rows: DataFrame, k: int, seed: int = 2, start_rows: int = START_ROWS) -> np.ndarray:
    """``k`` centres by k-means++ (the next one drawn by squared distance to those so far) among the
    ``start_rows`` rows with the smallest hash of their key; the first j of them serve a run of j."""
    sample = rows.select(hash_bits("key", seed).alias("h"), "key", "x").orderBy("h", "key").limit(start_rows).collect()
    x = np.array([r["x"] for r in sample], dtype=float)
    rng = np.random.default_rng(seed)
    chosen = [x[rng.integers(len(x))]]
    nearest = ((x - chosen[0]) ** 2).sum(1)
    while len(chosen) < k:
        total = nearest.sum()
        pick = rng.choice(len(x), p=nearest / total) if total > 0 else rng.integers(len(x))
        chosen.append(x[pick])
        nearest = np.minimum(nearest, ((x - x[pick]) ** 2).sum(1))
    return np.array(chosen)


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
        for at in range(0, batch.num_rows, _CHUNK):
            yield values[at:at + _CHUNK]


def pass_over(rows: DataFrame, runs: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """One pass over ``rows`` for all ``runs`` (k -> centres): for each k the rows per centre, their
    sums, and the squared distances to the nearest centres in all."""
    ks = sorted(runs)
    table = np.concatenate([runs[k] for k in ks])
    edges = np.cumsum([0, *ks])
    n, width = table.shape
    middle = table.mean(0)  # distances by products lose less when the origin lies among the data
    moved = table - middle
    norms = (moved ** 2).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, cost = np.zeros(n), np.zeros((n, width)), np.zeros(len(ks))
        for x in _batches(batches, width):
            y = x - middle
            apart = norms - 2 * (y @ moved.T)
            own = (y ** 2).sum(1)
            for j in range(len(ks)):
                part = apart[:, edges[j]:edges[j + 1]]
                best = part.argmin(1)
                cost[j] += np.maximum(part[np.arange(len(x)), best] + own, 0).sum()
                count[edges[j]:edges[j + 1]] += np.bincount(best, minlength=ks[j])
                order = np.argsort(best, kind="stable")
                first = np.flatnonzero(np.r_[True, np.diff(best[order]) > 0])
                total[edges[j] + best[order][first]] += np.add.reduceat(x[order], first, axis=0)
        flat = np.r_[count, cost, total.ravel()]
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], names=["slot", "value"])

    # At most (centres of all runs) x (dimensions + 1) rows.
    sums = rows.select("x").mapInArrow(run, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
    flat = np.zeros(n + len(ks) + n * width)
    flat[sums["slot"].to_numpy()] = sums["value"].to_numpy()
    count, cost, total = flat[:n], flat[n:n + len(ks)], flat[n + len(ks):].reshape(n, width)
    return {k: (count[edges[j]:edges[j + 1]], total[edges[j]:edges[j + 1]], float(cost[j])) for j, k in enumerate(ks)}


def sweep_kmeans(rows: DataFrame, ks: Sequence[int], seed: int = 2, max_iter: int = 20, tol: float = 1e-4,
                 start_rows: int = START_ROWS) -> dict[int, tuple[np.ndarray, float]]:
    """(centres, within-cluster sum of squares) for every k, all runs in lockstep.

    ``rows``: ``key, x`` of :func:`as_arrays`. A centre that no row chose stays. A run stops when no
    centre moves by more than ``tol`` or after ``max_iter`` rounds; one more pass gives the sums of
    squares of the final centres. No rows: no runs.
    """
    if rows.isEmpty():
        return {}
    starts = starting_centres(rows, max(ks), seed, start_rows)
    centres = {k: starts[:k] for k in ks}
    open_runs = dict(centres)
    for _ in range(max_iter):
        if not open_runs:
            break
        for k, (count, total, _) in pass_over(rows, open_runs).items():
            new = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres[k])
            still = ((new - centres[k]) ** 2).sum(1).max() <= tol ** 2
            centres[k] = open_runs[k] = new
            if still:
                del open_runs[k]
    return {k: (centres[k], cost) for k, (_, _, cost) in pass_over(rows, centres).items()}


def elbow_sweep(spark: SparkSession, df: DataFrame, ks: Sequence[int], features: str = "features_scaled", key: str = "id",
                seed: int = 2, max_iter: int = 20) -> DataFrame:
    """Within-cluster sum of squares per k: rows (k, wcss), from shared passes."""
    found = sweep_kmeans(as_arrays(df, features, key), ks, seed, max_iter)
    return spark.createDataFrame([(int(k), found[k][1]) for k in ks if k in found], "k int, wcss double")


def assign_all(rows: DataFrame, runs: dict[str, np.ndarray]) -> DataFrame:
    """``key`` and, for each of ``runs`` (column name -> centres), the index of the nearest centre
    (ties: the lower): one pass, by the same products as the fit."""
    names = list(runs)
    centres = [runs[c] for c in names]
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [[] for _ in names]
            for x in _batches(iter([batch.select(["x"])]), centres[0].shape[1]):
                for j, c in enumerate(centres):
                    middle = c.mean(0)
                    best[j].append(((c - middle) ** 2).sum(1)[None] - 2 * (x - middle) @ (c - middle).T)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[
                pa.array(np.concatenate([b.argmin(1) for b in parts]) if parts else np.zeros(0), pa.int32()) for parts in best]], names=["key", *names])

    return rows.select("key", "x").mapInArrow(run, f"key {kind}, " + ", ".join(f"`{c}` int" for c in names))


def assign(rows: DataFrame, centres: np.ndarray, name: str = "cluster") -> DataFrame:
    """``rows`` with the index of the nearest centre (ties: the lower) and the squared distance, by
    plain differences: each distance adds up its squares dimension by dimension."""
    columns = rows.columns
    of = columns.index("x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, least = [], []
            for x in _batches(iter([batch.select([of])]), centres.shape[1]):
                apart = np.zeros((len(centres), len(x)))
                for at, c in zip(np.ascontiguousarray(x.T), centres.T, strict=True):
                    apart += (at - c[:, None]) ** 2
                near = apart.argmin(0)
                best.append(near)
                least.append(apart[near, np.arange(len(x))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(least or [np.zeros(0)])),
                                              pa.array(np.concatenate(best or [np.zeros(0)]), pa.int32())],
                                             names=[*columns, f"{name}_distance", name])

    schema = StructType([*rows.schema.fields, StructField(f"{name}_distance", DoubleType()), StructField(name, IntegerType())])
    return rows.mapInArrow(run, schema)


def spread(assigned: DataFrame, centres: np.ndarray, name: str = "cluster") -> DataFrame:
    """Per centre of :func:`assign`'s rows: ``cluster, n, squares`` (the squared distances to it in all)
    and ``around_mean`` (those to the mean of its rows).

    Each chunk of rows gives its count, its means (from the centre) and the squares around them; parts
    of a centre are then joined by the usual update, so no small difference of large sums is taken."""
    width = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, squares, inner = (np.zeros(len(centres)) for _ in range(3))
        means = np.zeros((len(centres), width))
        for batch in batches:
            best, least = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for begin, x in zip(range(0, batch.num_rows, _CHUNK), _batches(iter([batch]), width), strict=True):
                own, far = best[begin:begin + _CHUNK], least[begin:begin + _CHUNK]
                order = np.argsort(own, kind="stable")
                first = np.flatnonzero(np.r_[True, np.diff(own[order]) > 0])
                some, y = own[order][first], x[order] - centres[own[order]]
                count = np.diff(np.r_[first, len(x)])
                mean = np.add.reduceat(y, first, axis=0) / count[:, None]
                inside = np.add.reduceat(((y - np.repeat(mean, count, axis=0)) ** 2).sum(1), first)
                gap, both = mean - means[some], n[some] + count
                inner[some] += inside + (gap ** 2).sum(1) * n[some] * count / both
                means[some] += gap * (count / both)[:, None]
                n[some] = both
                squares += np.bincount(own, weights=far, minlength=len(centres))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some].astype(np.int64)), pa.array(squares[some]), pa.array(inner[some]),
                                          pa.array(list(means[some]), pa.list_(pa.float64()))], names=[name, "n", "squares", "inner", "means"])

    parts = materialize(assigned.select("x", name, f"{name}_distance")
                        .mapInArrow(run, f"{name} int, n long, squares double, inner double, means array<double>"), "sweep-spread")
    # At most (tasks) x (centres) rows; the squares between the parts' means, by dimension.
    between = (parts.select(name, "n", F.posexplode("means").alias("at", "mean")).groupBy(name, "at")
               .agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("mean")).alias("first"),
                    F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("second"))
               .groupBy(name).agg(F.sum(F.col("second") - F.col("first") * F.col("first") / F.col("all")).alias("between")))
    whole = parts.groupBy(name).agg(F.sum("n").alias("n"), F.sum("squares").alias("squares"), F.sum("inner").alias("inner"))
    return whole.join(between, name).select(name, "n", "squares", (F.col("inner") + F.col("between")).alias("around_mean"))
