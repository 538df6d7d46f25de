"""Principal components of wide, sparse features by block Krylov iteration.

Every pass multiplies the centred scatter matrix with a thin block: a task multiplies its sparse
rows with the block and that product with the rows' transpose, so neither the matrix nor a
covariance (10,000 x 10,000 for hashed features) is ever formed; centring is a correction with the
means. The driver keeps the blocks so far (features x a few dozen), orthogonalises them, and solves
the small eigenproblem in their span; it stops when the wanted eigenvalues stand still.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.session import materialize


@dataclass
class Components:
    """``vectors``: features x k, orthonormal; ``variances``: of the components (sample variances);
    ``total``: of all features; ``means``; ``passes`` over the data."""
    vectors: np.ndarray
    variances: np.ndarray
    total: float
    means: np.ndarray
    passes: int

    @property
    def ratios(self) -> np.ndarray:
        return self.variances / self.total if self.total > 0 else np.zeros_like(self.variances)


def sparse_rows(df: DataFrame, features: str, key: str = "id") -> DataFrame:
    """``key, at, value``: places and values of the non-zero entries of a vector column."""
    entries = F.filter(F.transform(vector_to_array(F.col(features)), lambda v, i: F.struct(i.alias("at"), v.alias("value"))),
                       lambda e: e["value"] != 0)
    return df.select(F.col(key).alias("key"), entries.alias("e")).select("key", F.col("e.at").alias("at"), F.col("e.value").alias("value"))


def _csr(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, place, value) of columns ``at, value``."""
    at, value = batch.column(0), batch.column(1)
    lengths = np.diff(at.offsets.to_numpy())
    return (np.repeat(np.arange(batch.num_rows), lengths), at.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            value.flatten().to_numpy(zero_copy_only=False))


def _collect_slots(frame: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size)
    sums = frame.groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
    out[sums["slot"].to_numpy()] = sums["value"].to_numpy()
    return out


def _slots(flat: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(flat)
    return pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], names=["slot", "value"])


def _moments(rows: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sum of each feature, sum of its squares)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 * width + 1)
        for batch in batches:
            _, at, value = _csr(batch)
            sums[:width] += np.bincount(at, weights=value, minlength=width)
            sums[width:-1] += np.bincount(at, weights=value ** 2, minlength=width)
            sums[-1] += batch.num_rows
        yield _slots(sums)

    sums = _collect_slots(rows.select("at", "value").mapInArrow(run, "slot long, value double"), 2 * width + 1)
    return int(sums[-1]), sums[:width], sums[width:-1]


#: Chunks of vectors of at most this width are multiplied as a dense matrix.
_DENSE_WIDTH = 512


def _scatter_times(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    """``X'X block`` for the rows X: at most features x block width rows come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(block)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                row, at, value = _csr(batch.slice(lo, 2048))
                if not len(row):
                    continue
                if len(block) <= _DENSE_WIDTH:
                    x = np.bincount(row * len(block) + at, weights=value, minlength=(row[-1] + 1) * len(block)).reshape(-1, len(block))
                    total += x.T @ (x @ block)
                    continue
                first = np.flatnonzero(np.r_[True, np.diff(row) > 0])
                scaled = value[:, None] * block[at]
                product = np.add.reduceat(scaled, first, axis=0)
                back = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(row)]))
                order = np.argsort(at, kind="stable")
                edges = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
                total[at[order][edges]] += np.add.reduceat((value[:, None] * product[back])[order], edges, axis=0)
        yield _slots(total.ravel())

    return _collect_slots(rows.select("at", "value").mapInArrow(run, "slot long, value double"), block.size).reshape(block.shape)


def principal_components(rows: DataFrame, width: int, k: int, extra: int = 4, passes: int = 30, tol: float = 1e-10,
                         seed: int = 0) -> Components:
    """The first ``k`` principal components of ``rows`` (``at, value`` of :func:`sparse_rows`).

    Each pass adds a block of ``k + extra`` directions, so after m passes the search space holds all
    polynomials of degree m of the scatter matrix. Signs: the largest entry of a component is
    positive. Fewer than two rows: no variances.
    """
    rows = materialize(rows.select("at", "value"), "subspace")
    n, sums, squares = _moments(rows, width)
    if n < 2:
        return Components(np.zeros((width, 0)), np.zeros(0), 0.0, sums / max(n, 1), 1)
    means = sums / n
    total = float(np.maximum(squares - n * means ** 2, 0).sum()) / (n - 1)
    b = min(width, k + extra)
    block, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, b)))
    space, images, last, used = np.zeros((width, 0)), np.zeros((width, 0)), None, 1
    while True:
        image = (_scatter_times(rows, block) - n * np.outer(means, means @ block)) / (n - 1)
        used += 1
        space, images = np.hstack([space, block]), np.hstack([images, image])
        small = space.T @ images
        values, within = np.linalg.eigh((small + small.T) / 2)
        values, within = values[::-1][:k], within[:, ::-1][:, :k]
        settled = last is not None and np.all(np.abs(values[:len(last)] - last) <= tol * max(values[0], 1e-300))
        # The part of the image that the space does not hold yet, orthogonalised twice.
        for _ in range(2):
            image = image - space @ (space.T @ image)
        q, r = np.linalg.qr(image)
        block = q[:, np.abs(np.diag(r)) > 1e-10 * max(values[0], 1e-300)]
        if settled or used > passes or block.shape[1] == 0 or space.shape[1] + block.shape[1] > width:
            break
        block = block - space @ (space.T @ block)
        block, _ = np.linalg.qr(block)
        last = values
    vectors = space @ within
    flip = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return Components(vectors * np.where(flip == 0, 1, flip), np.maximum(values, 0), total, means, used)


def explained(spark: SparkSession, found: Components, digits: int = 6) -> DataFrame:
    """Rows (component, ratio, cumulative)."""
    upto = np.cumsum(found.ratios)
    rows = [(i + 1, round(float(r), digits), round(float(c), digits)) for i, (r, c) in enumerate(zip(found.ratios, upto, strict=True))]
    return spark.createDataFrame(rows, "component int, ratio double, cumulative double")


def project(rows: DataFrame, found: Components, names=("pc1", "pc2")) -> DataFrame:
    """``key`` and the components' scores of every row (not centred, as Spark's own model gives them)."""
    vectors = found.vectors[:, :len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, at, value = _csr(batch.select(["at", "value"]))
            scores = np.stack([np.bincount(row, weights=value * vectors[at, j], minlength=batch.num_rows) for j in range(len(names))])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(s) for s in scores]], names=["key", *names])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.select("key", "at", "value").mapInArrow(run, f"key {kind}, " + ", ".join(f"{c} double" for c in names))


def facts(spark: SparkSession, rows: DataFrame, found: Components, digits: int = 6) -> DataFrame:
    """One row (k, total_variance, n_not_orthonormal, n_not_eigen): how many products of two components
    differ from the identity, and how many components one more pass turns instead of stretching."""
    n, _, _ = _moments(rows, len(found.means))
    v, k = found.vectors, len(found.variances)
    image = (_scatter_times(rows, v) - n * np.outer(found.means, found.means @ v)) / max(n - 1, 1)
    turned = np.linalg.norm(image - v * found.variances, axis=0) > 1e-4 * found.variances.max(initial=0)
    apart = np.abs(v.T @ v - np.eye(k)) > 1e-8
    return spark.createDataFrame([(k, round(found.total, digits), int(apart.sum()), int(turned.sum()))],
                                 "k int, total_variance double, n_not_orthonormal int, n_not_eigen int")
