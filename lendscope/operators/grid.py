"""A grid of logistic regressions fitted together: one pass over the data serves every penalty.

All models walk in lockstep by L-BFGS. A pass multiplies the sparse rows with a matrix whose columns
are the models' trial coefficients and returns every model's loss and gradient; the driver holds
coefficients and a short history (features x models x a few). The walk is over coefficients of centred
features, in units that even out their curvature; a far-off column such as a year or a rare token
would slow it down otherwise. The means move into the intercept, so the sparse rows stay as they are.
A model that has converged leaves the matrix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.operators.subspace import _collect_slots, _csr, _moments, _slots
from lendscope.session import materialize

_CHUNK = 2048


@dataclass
class Logistic:
    """A fitted model: ``weights`` by slot, ``intercept``, its objective, largest slope and passes."""
    reg_param: float
    weights: np.ndarray
    intercept: float
    objective: float
    slope: float
    passes: int


def _margins(row, at, value, table, bias, n_rows):
    out = np.empty((n_rows, table.shape[1]))
    for j in range(table.shape[1]):
        out[:, j] = np.bincount(row, weights=value * table[at, j], minlength=n_rows)
    return out + bias


def losses_and_slopes(rows: DataFrame, table: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, loss of each column, slopes) of ``table`` (slots + 1) x models, the last line being the
    intercepts; sums over ``rows`` (``at, value, label``)."""
    width, models = table.shape[0] - 1, table.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slopes, loss, n = np.zeros_like(table), np.zeros(models), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(lo, _CHUNK)
                row, at, value = _csr(part)
                label = part.column(2).to_numpy(zero_copy_only=False)[:, None]
                margin = _margins(row, at, value, table[:-1], table[-1], part.num_rows)
                loss += (np.logaddexp(0, margin) - label * margin).sum(0)
                error = 0.5 * (1 + np.tanh(margin / 2)) - label
                n += part.num_rows
                slopes[-1] += error.sum(0)
                for j in range(models):
                    slopes[:-1, j] += np.bincount(at, weights=value * error[row, j], minlength=width)
        yield _slots(np.r_[n, loss, slopes.ravel()])

    flat = _collect_slots(rows.select("at", "value", "label").mapInArrow(run, "slot long, value double"), 1 + models + table.size)
    return flat[0], flat[1:1 + models], flat[1 + models:].reshape(width + 1, models)


@dataclass
class _Walk:
    """One model's L-BFGS state."""
    reg: float
    unit: np.ndarray
    point: np.ndarray
    value: float = np.inf
    slope: np.ndarray | None = None
    direction: np.ndarray | None = None
    step: float = 1.0
    history: list = field(default_factory=list)
    done: bool = False
    passes: int = 0

    @property
    def trial(self) -> np.ndarray:
        return self.point if self.direction is None else self.point + self.step * self.direction

    def coefficients(self, point: np.ndarray, means: np.ndarray) -> np.ndarray:
        """Weights and the intercept of uncentred features."""
        weights = point[:-1] / self.unit
        return np.r_[weights, point[-1] - means @ weights]

    def take(self, value: float, slope: np.ndarray, tol: float, memory: int) -> None:
        """The objective and slopes at the trial point: accept it or shorten the step."""
        self.passes += 1
        if self.direction is not None:
            enough = self.value + 1e-4 * self.step * float(self.slope @ self.direction) + 1e-14 * abs(self.value)  # rounding
            if value > enough and self.step > 1e-12:
                self.step /= 2
                return
            moved, turned = self.trial - self.point, slope - self.slope
            if moved @ turned > 1e-300:
                self.history = [*self.history[-(memory - 1):], (moved, turned, 1 / float(moved @ turned))]
            self.point = self.trial
        self.value, self.slope = value, slope
        if np.abs(slope).max() <= tol:
            self.done = True
            return
        d, kept = slope.copy(), []
        for moved, turned, rho in reversed(self.history):
            a = rho * float(moved @ d)
            kept.append(a)
            d -= a * turned
        if self.history:
            moved, turned, rho = self.history[-1]
            d *= 1 / (rho * float(turned @ turned))
        else:
            d /= max(1.0, float(np.linalg.norm(slope)))
        for (moved, turned, rho), a in zip(self.history, reversed(kept), strict=True):
            d += (a - rho * float(turned @ d)) * moved
        self.direction, self.step = -d, 1.0


def fit_grid(rows: DataFrame, width: int, reg_params: Sequence[float], label: str = "target", tol: float = 1e-9,
             max_passes: int = 200, memory: int = 10) -> list[Logistic]:
    """A logistic regression for each penalty, minimising mean loss + ``reg / 2 * |weights|^2`` (the
    intercept is free, features are taken as they are).

    ``rows`` have ``at``, ``value`` and a 0/1 label; those with a NULL label are left out. A model
    stops when no slope, in the walk's units, exceeds ``tol``, or after ``max_passes`` passes over the data.
    """
    data = materialize(rows.where(F.col(label).isNotNull()).select("at", "value", F.col(label).cast("double").alias("label")), "grid")
    n, sums, squares = _moments(data, width)
    means = sums / max(n, 1)
    variances = np.maximum(squares / max(n, 1) - means ** 2, 0)
    units = [np.sqrt(variances / 4 + reg) for reg in reg_params]
    walks = [_Walk(float(reg), np.where(unit > 0, unit, 1.0), np.zeros(width + 1)) for reg, unit in zip(reg_params, units, strict=True)]
    for _ in range(max_passes):
        going = [w for w in walks if not w.done]
        if not going or n == 0:
            break
        table = np.stack([w.coefficients(w.trial, means) for w in going], axis=1)
        _, loss, slopes = losses_and_slopes(data, table)
        for j, w in enumerate(going):
            free = np.r_[table[:-1, j], 0.0]
            slope = slopes[:, j] / n + w.reg * free
            slope[:-1] = (slope[:-1] - means * slope[-1]) / w.unit
            w.take(loss[j] / n + w.reg / 2 * float(free @ free), slope, tol, memory)
    ends = [w.coefficients(w.point, means) for w in walks]
    return [Logistic(w.reg, end[:-1], float(end[-1]), float(w.value), float(np.abs(w.slope).max()) if w.slope is not None else 0.0, w.passes)
            for w, end in zip(walks, ends, strict=True)]


def score_grid(rows: DataFrame, models: Sequence[Logistic], keep: Sequence[str] = ("id", "target")) -> DataFrame:
    """``keep`` and ``score_0``, ``score_1``, ...: the probability of label 1 by each model."""
    table = np.stack([m.weights for m in models], axis=1)
    bias = np.array([m.intercept for m in models])
    names = [f"score_{j}" for j in range(len(models))]
    given = rows.select("at", "value", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(lo, _CHUNK)
                row, at, value = _csr(part)
                score = 0.5 * (1 + np.tanh(_margins(row, at, value, table, bias, part.num_rows) / 2))
                yield pa.RecordBatch.from_arrays([*(part.column(2 + i) for i in range(len(keep))), *(pa.array(score[:, j]) for j in range(len(names)))],
                                                 names=[*keep, *names])

    schema = ", ".join([f"{c} {given.schema[c].dataType.simpleString()}" for c in keep] + [f"{c} double" for c in names])
    return given.mapInArrow(run, schema)


def slopes_off(spark: SparkSession, rows: DataFrame, models: Sequence[Logistic], tol: float, label: str = "target") -> DataFrame:
    """(reg_param, n, n_slopes_off): coefficients whose slope at the fitted point exceeds ``tol`` times
    one plus their feature's mean."""
    table = np.stack([np.r_[m.weights, m.intercept] for m in models], axis=1)
    known = rows.select("at", "value", rows[label].cast("double").alias("label")).where("label IS NOT NULL")
    n, _, slopes = losses_and_slopes(known, table)
    means = _moments(known, len(table) - 1)[1] / max(n, 1)
    free = table * np.r_[np.ones(len(table) - 1), 0.0][:, None]
    off = np.abs(slopes / max(n, 1) + free * [m.reg_param for m in models]) > tol * (1 + np.abs(np.r_[means, 0]))[:, None]
    return spark.createDataFrame([(m.reg_param, int(n), int(off[:, j].sum())) for j, m in enumerate(models)], "reg_param double, n bigint, n_slopes_off int")
