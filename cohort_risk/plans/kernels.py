"""Multinomial logistic regressions over random features, all fits of a branch in one pass per step.

The objective is Spark ML's: weighted mean log loss plus reg / 2 times the squared
coefficients, intercepts free. A pass computes the random features of a slice once and takes
them through all fits, so the features are neither stored nor read again. The search runs in
variables that a covariance of the features has whitened, which needs far fewer steps.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import DataFrame

from cohort_risk import config as C
from cohort_risk.plans.packed import HELD_OUT, trained_on

#: Rows that a task maps at once.
SLICE = 4096
#: Steps that a search remembers, and its tolerance of the gradient, as in Spark ML.
MEMORY, TOLERANCE = 10, 1e-6


def lbfgs(x: np.ndarray, max_iter: int, tol: float = TOLERANCE) -> Generator:
    """Limited-memory BFGS: yields points, is sent ``(value, gradient)``, returns the last point."""
    f, g = yield x
    steps: list[tuple] = []
    for _ in range(max_iter):
        if np.linalg.norm(g) <= max(tol * abs(f), 1e-8):
            break
        d, back = -g, []
        for s, y, rho in reversed(steps):
            a = rho * (s @ d)
            back.append(a)
            d = d - a * y
        if steps:
            s, y, _ = steps[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y, rho), a in zip(steps, reversed(back)):
            d = d + (a - rho * (y @ d)) * s
        slope, t = g @ d, 1.0
        while True:
            nf, ng = yield x + t * d
            if nf <= f + 1e-4 * t * slope:
                break
            t /= 2
            if t < 1e-10:
                return x
        s, y = t * d, ng - g
        if s @ y > 0:
            steps = [*steps, (s, y, 1.0 / (s @ y))][-MEMORY:]
        x, f, g = x + s, nf, ng
    return x


def in_step(searches: Sequence[Generator], evaluate: Callable) -> list[np.ndarray]:
    """Runs searches together: ``evaluate`` takes the points of all, and gives a value and gradient each."""
    found: list = [None] * len(searches)
    open_ = {i: next(s) for i, s in enumerate(searches)}
    while open_:
        said, now = evaluate(open_), {}
        for i in open_:
            try:
                now[i] = searches[i].send(said[i])
            except StopIteration as end:
                found[i] = end.value
        open_ = now
    return found


def _cosines(x: np.ndarray) -> np.ndarray:
    """Cosines to about 1e-7, by way of single precision after reduction to one period."""
    x = x - np.rint(x / (2 * np.pi)) * (2 * np.pi)
    return np.cos(x.astype(np.float32)).astype(float)


def _slices(batches: Iterator[pa.RecordBatch], freq: np.ndarray, phase: np.ndarray):
    """``(random features, classes, marks)`` of at most ``SLICE`` rows."""
    scale = np.sqrt(2.0 / freq.shape[1])
    for batch in batches:
        for row in batch.to_pylist():
            x = np.frombuffer(row["x"], float).reshape(-1, freq.shape[0])
            y, marks = np.frombuffer(row["y"], np.uint8), np.frombuffer(row["marks"], np.uint8)
            for i in range(0, len(y), SLICE):
                at = slice(i, i + SLICE)
                yield scale * _cosines(x[at] @ freq + phase), y[at], marks[at]


def _total(packed: DataFrame, part: Callable) -> np.ndarray:
    """Sum of one array per task; the arrays have the size of the model, not of the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = part(batches)
        if out is not None:
            yield pa.RecordBatch.from_pydict({"data": pa.array([out.tobytes()], pa.binary())})

    rows = packed.select("x", "y", "marks").mapInArrow(run, "data binary").collect()
    return sum(np.frombuffer(r["data"], float) for r in rows)


def _moments(packed: DataFrame, freq, phase, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted mean and covariance of the random features."""
    def part(batches):
        out = None
        for x, y, _ in _slices(batches, freq, phase):
            x = np.hstack([x, np.ones((len(y), 1))]) * np.sqrt(weights[y])[:, None]
            out = x.T @ x if out is None else out + x.T @ x
        return out

    d = freq.shape[1] + 1
    m = _total(packed, part).reshape(d, d)
    m /= m[-1, -1]
    return m[-1, :-1], m[:-1, :-1] - np.outer(m[-1, :-1], m[-1, :-1])


def _losses(packed: DataFrame, freq, phase, weights: np.ndarray, points: dict[int, np.ndarray]):
    """``fit -> (loss, gradient)`` without the penalty; points are (features + 1) x classes, intercepts last."""
    fits, n_classes = list(points), len(weights)
    w = np.hstack([points[fit] for fit in fits])

    def part(batches):
        out = None
        for x, y, marks in _slices(batches, freq, phase):
            z = (x @ w[:-1] + w[-1]).reshape(len(y), len(fits), n_classes)
            z -= z.max(axis=2, keepdims=True)
            own = np.take_along_axis(z, y[:, None, None].astype(np.int64), axis=2)[:, :, 0]
            np.exp(z, out=z)
            sums = z.sum(axis=2)
            mass = np.stack([trained_on(marks, fit) for fit in fits], axis=1) * weights[y][:, None]
            loss = (mass * (np.log(sums) - own)).sum(axis=0)
            z *= (mass / sums)[:, :, None]
            np.put_along_axis(z, y[:, None, None].astype(np.int64), np.take_along_axis(
                z, y[:, None, None].astype(np.int64), axis=2) - mass[:, :, None], axis=2)
            z = z.reshape(len(y), -1)
            found = np.concatenate([loss, mass.sum(axis=0), (x.T @ z).ravel(), z.sum(axis=0)])
            out = found if out is None else out + found
        return out

    total, n = _total(packed, part), len(fits)
    grads = total[2 * n:].reshape(-1, n, n_classes)
    return {fit: (total[i] / total[n + i], grads[:, i] / total[n + i]) for i, fit in enumerate(fits)}


def fit(packed: DataFrame, fits: Sequence[int], freq: np.ndarray, phase: np.ndarray, weights: Sequence[float],
        params: C.KernelParams) -> dict[int, np.ndarray]:
    """Per fit the coefficients and, in the last row, the intercepts: (features + 1) x classes."""
    weights = np.asarray(weights, float)
    n_classes, d = len(weights), freq.shape[1]
    mean, cov = _moments(packed, freq, phase, weights)
    # the Hessian at even probabilities, up to the intercepts, is the covariance over the classes
    root = np.linalg.cholesky(cov / n_classes + params.reg * np.eye(d))
    level = np.sqrt(float(n_classes))

    def plain(u: np.ndarray) -> np.ndarray:
        u = u.reshape(d + 1, n_classes)
        w = np.linalg.solve(root.T, u[:-1])
        return np.vstack([w, level * u[-1] - mean @ w])

    def evaluate(points: dict[int, np.ndarray]) -> dict[int, tuple]:
        ws = {i: plain(u) for i, u in points.items()}
        said = _losses(packed, freq, phase, weights, {fits[i]: w for i, w in ws.items()})
        out = {}
        for i, w in ws.items():
            loss, g = said[fits[i]]
            down = g[:-1] - np.outer(mean, g[-1]) + params.reg * w[:-1]
            out[i] = (loss + params.reg / 2 * float((w[:-1] ** 2).sum()),
                      np.vstack([np.linalg.solve(root, down), level * g[-1]]).ravel())
        return out

    searches = [lbfgs(np.zeros((d + 1) * n_classes), params.max_iter) for _ in fits]
    found = {f: plain(u) for f, u in zip(fits, in_step(searches, evaluate))}
    for w in found.values():  # the same for all classes does not change a prediction
        w[-1] -= w[-1].mean()
    return found


def fold_predictions(packed: DataFrame, fitted: dict[int, np.ndarray], freq, phase) -> DataFrame:
    """``(fold, label, pred)`` of every row, by the fit that left out its fold."""
    folds = sorted(f for f in fitted if f >= 0)
    w = np.stack([fitted[f] for f in folds])
    place = np.full(HELD_OUT, -1)
    place[folds] = np.arange(len(folds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, marks in _slices(batches, freq, phase):
            fold = marks & (HELD_OUT - 1)
            z = np.einsum("ij,fjc->ifc", x, w[:, :-1], optimize=True) + w[:, -1]
            pred = z[np.arange(len(y)), place[fold]].argmax(axis=1)
            yield pa.RecordBatch.from_pydict({
                "fold": pa.array(fold, pa.int32()), "label": pa.array(y, pa.int32()), "pred": pa.array(pred, pa.int32())})

    return packed.select("x", "y", "marks").mapInArrow(run, "fold int, label int, pred int")


def model(w: np.ndarray, estimator: LogisticRegression, spark) -> LogisticRegressionModel:
    """Coefficients as Spark ML's model."""
    sc, (d, n_classes) = spark.sparkContext, (w.shape[0] - 1, w.shape[1])
    java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        estimator.uid, _py2java(sc, Matrices.dense(n_classes, d, w[:-1].ravel())),
        _py2java(sc, Vectors.dense(w[-1])), n_classes, True)
    return estimator._copyValues(estimator._create_model(java))
