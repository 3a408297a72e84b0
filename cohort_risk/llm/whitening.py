"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries are put on an integer grid, ``x = floor(64 * c) + 1000000``, and the distinct grid
vectors form the fit list. Spark computes its count n and sums S exactly, then the scatter
``C = sum (x - S/n)(x - S/n)^T`` with every vector centred before it is multiplied: each
task adds up the outer products of its own rows, and the d x d partial sums are added by
key. Only d + d * d numbers reach the driver, however many vectors there are.

On the driver, C is factored as ``P L L^T P^T`` with pivoted Cholesky (the largest
remaining diagonal first, stopping where what remains is rounding), so that
``C = G G^T`` with ``G = P L``. One-sided Jacobi rotations then make the columns of G
orthogonal: ``G J = B``. Since ``C = B B^T``, the squared column norms of B are the
eigenvalues of C and its normalised columns the eigenvectors. This works on the
triangular factor alone, never forms C's square again, and finds small eigenvalues to
their relative precision. Eigenvalues of the covariance V are those of C over n.

Every remaining row is projected on the components in its own task; the covariance of the
whitened fit list is measured over the data again, for ``identity_error``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_risk.session import stored

#: Grid of entries: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Components reported at most.
COMPONENTS = 16
#: Pivoted Cholesky stops where the largest remaining diagonal is below this share of the trace.
RANK_TOL = 1e-13
#: Jacobi sweeps end when no pair of columns has a cosine above this.
ORTHO_TOL = 1e-15


def grid(vector) -> F.Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)


def _finite(vector) -> F.Column:
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))


def pivoted_cholesky(c: np.ndarray, tol: float = RANK_TOL) -> tuple[np.ndarray, np.ndarray]:
    """``(L, perm)`` with ``c[perm][:, perm] = L @ L.T``, L of shape d x rank, lower triangular."""
    a = np.array(c, dtype=float)
    d = len(a)
    perm = np.arange(d)
    low = np.zeros((d, d))
    bound = tol * max(np.trace(a), 0.0)
    rank = 0
    for k in range(d):
        j = k + int(np.argmax(np.diag(a)[k:]))
        if a[j, j] <= bound or a[j, j] <= 0:
            break
        a[[k, j]] = a[[j, k]]
        a[:, [k, j]] = a[:, [j, k]]
        low[[k, j]] = low[[j, k]]
        perm[[k, j]] = perm[[j, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1:, k] = a[k + 1:, k] / low[k, k]
        a[k + 1:, k + 1:] -= np.outer(low[k + 1:, k], low[k + 1:, k])
        rank = k + 1
    return low[:, :rank], perm


def jacobi(g: np.ndarray, tol: float = ORTHO_TOL, sweeps: int = 100) -> np.ndarray:
    """Columns of ``g @ J`` for an orthogonal J, rotated until pairwise orthogonal."""
    b = np.array(g, dtype=float)
    r = b.shape[1]
    for _ in range(sweeps):
        rotated = False
        for p in range(r - 1):
            for q in range(p + 1, r):
                alpha, beta, gamma = b[:, p] @ b[:, p], b[:, q] @ b[:, q], b[:, p] @ b[:, q]
                if abs(gamma) <= tol * np.sqrt(alpha * beta) or gamma == 0:
                    continue
                rotated = True
                zeta = (beta - alpha) / (2 * gamma)
                t = np.copysign(1.0, zeta) / (abs(zeta) + np.sqrt(1 + zeta * zeta))
                cos = 1 / np.sqrt(1 + t * t)
                sin = cos * t
                bp = b[:, p].copy()
                b[:, p] = cos * bp - sin * b[:, q]
                b[:, q] = sin * bp + cos * b[:, q]
        if not rotated:
            break
    return b


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a positive semi-definite matrix."""
    low, perm = pivoted_cholesky(scatter)
    g = np.zeros_like(low)
    g[perm] = low
    b = jacobi(g)
    norms = np.sqrt((b * b).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    norms, b = norms[order], b[:, order]
    keep = norms > 0
    return norms[keep] ** 2, b[:, keep] / norms[keep]


def _scatter_of(mean: np.ndarray, d: int):
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy()).astype(float) - mean
                total += x.T @ x
        i, j = np.indices((d, d))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})
    return partial


def _summed(entries: DataFrame, d: int) -> np.ndarray:
    out = np.zeros((d, d))
    for i, j, v in entries.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[i, j] = v
    return out


_ENTRIES = "i int, j int, v double"


def fit(vectors: DataFrame, vector_col: str = "embedding") -> dict:
    """n, S, the dimension, eigenvalues and components of the distinct grid vectors.

    The dimension is the largest length of a remaining vector; vectors of another length
    are left out like invalid ones. With no vector, or no spread, there is no component.
    """
    grid_rows = vectors.filter(_finite(F.col(vector_col))).select(grid(F.col(vector_col)).alias("x"))
    fit_list = stored(grid_rows.distinct(), "whitening-fit")
    d = fit_list.agg(F.max(F.size("x"))).first()[0] or 0
    fit_list = fit_list.filter(F.size("x") == d)
    n = fit_list.count()
    sums = np.zeros(d, dtype=object)
    for pos, s in fit_list.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col")).collect():
        sums[pos] = int(s)
    if n == 0 or d == 0:
        return {"n": n, "d": d, "sums": sums, "values": np.zeros(0), "vectors": np.zeros((d, 0)),
                "trace": 0.0, "identity_error": 0.0}
    mean = np.array([float(s) / n for s in sums])
    scatter = _summed(fit_list.mapInPandas(_scatter_of(mean, d), _ENTRIES), d)
    values, vectors_ = eigen(scatter)
    values, vectors_ = values[:COMPONENTS] / n, vectors_[:, :COMPONENTS]
    model = {"n": n, "d": d, "sums": sums, "values": values, "vectors": vectors_,
             "trace": float(np.trace(scatter)) / n}
    k = len(values)
    whitened = fit_list.mapInPandas(_whitened_scatter(model), _ENTRIES)
    cov = _summed(whitened, k)[:k, :k] / n if k else np.zeros((0, 0))
    model["identity_error"] = float(np.abs(cov - np.eye(k)).max()) if k else 0.0
    return model


def _project(model: dict, x: np.ndarray) -> np.ndarray:
    mean = np.array([float(s) / model["n"] for s in model["sums"]])
    return ((x.astype(float) - mean) @ model["vectors"]) / np.sqrt(model["values"])


def _whitened_scatter(model: dict):
    k = len(model["values"])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k, k))
        for batch in batches:
            if len(batch):
                w = _project(model, np.stack(batch["x"].to_numpy()))
                total += w.T @ w
        i, j = np.indices((k, k))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})
    return partial


def deviations(model: dict, x: np.ndarray) -> list[int]:
    """sum over dimensions of (n * x - S) ** 2, exactly."""
    n, sums = model["n"], model["sums"]
    wide = int(np.abs(x).max(initial=0)) * n + max((abs(int(s)) for s in sums), default=0)
    if wide < 2 ** 62:
        dev = n * x.astype(np.int64) - np.array([int(s) for s in sums], dtype=np.int64)
        if int(np.abs(dev).max(initial=0)) ** 2 * max(1, len(sums)) < 2 ** 63:
            return [int(v) for v in (dev * dev).sum(axis=1)]
    return [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]


_OUT = T.StructType([
    T.StructField("vec_id", T.StringType()), T.StructField("component", T.IntegerType()),
    T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
])


def whiten(vectors: DataFrame, model: dict, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, holds a null or non-finite entry, or has another length than
    the fit's are dropped. Repeated rows each give their own rows. No component, no row.
    """
    k = len(model["values"])

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch) or not k:
                continue
            x = np.stack(batch["x"].to_numpy())
            w = _project(model, x)
            dev = deviations(model, x)
            yield pd.DataFrame({"vec_id": np.repeat(batch["vec_id"].to_numpy(), k),
                                "component": np.tile(np.arange(1, k + 1), len(batch)),
                                "deviation": np.repeat(np.array(dev, dtype=object), k).astype(np.int64),
                                "whitened": w.ravel()})

    rows = (vectors.filter(_finite(F.col(vector_col)) & (F.size(vector_col) == model["d"]))
            .select(F.col(id_col).cast("string").alias("vec_id"), grid(F.col(vector_col)).alias("x")))
    explained = F.element_at(F.array(*(F.lit(float(e / model["trace"])) for e in model["values"])) if k
                             else F.array().cast("array<double>"), F.col("component"))
    return rows.mapInPandas(project, _OUT).select(
        F.col("vec_id").cast("long").alias("vec_id"), "component", F.lit(model["n"]).cast("long").alias("n"),
        "deviation", "whitened", explained.alias("explained"),
        F.lit(model.get("identity_error", 0.0)).alias("identity_error"))
