"""Operator 13: embedding whitening by QDWH spectral divide and conquer.

The covariance of the distinct integer vectors is summed by Spark, centred
before multiplying. Its eigenvectors come from polar decompositions alone: for
a shift s the orthogonal polar factor U of V - s*I, found by the dynamically
weighted Halley iteration (QDWH), gives the spectral projector (U + I) / 2 of
the eigenvalues above s. An orthonormal basis of the projector's range and one
of its complement split V into two smaller covariances, which are split in the
same way until a subspace is one-dimensional, or V is a multiple of the
identity on it. The leading components are broadcast in the closure of one
Arrow pass that whitens every row.

What reaches the driver is d x d numbers for d dimensions, never rows.

Cases: rows whose vector is null or holds null or non-finite entries are
dropped, vectors of another length than the most frequent one too; repeated
vectors count once in the fit and are whitened in every row; ids may be null
or repeated; components without variance (an eigenvalue of at most 1e-12 of
the trace, as with a single distinct vector) have a null ``whitened`` and
count nowhere else; fewer dimensions give fewer components; equal eigenvalues
give any orthonormal basis of their subspace, the same for all rows; a
``deviation`` beyond 64 bits is null; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.stage import staged
from citypulse.llm.vectors import integer_vectors, matrix

COMPONENTS = 4
FLAT = 1e-12  # share of the trace below which a component has no variance
EPS = np.finfo(np.float64).eps


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH. The lower bound on
    its least singular value starts at the rounding level, which costs six
    iterations at most."""
    n = len(a)
    eye = np.eye(n)
    x = a / max(np.linalg.norm(a), 1e-300)
    low = EPS
    for _ in range(20):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:  # by QR while the weights are large, which is stable
            q = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, eye]))[0]
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            z = eye + wc * (x.T @ x)
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(z, x.T).T
        x = (x + x.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) < np.cbrt(4 * EPS):
            break
    return x


def _range(projector: np.ndarray, k: int, start: np.ndarray) -> np.ndarray:
    """Orthonormal basis of the range of a projector of rank k."""
    q = np.linalg.qr(projector @ start[:, :k])[0]
    return np.linalg.qr(projector @ q)[0]


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Candidate shifts inside the spectrum: between the middle diagonal entries
    first, then spread over the range that the norm allows."""
    diagonal = np.sort(np.diag(a))
    middle = len(diagonal) // 2
    yield (diagonal[middle - 1] + diagonal[middle]) / 2
    yield diagonal.mean()
    mean, spread = diagonal.mean(), np.linalg.norm(a - np.diag(np.full(len(a), diagonal.mean())))
    for k in range(1, 200):  # golden-ratio steps meet every gap sooner or later
        yield mean + spread / np.sqrt(len(a)) * (2 * (k * 0.6180339887498949 % 1) - 1) * (1 + k / 20)


def split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if no
    shift separates the eigenvalues."""
    n = len(a)
    start = np.random.default_rng(n).standard_normal((n, n))
    best, least = None, np.inf
    for shift in _shifts(a):
        u = polar(a - shift * np.eye(n))
        above = (u + np.eye(n)) / 2
        k = int(round(np.trace(above)))
        if not 0 < k < n:
            continue
        v1, v2 = _range(above, k, start), _range(np.eye(n) - above, n - k, start)
        error = max(np.linalg.norm(v1.T @ a @ v2) / scale, np.linalg.norm(v1.T @ v2))
        if error < least:
            best, least = (v1, v2), error
        if least < 10 * n * EPS:
            break
    return best if least < 1e-8 else None


def spectrum(a: np.ndarray, leading: int | None = None, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue; the
    ``leading`` ones at least, of a symmetric matrix."""
    n = len(a)
    scale = scale if scale is not None else max(np.linalg.norm(a), 1e-300)
    leading = n if leading is None else min(leading, n)
    mean = np.trace(a) / n
    parts = split(a, scale) if n > 1 and np.linalg.norm(a - mean * np.eye(n)) > 4 * n * EPS * scale else None
    if parts is None:
        values = np.diag(a)
        order = np.argsort(-values, kind="stable")
        return values[order], np.eye(n)[:, order]
    values, vectors = [], []
    for v in parts:
        if leading > 0:
            small = v.T @ a @ v
            e, w = spectrum((small + small.T) / 2, leading, scale)
            values.append(e)
            vectors.append(v @ w)
            leading -= len(e)
    e, w = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-e, kind="stable")
    return e[order], w[:, order]


def _summed(fit: DataFrame, partial, kind: str) -> np.ndarray:
    """Sum of ``partial(matrices)``, one vector per task, over all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                mine = partial(b.column("x"))
                total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "s"])

    sums = fit.mapInArrow(run, f"at long, s {kind}").groupBy("at").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros(sums.num_rows, np.int64 if kind == "long" else np.float64)
    out[sums["at"].to_numpy()] = sums["s"].to_numpy()
    return out


class Whitener:
    """Fitted on the distinct vectors of a table; whitens any rows of it."""

    def __init__(self, rows: DataFrame, size: int, components: int = COMPONENTS):
        self.size = size
        # equal vectors meet in the aggregate, map side first
        fit = staged(rows.select("x").distinct(), "op13-fit")
        first = _summed(fit, lambda c: np.append(matrix(c, size).sum(axis=0), len(c)), "long")
        self.n, self.sums = int(first[-1]), first[:-1]
        mean = self.mean = self.sums / self.n
        upper = np.triu_indices(size)

        def products(c: pa.Array) -> np.ndarray:
            y = matrix(c, size) - mean
            return (y.T @ y)[upper]

        v = np.zeros((size, size))
        v[upper] = _summed(fit, products, "double") / self.n
        self.covariance = v + np.triu(v, 1).T
        trace = float(np.trace(self.covariance))
        values, vectors = spectrum(self.covariance, components) if trace > 0 else (np.zeros(size), np.eye(size))
        self.values, self.vectors = values[:components], vectors[:, :components]
        self.alive = self.values > FLAT * trace
        self.explained = self.values / trace if trace > 0 else np.zeros(len(self.values))
        self.scaled = self.vectors / np.sqrt(np.where(self.alive, self.values, 1.0))
        self.identity_error = self._identity_error(fit)

    def _identity_error(self, fit: DataFrame) -> float:
        """Largest entry of the whitened fit list's covariance minus the identity."""
        k, size, mean, scaled = int(self.alive.sum()), self.size, self.mean, self.scaled[:, self.alive]
        if not k:
            return 0.0

        def moments(c: pa.Array) -> np.ndarray:
            y = (matrix(c, size) - mean) @ scaled
            return np.concatenate([y.sum(axis=0), (y.T @ y).reshape(-1)])

        s = _summed(fit, moments, "double") / self.n
        return float(np.abs(s[k:].reshape(k, k) - np.outer(s[:k], s[:k]) - np.eye(k)).max())

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) squared, exactly."""
        n, sums = self.n, self.sums
        limit = n * max(int(np.abs(x).max(initial=0)), 1) + int(np.abs(sums).max(initial=0))
        if limit ** 2 * self.size < 2 ** 63:
            return ((n * x - sums) ** 2).sum(axis=1).tolist()
        exact = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
        return [int(d) if d < 2 ** 63 else None for d in exact]

    def whiten(self, rows: DataFrame) -> DataFrame:
        """(vec_id, deviation, whitened array) per row."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = len(self.values)
            for b in batches:
                if not b.num_rows:
                    continue
                x = matrix(b.column("x"), self.size)
                y = (x - self.mean) @ self.scaled
                dead = np.broadcast_to(~self.alive, y.shape).reshape(-1)
                cut = np.arange(len(x) + 1, dtype=np.int32) * k
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").cast(pa.int64()), pa.array(self.deviation(x), pa.int64()),
                     pa.ListArray.from_arrays(cut, pa.array(y.reshape(-1), mask=dead))],
                    ["vec_id", "deviation", "whitened"])

        return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """One row per kept row and component."""
    out = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")
    rows, size = integer_vectors(df, id_col, vector_col)
    if not size:
        return df.sparkSession.createDataFrame([], out).withColumnRenamed("vec_id", id_col)
    w = Whitener(rows, size, components)
    explained = F.array(*[F.lit(float(e)) for e in w.explained])
    return w.whiten(rows).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("vec_id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"),
        "deviation", "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(w.identity_error).alias("identity_error"))
