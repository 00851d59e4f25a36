"""Whitening of vectors: pivoted Cholesky of the centred scatter, one-sided Jacobi on the factor.

Components of a vector become whole numbers; each distinct vector counts once in the fit. Sums, scatter and the check
of the result are added up per task (a matrix of the vectors' length, whatever the number of rows) and combined by a
grouped sum. The factor of the scatter is triangular but for the order of its rows; rotating its columns until they are
orthogonal leaves columns whose squared lengths are the eigenvalues and whose directions are the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import materialize

#: Whole numbers beyond this size are left out: their multiples would leave the range of a long.
LARGEST = 2**53
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def scaled(embeddings: DataFrame, scale: int) -> DataFrame:
    """``vec_id`` and ``x``, the floor of ``scale`` times each component as a double."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr("transform(embedding, c -> cast(c as double))").alias("c"))
    rows = rows.where(f"size(c) > 0 and forall(c, v -> v is not null and not isnan(v) and abs(v) * {scale} < {LARGEST})")
    return rows.select("vec_id", F.expr(f"transform(c, v -> floor(v * {scale}))").alias("x"))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the vectors of each length."""
    size = column.value_lengths().to_numpy()
    flat, start = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)[:-1]])
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield at, flat[start[at][:, None] + np.arange(d)]


def _totals(fit: DataFrame, part, schema: str, keys: list[str]) -> dict[tuple, int | float]:
    """``part(matrix)`` gives an array for each block of vectors of one length; the arrays are added up by length and
    place, in each task and then over all: what returns are as many numbers as one such array has, for each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_length(batch.column(0)):
                for block in np.array_split(x, -(-len(x) // 4096)):
                    d = x.shape[1]
                    total[d] = total.get(d, 0) + part(block)
        for d, value in total.items():
            places = [p.ravel() for p in np.indices(value.shape)]
            columns = [np.full(value.size, d), *places, value.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.float64 if c.dtype.kind == "f" else np.int64)) for c in columns], names=[*keys, "v"])

    parts = fit.select("x").mapInArrow(run, schema)
    summed = parts.groupBy(*keys).agg(F.sum("v").alias("v"))
    return {tuple(r[k] for k in keys): r["v"] for r in summed.collect()}


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """Columns whose product with their transpose is ``a``, taken by the largest remaining diagonal entry."""
    d = len(a)
    left, order, factor = a.diagonal().copy(), np.arange(d), np.zeros((d, d))
    least = d * np.finfo(float).eps * max(left.max(initial=0), 0)
    for k in range(d):
        j = k + int(np.argmax(left[order[k:]]))
        order[[k, j]] = order[[j, k]]
        p, rest = order[k], order[k + 1 :]
        if left[p] <= least:
            return factor[:, :k]
        factor[p, k] = np.sqrt(left[p])
        factor[rest, k] = (a[rest, p] - factor[rest, :k] @ factor[p, :k]) / factor[p, k]
        left[rest] -= factor[rest, k] ** 2
    return factor


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of ``factor @ factor.T``.

    Pairs of columns are rotated until all are orthogonal; in a sweep every column meets every other, and the pairs of
    one step are disjoint. The largest entry of a component is positive.
    """
    columns = factor.copy()
    r = columns.shape[1]
    ring = list(range(r + r % 2))  # an odd number gets a place that is paired with nothing
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(min(p, q), max(p, q)) for p, q in zip(ring[:half], ring[half:][::-1], strict=True) if max(p, q) < r]
            p, q = np.array(pairs, int).reshape(-1, 2).T
            a, b = columns[:, p], columns[:, q]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            size = np.sqrt(alpha * beta)
            off = np.divide(np.abs(gamma), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, off.max(initial=0))
            turn = off > 1e-16
            zeta = (beta - alpha)[turn] / (2 * gamma[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            columns[:, p[turn]], columns[:, q[turn]] = c * a[:, turn] - s * b[:, turn], s * a[:, turn] + c * b[:, turn]
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if worst <= 4e-16 * max(len(columns), 1):
            break
    length = np.sqrt((columns**2).sum(0))
    order = np.argsort(-length, kind="stable")
    columns = columns[:, order] / length[order]
    columns *= np.sign(columns[np.abs(columns).argmax(0), np.arange(r)])
    return length[order] ** 2, columns


def _deviation(x: np.ndarray, n: int, sums: np.ndarray, bound: int) -> list[int | None]:
    """Exact sums of squares of ``n * x - sums``; None beyond a long."""
    if n * bound < 2**62 and (reach := int(np.abs(n * x - sums).max(initial=0))) ** 2 * x.shape[1] < 2**63:
        return ((n * x - sums) ** 2).sum(1).tolist() if reach else [0] * len(x)
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [v if v < 2**63 else None for v in exact]


def whiten(embeddings: DataFrame, scale: int = 256, components: int = 4) -> DataFrame:
    """A row for each vector and component up to ``components``: ``vec_id``, ``component`` from 1, ``n`` vectors fitted,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    Vectors that are NULL, empty or hold NULL or non-finite entries (or entries of 2**53 and more once scaled) give no
    row. Repeated vectors count once in the fit and give a row each; ``vec_id`` may be NULL or repeat. Vectors of
    different lengths are fitted apart, each length with its own components. There are no more components than the
    scatter has rank, so vectors that are all equal give no row, as does an empty table. ``deviation`` is NULL where it
    exceeds a long. Other columns are not read.
    """
    rows = scaled(embeddings, scale)
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    ones = _totals(fit, lambda x: np.concatenate([[len(x)], x.sum(0)]), "d long, i long, v long", ["d", "i"])
    sums: dict[int, np.ndarray] = {}
    for d in {d for d, _ in ones}:
        sums[d] = np.array([ones[d, i] for i in range(d + 1)])
    means = {d: s[1:] / s[0] for d, s in sums.items()}

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = x - means[x.shape[1]]
        return centred.T @ centred

    entries = _totals(fit, scatter, "d long, i long, j long, v double", ["d", "i", "j"])
    axes: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # components over the roots of their eigenvalues, shares of the trace
    for d, s in sums.items():
        cov = np.array([[entries[d, i, j] for j in range(d)] for i in range(d)]) / s[0]
        values, vectors = jacobi(pivoted_cholesky((cov + cov.T) / 2))
        axes[d] = (vectors / np.sqrt(values))[:, :components], values[:components] / np.trace(cov)

    def second(x: np.ndarray) -> np.ndarray:
        d = x.shape[1]
        w = (x - means[d]) @ axes[d][0]
        w = np.column_stack([w, np.ones(len(w))])
        return w.T @ w

    moments = _totals(fit, second, "d long, i long, j long, v double", ["d", "i", "j"])
    errors = {}
    for d, s in sums.items():
        k = axes[d][0].shape[1]
        m = np.array([[moments[d, i, j] for j in range(k + 1)] for i in range(k + 1)]) / s[0]
        errors[d] = float(np.abs(m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k)).max(initial=0))
    known = {d: (int(s[0]), s[1:], means[d], *axes[d], errors[d]) for d, s in sums.items()}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, x in by_length(batch.column(1)):
                n, total, mean, basis, share, error = known[x.shape[1]]
                k = basis.shape[1]
                if not k:
                    continue
                m = len(at)
                away = _deviation(x, n, total, int(np.abs(x).max()))
                w = (x - mean) @ basis
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    pa.array([v for v in away for _ in range(k)], pa.int64()), pa.array(w.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, RESULT)
