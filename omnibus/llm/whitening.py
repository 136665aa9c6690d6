"""Embedding whitening: principal components of a distributed covariance, from textbook eigen solvers.

1. One pass over the vectors takes the exact integer sums of each dimension.
2. A second one multiplies the centred vectors; tasks add their products up
   and Spark adds up the tasks', entry by entry.  Centring is exact until its last step:
   with S = q*n + r, an entry x is moved by x - q in integers and then by r/n.
3. The matrix, dimensions squared and independent of the rows, is brought to
   tridiagonal form by Householder reflections.  Sturm counts bisect its leading
   eigenvalues, inverse iteration finds their vectors, and vectors of close
   eigenvalues are made orthogonal to each other in every step.
4. The components go out with the tasks, which project every vector on them.

A third pass before the last measures the covariance of the whitened vectors,
whose mean is zero by the centring.

Defined cases: vectors that are NULL or hold a NULL or non-finite entry are
dropped; repeated rows and rows without an id count like any other.  Shorter
vectors count as padded with zeros, which become x = 1000000.  Entries stop at
``ENTRY_LIMIT``.  Components whose eigenvalue is lost in rounding beside the
largest (fewer vectors than dimensions, constant dimensions) cannot be scaled to
unit variance and are left out, so a table of less than two different vectors
gives no row.  ``deviation`` is NULL where it passes 64 bits;
``deviation_exact`` holds it to 38 digits.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
ENTRY_LIMIT = 1 << 52
#: Eigenvalues closer than this part of the matrix's norm form a cluster.
CLUSTER = 1e-3
#: Rows centred and multiplied at a time.
ROWS = 2048
_LONGS = 1 << 63


@dataclass(frozen=True)
class Sums:
    """Number of vectors and exact sum of each dimension."""

    n: int
    totals: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.totals], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        return [s % self.n for s in self.totals]


@dataclass(frozen=True)
class Whitening:
    sums: Sums
    #: By falling value.
    eigenvalues: np.ndarray
    #: (dimensions, components): unit vectors.
    vectors: np.ndarray
    trace: float


# Eigen solvers


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of a symmetric matrix by Householder reflections.

    The k-th reflector I - 2uu' works on the entries after the k-th.
    """
    a = np.array(matrix, dtype=np.float64)
    size = len(a)
    off, reflectors = np.zeros(max(0, size - 1)), []
    for k in range(size - 1):
        column = a[k + 1 :, k]
        u = column.copy()
        norm = np.sqrt((u * u).sum())
        # The sign that cannot cancel.
        head = -norm if u[0] > 0 else norm
        u[0] -= head
        length = np.sqrt((u * u).sum())
        if k == size - 2 or length == 0:
            off[k] = column[0]
            reflectors.append(np.zeros_like(u))
            continue
        u /= length
        off[k] = head
        reflectors.append(u)
        lower = a[k + 1 :, k + 1 :]
        p = lower @ u
        w = p - (u @ p) * u
        lower -= 2 * (np.outer(u, w) + np.outer(w, u))
    return a.diagonal().copy(), off, reflectors


def from_tridiagonal(reflectors: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """Vectors (in columns) of the tridiagonal matrix as those of the matrix it came from."""
    out = vectors.copy()
    for k in range(len(reflectors) - 1, -1, -1):
        u = reflectors[k]
        out[k + 1 :] -= 2 * np.outer(u, u @ out[k + 1 :])
    return out


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues are less than each value of ``at``."""
    # The least pivot whose quotients stay finite.
    tiny = np.finfo(float).tiny * max(1.0, float((off * off).max(initial=0.0)))
    below = np.zeros(len(at), dtype=np.int64)
    q = diagonal[0] - at
    for i in range(len(diagonal)):
        if i:
            q = diagonal[i] - at - off[i - 1] ** 2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected to the last digits of a double."""
    size = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low = np.full(k, (diagonal - reach).min() - 1e-300)
    high = np.full(k, (diagonal + reach).max())
    high += np.abs(high) * 1e-15 + 1e-300
    # The j-th largest has size - 1 - j eigenvalues below it.
    wanted = size - 1 - np.arange(k)
    eps = np.finfo(float).eps
    # Below this an eigenvalue is lost in the rounding of the matrix.
    least = eps * eps * np.abs(high).max()
    while True:
        middle = low + (high - low) / 2
        open_ = high - low > eps * np.maximum(np.abs(low), np.abs(high)) + least
        if not open_.any():
            return np.maximum.accumulate(middle[::-1])[::-1]
        above = count_below(diagonal, off, middle) > wanted
        high = np.where(open_ & above, middle, high)
        low = np.where(open_ & ~above, middle, low)


class _Shifted:
    """T - value*I factored with row exchanges, to solve for many right sides."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, value: float, norm: float):
        size, eps = len(diagonal), np.finfo(float).eps * norm
        d, first, second = (diagonal - value).tolist(), [*off.tolist(), 0.0], [0.0] * size
        self.steps = []
        for i in range(size - 1):
            below, next_d, next_first = float(off[i]), d[i + 1], first[i + 1]
            swap = abs(below) > abs(d[i])
            if swap:
                factor = d[i] / below
                d[i], d[i + 1] = below, first[i] - factor * next_d
                first[i], first[i + 1], second[i] = next_d, -factor * next_first, next_first
            else:
                d[i] = d[i] if abs(d[i]) > eps else eps
                factor = below / d[i]
                d[i + 1] = next_d - factor * first[i]
            self.steps.append((swap, factor))
        # An eigenvalue makes the last pivot vanish; the direction, not the size, of the solution counts.
        self.d = [p if abs(p) > eps else eps for p in d]
        self.first, self.second = first, second

    def solve(self, right: np.ndarray) -> np.ndarray:
        b = right.tolist()
        for i, (swap, factor) in enumerate(self.steps):
            if swap:
                b[i], b[i + 1] = b[i + 1], b[i]
            b[i + 1] -= factor * b[i]
        for i in range(len(b) - 1, -1, -1):
            rest = self.first[i] * b[i + 1] if i + 1 < len(b) else 0.0
            rest += self.second[i] * b[i + 2] if i + 2 < len(b) else 0.0
            b[i] = (b[i] - rest) / self.d[i]
        return np.array(b)


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit vectors (in columns) of falling eigenvalues by inverse iteration.

    Vectors of a cluster are made orthogonal to those before them in every round.
    """
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max() if len(off) else 0.0, np.finfo(float).tiny * 1e20)
    out = np.zeros((size, len(values)))
    random = np.random.default_rng(7)
    start, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            start = j
        # Equal values get shifts of their own, so that their systems differ.
        gap = 4 * np.finfo(float).eps * norm
        shift = min(value, shift - gap) if j > start else value
        system = _Shifted(diagonal, off, shift, norm)
        y = random.uniform(-1, 1, size)
        for _ in range(rounds):
            y = system.solve(y / np.abs(y).max())
            y /= np.abs(y).max()
            for _ in range(2):
                y -= out[:, start:j] @ (out[:, start:j].T @ y)
            y /= np.sqrt((y * y).sum())
        out[:, j] = y
    return out


def principal(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit vectors in columns) of the leading components that stand out of rounding."""
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, off, min(components, len(matrix)))
    least = len(matrix) * np.finfo(float).eps * 16 * max(values[0], 0.0)
    values = values[values > least]
    vectors = from_tridiagonal(reflectors, eigenvectors(diagonal, off, values))
    # Either sign will do; the largest entry is positive.
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(len(values))] < 0, -1.0, 1.0)


# Passes over the vectors


def finite(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """The rows whose vector takes part."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vectors.where(F.col(embedding).isNotNull() & F.forall(F.col(embedding), real))


def _entries(lists: pa.ListArray, width: int) -> np.ndarray:
    """Integer entries x, one row per vector."""
    lengths = np.diff(lists.offsets.to_numpy())
    filled = np.zeros((len(lists), width))
    filled[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
    return np.clip(np.floor(SCALE * filled), -ENTRY_LIMIT, ENTRY_LIMIT).astype(np.int64) + SHIFT


def _parts(batches, width: int):
    """(slice of the batch, its entries) a bounded number of rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part, _entries(part.column("v"), width)


def _vectors(rows: DataFrame, embedding: str, *more) -> DataFrame:
    return finite(rows, embedding).select(F.col(embedding).cast("array<double>").alias("v"), *more)


def _added(parts: DataFrame, keys: list[str], value: str) -> dict:
    """Sums of ``value`` by key; as many rows as there are keys."""
    return {tuple(r[k] for k in keys): r["total"] for r in parts.groupBy(*keys).agg(F.sum(value).alias("total")).collect()}


def sums(vectors: DataFrame, embedding: str = "embedding") -> Sums:
    rows = _vectors(vectors, embedding)
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = max(1, size["width"] or 0)

    def add(batches):
        high, low = [0] * width, [0] * width
        for _, x in _parts(batches, width):
            # Halves of 32 bits, whose sums stay within 64 bits.
            for half, part in ((high, x >> 32), (low, x & 0xFFFFFFFF)):
                for i, s in enumerate(part.sum(axis=0).tolist()):
                    half[i] += s
        totals = [Decimal((h << 32) + b) for h, b in zip(high, low)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(totals, pa.decimal128(38, 0))], names=["dimension", "total"]
        )

    found = _added(rows.mapInArrow(add, "dimension int, total decimal(38,0)"), ["dimension"], "total")
    return Sums(size["n"], tuple(int(found.get((i,), 0)) for i in range(width)))


def _centred(x: np.ndarray, of: Sums) -> np.ndarray:
    return (x - of.whole).astype(np.float64) - np.array([r / of.n for r in of.rest])


def _products(rows: DataFrame, of: Sums, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred vectors, or of their projections."""
    size = len(of.totals) if project is None else project.shape[1]

    def multiply(batches):
        total = np.zeros((size, size))
        for _, x in _parts(batches, len(of.totals)):
            d = _centred(x, of)
            d = d if project is None else d @ project
            total += d.T @ d
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "total"]
        )

    out = np.zeros((size, size))
    for (i, j), total in _added(rows.mapInArrow(multiply, "i int, j int, total double"), ["i", "j"], "total").items():
        out[i, j] = out[j, i] = total / of.n
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS, embedding: str = "embedding") -> Whitening:
    """The leading components of all vectors that take part."""
    of = sums(vectors, embedding)
    if not of.n:
        return Whitening(of, np.zeros(0), np.zeros((len(of.totals), 0)), 0.0)
    covariance = _products(_vectors(vectors, embedding), of)
    values, found = principal(covariance, components) if np.trace(covariance) > 0 else (np.zeros(0), np.zeros((len(of.totals), 0)))
    return Whitening(of, values, found, float(np.trace(covariance)))


def identity_error(vectors: DataFrame, model: Whitening, embedding: str = "embedding") -> float:
    """The largest entry, signs aside, of the whitened vectors' covariance minus the identity."""
    if not len(model.eigenvalues):
        return 0.0
    measured = _products(_vectors(vectors, embedding), model.sums, model.vectors / np.sqrt(model.eigenvalues))
    return float(np.abs(measured - np.eye(len(measured))).max())


def deviations(x: np.ndarray, of: Sums) -> list[int]:
    """For each row the sum of (n*x - S)^2, exactly.

    As n*x - S = n*d - r for d = x - q, it is n^2*A - 2n*B + C for A, B and C the sums of
    d^2, d*r and r^2; A and B are taken in 64 bits where they are sure to fit.
    """
    d, rest = x - of.whole, of.rest
    most = int(np.abs(d).max()) if d.size else 0
    if most * max(most, of.n) * d.shape[1] < _LONGS:
        a, b = (d * d).sum(axis=1).tolist(), (d @ np.array(rest, dtype=np.int64)).tolist()
    else:
        a = [sum(e * e for e in row) for row in d.tolist()]
        b = [sum(e * r for e, r in zip(row, rest)) for row in d.tolist()]
    c = sum(r * r for r in rest)
    return [of.n * of.n * p - 2 * of.n * s + c for p, s in zip(a, b)]


def whiten(vectors: DataFrame, model: Whitening, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact)."""
    rows = _vectors(vectors, embedding, F.col(vec_id).cast("bigint").alias("vec_id"))
    error, count = identity_error(vectors, model, embedding), len(model.eigenvalues)
    shared = vectors.sparkSession.sparkContext.broadcast((model, model.vectors / np.sqrt(model.eigenvalues)))

    def project(batches):
        known, scaled = shared.value
        share = known.eigenvalues / known.trace if count else known.eigenvalues
        for part, x in _parts(batches, len(known.sums.totals)):
            each = np.repeat(np.arange(len(x)), count)
            exact = deviations(x, known.sums)
            kept = pa.array(each)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(kept),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), known.sums.n, np.int64)),
                    pa.array([e if e < _LONGS else None for e in exact], pa.int64()).take(kept),
                    pa.array((_centred(x, known.sums) @ scaled).ravel()),
                    pa.array(np.tile(share, len(x))),
                    pa.array(np.full(len(each), error)),
                    pa.array([Decimal(e) if e < 10**38 else None for e in exact], pa.decimal128(38, 0)).take(kept),
                ],
                names=names,
            )

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]
    kinds = ["bigint", "int", "bigint", "bigint", "double", "double", "double", "decimal(38,0)"]
    return rows.mapInArrow(project, ", ".join(map(" ".join, zip(names, kinds))))
