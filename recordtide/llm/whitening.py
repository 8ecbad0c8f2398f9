"""Whitening of embeddings: principal components of their covariance, and every vector projected on them at unit variance.

Entries are put on an integer grid first, so that counts, sums and distances are exact. The mean is worked out exactly in
Spark; the scatter of the centred vectors is summed up per task, in bands of the matrix, which are added in two rounds. What
reaches the driver is that one matrix, whose size is the square of the vectors' dimension whatever the number of rows. There it
is factored by Cholesky's method with pivoting, and Jacobi rotations are applied to the columns of the triangular factor itself
until they are orthogonal: their squared norms are the eigenvalues and the columns over their norms the components. This works
on the factor, not on the matrix, so small eigenvalues keep their digits.

A row whose vector is null or empty, or holds a null, a NaN, an infinity or an entry that passes 62 bits on the grid, is
dropped. The dimension is the commonest length of the rest (the greater of equally common ones); rows of other lengths are
dropped, as they lie in another space. Null and repeated ids pass through, repeated rows count each for itself, other columns
are ignored. There are no more components than the covariance has rank: equal vectors, a single one or none give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
#: Numbers of the scatter matrix in one row of a partial sum: 1 MB.
BAND = 131_072
#: Partial sums of a band are added in so many groups first.
SALTS = 16
_GRID_LIMIT = 2.0**62
#: Lengths for which a task keeps sums at a time.
_LENGTHS_HELD = 256


@dataclass(frozen=True)
class Whitening:
    """A fitted model. Column ``k`` of ``axes`` is component ``k + 1``, of variance ``eigenvalues[k]``."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def offsets(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole part of the mean, and the remainder of the sums."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([s - w * self.n for s, w in zip(self.sums, whole)], np.int64)

    def centred(self, grid: np.ndarray) -> np.ndarray:
        whole, rest = self.offsets()
        return (grid - whole).astype(np.float64) - rest / self.n


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: the length, positions of rows and their grid entries, sound rows only."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry becomes NaN
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        found = np.floor(values[starts[rows][:, None] + np.arange(length)] * SCALE)
        with np.errstate(invalid="ignore"):
            sound = (np.abs(found) < _GRID_LIMIT).all(axis=1)
        if sound.any():
            yield length, rows[sound], found[sound].astype(np.int64) + SHIFT


_SUMS = pa.schema([("length", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0)))])


def _summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[int, list[int]]] = {}

    def told() -> pa.RecordBatch:
        rows = [(k, n, [Decimal(s) for s in sums]) for k, (n, sums) in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SUMS)], schema=_SUMS)

    for part in parts:
        for length, _, grid in _vectors(part.column(1)):
            # Halves of 31 bits each: their sums over a batch cannot pass 64 bits.
            high, low = (grid >> 31).sum(axis=0).tolist(), (grid & 0x7FFFFFFF).sum(axis=0).tolist()
            n, sums = held.get(length, (0, [0] * length))
            held[length] = n + len(grid), [s + (h << 31) + w for s, h, w in zip(sums, high, low)]
        if len(held) > _LENGTHS_HELD:
            yield told()
    if held:
        yield told()


_BANDS = pa.schema([("band", pa.int32()), ("salt", pa.int32()), ("numbers", pa.binary())])


def _bands(rows: Iterator[tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for band, salt, numbers in rows:
        yield pa.RecordBatch.from_arrays([pa.array([band], pa.int32()), pa.array([salt], pa.int32()), pa.array([numbers.tobytes()], pa.binary())], schema=_BANDS)


def _scatter(model: Whitening):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((model.dimension, model.dimension))
        for part in parts:
            for length, _, grid in _vectors(part.column(1)):
                if length == model.dimension:
                    z = model.centred(grid)
                    total += z.T @ z
        task = TaskContext.get()
        flat, salt = total.reshape(-1), (task.partitionId() if task else 0) % SALTS
        if flat.any():
            yield from _bands((k // BAND, salt, flat[k : k + BAND]) for k in range(0, len(flat), BAND))

    return go


def _added(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up what comes for each band and salt."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for part in parts:
        for band, salt, numbers in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
            numbers = np.frombuffer(numbers.as_py())
            held[band, salt] = held[band, salt] + numbers if (band, salt) in held else numbers
    yield from _bands((band, salt, numbers) for (band, salt), numbers in held.items())


def cholesky_factor(matrix: np.ndarray) -> np.ndarray:
    """``G`` of full column rank with ``G @ G.T == matrix``: the triangular factor under pivoting, its rows in the matrix' order."""
    d = len(matrix)
    left, order, factor = matrix.copy(), np.arange(d), np.zeros((d, d))
    least = float(np.diag(matrix).max(initial=0.0)) * d * np.finfo(float).eps
    for k in range(d):
        best = k + int(np.argmax(np.diag(left)[k:]))
        if left[best, best] <= least:
            return factor[np.argsort(order), :k]
        for swapped in (left, factor):
            swapped[[k, best]] = swapped[[best, k]]
        left[:, [k, best]] = left[:, [best, k]]
        order[[k, best]] = order[[best, k]]
        factor[k, k] = math.sqrt(left[k, k])
        factor[k + 1 :, k] = left[k + 1 :, k] / factor[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor[np.argsort(order)]


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``factor @ factor.T``, falling, and their unit eigenvectors as columns.

    Columns are rotated in pairs until all are orthogonal. A sweep meets every pair once, in rounds of disjoint pairs, as in a
    round robin, so that the pairs of a round are rotated at once.
    """
    d, r = factor.shape
    columns = np.ascontiguousarray(np.hstack([factor, np.zeros((d, r % 2))]).T)  # a row each; a null one makes the number even
    ring, enough = list(range(len(columns))), np.finfo(float).eps * math.sqrt(max(d, 1))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(ring) - 1):
            p, q = np.array(ring[: len(ring) // 2]), np.array(ring[: len(ring) // 2 - 1 : -1])
            x, y = columns[p], columns[q]
            a, b, g = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            size = np.sqrt(a * b)
            turn = np.abs(g) > enough * size
            if turn.any():
                worst = max(worst, float((np.abs(g[turn]) / size[turn]).max()))
                zeta = (b[turn] - a[turn]) / (2 * g[turn])
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                s = (c * t)[:, None]
                c = c[:, None]
                columns[p[turn]], columns[q[turn]] = c * x[turn] - s * y[turn], s * x[turn] + c * y[turn]
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if worst <= enough:
            break
    norms = np.sqrt((columns * columns).sum(axis=1))
    order = np.argsort(-norms, kind="stable")[:r]
    return norms[order] ** 2, (columns[order] / norms[order, None]).T


def _narrow(vectors: DataFrame, key: str, column: str) -> DataFrame:
    return vectors.select(vectors[key].cast("long").alias("vec_id"), vectors[column].cast("array<double>").alias("vector"))


def fit(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> Whitening | None:
    """Mean, components and eigenvalues over all sound vectors; None if there are none."""
    narrow = _narrow(vectors, key, column)
    partial = narrow.mapInArrow(_summed, "length int, n long, sums array<decimal(38,0)>")
    by_place = partial.select("length", "n", F.posexplode("sums").alias("place", "s")).groupBy("length", "place")
    sums = by_place.agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).groupBy("length").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "s"))).alias("sums")
    )  # one number per dimension, whatever the number of rows
    top = sums.orderBy(F.desc("n"), F.desc("length")).first()
    if top is None:
        return None
    d, bare = top["length"], np.zeros(0)
    model = Whitening(top["n"], tuple(int(x["s"]) for x in top["sums"]), bare, bare, 0.0)
    bands = narrow.mapInArrow(_scatter(model), "band int, salt int, numbers binary")
    for salt in (F.col("salt"), F.lit(0)):
        spread = bands.withColumn("salt", salt).repartition("band", "salt")
        bands = spread.mapInArrow(_added, "band int, salt int, numbers binary")
    matrix = np.zeros(d * d)
    for row in bands.collect():
        numbers = np.frombuffer(row["numbers"])
        matrix[row["band"] * BAND : row["band"] * BAND + len(numbers)] = numbers
    covariance = matrix.reshape(d, d) / model.n
    covariance = (covariance + covariance.T) / 2
    eigenvalues, axes = jacobi(cholesky_factor(covariance))
    return Whitening(model.n, model.sums, axes, eigenvalues, float(np.trace(covariance)))


def _projected(model: Whitening, grid: np.ndarray, k: int) -> np.ndarray:
    return model.centred(grid) @ (model.axes[:, :k] / np.sqrt(model.eigenvalues[:k]))


def _moments(model: Whitening, k: int):
    """Sums of the projections and of their products, by place."""

    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for part in parts:
            for length, _, grid in _vectors(part.column(1)):
                if length == model.dimension:
                    w = _projected(model, grid, k)
                    total += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.reshape(-1))], names=["place", "s"])

    return go


def identity_error(vectors: DataFrame, model: Whitening, components: int = COMPONENTS, key: str = "vec_id", column: str = "embedding") -> float:
    """Largest absolute entry of the projections' covariance, as measured over all rows, less the identity."""
    k = min(components, len(model.eigenvalues))
    rows = _narrow(vectors, key, column).mapInArrow(_moments(model, k), "place int, s double").groupBy("place").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((k + 1) * k)
    for row in rows:
        total[row["place"]] = row["s"]
    mean, products = total[:k] / model.n, total[k:].reshape(k, k) / model.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


_WHITENED = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


def deviations(model: Whitening, grid: np.ndarray) -> pa.Array:
    """Sums over dimensions of ``(n * x - sum) ** 2``, exactly; null beyond 38 digits."""
    whole, rest = model.offsets()
    away = grid - whole
    if model.dimension * (model.n * (int(np.abs(away).max(initial=0)) + 1)) ** 2 < 2**63:
        return pa.array(((away * model.n - rest) ** 2).sum(axis=1)).cast(pa.decimal128(19, 0)).cast(pa.decimal128(38, 0))
    parts = [[x * model.n - r for x, r in zip(row, rest.tolist())] for row in away.tolist()]
    totals = [sum(x * x for x in row) for row in parts]
    return pa.array([Decimal(t) if t < 10**38 else None for t in totals], pa.decimal128(38, 0))


def _whitened(model: Whitening, k: int):
    explained = model.eigenvalues[:k] / model.trace if k else np.zeros(0)

    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for length, rows, grid in _vectors(part.column(1)):
                if length != model.dimension:
                    continue
                m, each = len(grid), pa.array(np.repeat(np.arange(len(grid)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n, np.int64)), deviations(model, grid).take(each),
                        pa.array(_projected(model, grid, k).reshape(-1)), pa.array(np.tile(explained, m)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained"],
                )

    return go


def whiten(vectors: DataFrame, model: Whitening | None, components: int = COMPONENTS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained`` of every sound vector and each of the first components."""
    k = min(components, len(model.eigenvalues)) if model else 0
    narrow = _narrow(vectors, key, column)
    if not k:
        return narrow.limit(0).mapInArrow(lambda parts: (p for p in ()), _WHITENED)
    return narrow.mapInArrow(_whitened(model, k), _WHITENED)
