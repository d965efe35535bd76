"""Whitening of embeddings by principal components found with contour integration (FEAST).

Entries are put on a grid of whole numbers. Sums over rows are taken by Spark: an exact sum per dimension, then the
covariance of centred rows, one small matrix a task. The matrix, as wide as a vector is long, is bounded by the
dimension, and its components are found on it: inertia counts of the shifted matrix (signs in a Sturm sequence) give
an interval that holds the wanted eigenvalues; a quadrature of complex shifted solves on a circle around the interval
projects onto their space; Rayleigh-Ritz gives the components; counts at both ends verify that none is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.session import scratch_path

GRID, ORIGIN = 64, 1_000_000


# ---- the small matrix ------------------------------------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and lower diagonal of a tridiagonal matrix with the eigenvalues of a symmetric one (Householder)."""
    a = np.array(matrix, float)
    for i in range(len(a) - 2):
        x = a[i + 1 :, i].copy()
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        a[i + 1 :, :] -= 2 * np.outer(x, x @ a[i + 1 :, :])
        a[:, i + 1 :] -= 2 * np.outer(a[:, i + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, lower: np.ndarray, shift: float) -> int:
    """Inertia: how many eigenvalues of a tridiagonal matrix lie above ``shift``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    above, pivot = 0, 1.0
    squares = np.append(0.0, lower**2)
    for entry, square in zip(diagonal, squares):
        pivot = entry - shift - square / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return above


def _edge(counts: Callable[[float], bool], inside: float, outside: float) -> float:
    """Where a condition that holds ``inside`` and not ``outside`` ends."""
    for _ in range(70):
        middle = (inside + outside) / 2
        inside, outside = (middle, outside) if counts(middle) else (inside, middle)
    return outside


def interval(diagonal: np.ndarray, lower: np.ndarray, wanted: int) -> tuple[float, float, int]:
    """Bounds that hold the ``wanted`` largest eigenvalues of a positive semidefinite matrix, and how many they hold.

    They hold more where nearly equal ones would be cut apart, and fewer where the others are rounding noise.
    """
    radius = np.append(np.abs(lower), 0) + np.append(0, np.abs(lower))
    top = float((diagonal + radius).max())
    high, bottom = top * 1.001, -top * 1.001
    noise = top * len(diagonal) * np.finfo(float).eps * 8
    wanted = min(wanted, count_above(diagonal, lower, noise))
    low = _edge(lambda shift: count_above(diagonal, lower, shift) < wanted, high, noise)
    while low > noise:
        held = count_above(diagonal, lower, low)
        below = _edge(lambda shift: count_above(diagonal, lower, shift) == held, low, bottom)
        above = _edge(lambda shift: count_above(diagonal, lower, shift) == held, low, high)
        if above - below > 1e-7 * top:
            return (above + below) / 2, high, held
        low = below - 1e-7 * top
    held = count_above(diagonal, lower, noise)
    below = _edge(lambda shift: count_above(diagonal, lower, shift) == held, noise, bottom)
    above = _edge(lambda shift: count_above(diagonal, lower, shift) == held, noise, high)
    if above - below > 1e-7 * top:
        return (above + below) / 2, high, held
    return bottom, high, len(diagonal)


def components(matrix: np.ndarray, wanted: int, nodes: int = 16, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a positive semidefinite matrix, falling, and their unit vectors as columns.

    Eigenvalues that are rounding noise may be left out. Raises if the contour does not give as many eigenpairs as the inertia counts say, or not to double precision.
    """
    size = len(matrix)
    matrix = (matrix + matrix.T) / 2
    scale = float(np.abs(matrix).max(initial=0.0))
    if size == 0 or wanted <= 0 or scale == 0:
        return np.empty(0), np.empty((size, 0))
    scaled = matrix / scale
    diagonal, lower = tridiagonal(scaled)
    low, high, held = interval(diagonal, lower, min(wanted, size))
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    angles = np.pi / 2 * (1 - points)
    turns = np.exp(1j * angles)
    width = min(size, 2 * held + 8)
    basis = np.random.default_rng(7).standard_normal((size, width))
    eye, best = np.eye(size), None
    for _ in range(rounds):
        projected = np.zeros((size, width))
        for turn, weight in zip(turns, weights):
            solved = np.linalg.solve((centre + radius * turn) * eye - scaled, basis.astype(complex))
            projected += weight / 2 * (radius * turn * solved).real
        frame, _ = np.linalg.qr(projected)
        values, small = np.linalg.eigh(frame.T @ scaled @ frame)
        vectors = frame @ small
        inside = np.flatnonzero((values > low) & (values < high))
        basis = vectors
        if len(inside) != held:
            continue
        error = np.abs(scaled @ vectors[:, inside] - vectors[:, inside] * values[inside]).max()
        if best is None or error < best[0] / 2:
            best = error, values[inside], vectors[:, inside]
        elif best[0] < 1e-11:
            break
    if best is None or best[0] > 1e-11:
        raise ArithmeticError(f"contour integration found no {held} components between {low} and {high}")
    order = np.argsort(-best[1], kind="stable")[:wanted]
    values, vectors = best[1][order] * scale, best[2][:, order]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[largest, np.arange(len(order))])


# ---- rows ------------------------------------------------------------------------------------------------------


def _pack(grid: np.ndarray) -> list[bytes]:
    """Rows of whole numbers as bytes: 32 bits where all of a row fit, else 64, so that equal rows are equal bytes."""
    narrow = (np.abs(grid) < 2**31).all(axis=1)
    return [row.astype("<i4").tobytes() if fits else row.astype("<i8").tobytes() for row, fits in zip(grid, narrow)]


def _unpack(column: pa.Array, size: int) -> np.ndarray:
    return np.array([np.frombuffer(v, "<i4" if len(v) == 4 * size else "<i8") for v in column.to_pylist()], "i8").reshape(
        -1, size
    )


def gridded(vectors: DataFrame, size: int, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x`` (packed whole numbers) of the rows whose vector is complete and finite."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch["vector"].flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            grid = np.floor(GRID * entries)
            if (np.abs(grid) >= 2.0**52).any():
                raise OverflowError("an entry is too large for the grid")
            packed = pa.array(_pack(grid.astype("i8") + ORIGIN), pa.binary())
            yield pa.RecordBatch.from_arrays([batch["vec_id"], packed], names=["vec_id", "x"])

    return finite(vectors, key, column).mapInArrow(pack, "vec_id bigint, x binary")


def finite(vectors: DataFrame, key: str, column: str) -> DataFrame:
    vector = F.col(column).cast("array<double>")
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.filter(fine & (F.size(vector) > 0)).select(F.col(key).cast("bigint").alias("vec_id"), vector.alias("vector"))


def _cells(rows: DataFrame, size: int, sums: Callable[[np.ndarray], np.ndarray]) -> dict[int, float]:
    """Sums over all rows, one small array a task, added up per cell."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = sums(_unpack(batch["x"], size))
                total = found if total is None else total + found
        if total is not None:
            cells = pa.array(np.arange(total.size, dtype="i4"))
            yield pa.RecordBatch.from_arrays([cells, pa.array(total.ravel())], names=["cell", "value"])

    kind = "bigint" if sums(np.zeros((0, size), "i8")).dtype.kind == "i" else "double"
    found = rows.select("x").mapInArrow(partial, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value"))
    return dict(map(tuple, found.collect()))  # as many as an array has cells


@dataclass(frozen=True)
class Whitener:
    """Fitted components: rows of the fit list, their sums, eigenvalues, unit vectors, trace and the error measured."""

    count: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, grid: np.ndarray) -> np.ndarray:
        whole, rest = np.divmod(self.sums, self.count)
        return (grid - whole).astype(float) - rest / self.count

    def whiten(self, grid: np.ndarray) -> np.ndarray:
        # Summed row by row, so that equal rows have equal numbers whatever lies beside them.
        return np.einsum("ij,jk->ik", self.centred(grid), self.vectors) / np.sqrt(self.values)

    def deviations(self, grid: np.ndarray) -> np.ndarray:
        """Sum over dimensions of ``(n*x - S)**2``, exact; raises beyond 64 bits."""
        if float((self.centred(grid) ** 2).sum(axis=1).max(initial=0)) * float(self.count) ** 2 >= 2.0**62:
            raise OverflowError("a deviation does not fit 64 bits")
        whole, rest = np.divmod(self.sums, self.count)
        return ((self.count * (grid - whole) - rest) ** 2).sum(axis=1)


def fit(vectors: DataFrame, wanted: int = 16, key: str = "vec_id", column: str = "embedding") -> Whitener | None:
    """Components of the distinct gridded vectors; none without rows.

    Fewer than ``wanted`` where the covariance has a lower rank (directions whose variance is rounding noise).
    Vectors of different lengths raise. The distinct vectors are written to the shared folder once.
    """
    spark = vectors.sparkSession
    length = F.size("vector")
    least, most = finite(vectors, key, column).agg(F.min(length), F.max(length)).first()
    if least is None:
        return None
    if least != most:
        raise ValueError(f"vectors of {least} to {most} entries")
    path = scratch_path(spark, "fit_list")
    gridded(vectors, most, key, column).select("x").distinct().write.parquet(path)
    rows = spark.read.schema("x binary").parquet(path)

    def totals(grid: np.ndarray) -> np.ndarray:
        return np.append(grid.sum(axis=0), len(grid))

    found = _cells(rows, most, totals)
    empty = Whitener(found[most], np.array([found[i] for i in range(most)], "i8"), np.empty(0), np.empty((most, 0)), 0.0)

    def products(grid: np.ndarray) -> np.ndarray:
        centred = empty.centred(grid)
        return centred.T @ centred

    covariance = np.array([v for _, v in sorted(_cells(rows, most, products).items())]).reshape(most, most) / empty.count
    values, axes = components(covariance, wanted)
    real = values > max(values, default=0) * most * np.finfo(float).eps * 8
    fitted = Whitener(empty.count, empty.sums, values[real], axes[:, real], float(np.trace(covariance)))
    kept = int(real.sum())

    def whitened(grid: np.ndarray) -> np.ndarray:
        w = np.column_stack([fitted.whiten(grid), np.ones(len(grid))])
        return w.T @ w

    error = 0.0
    if kept:
        sums = np.array([v for _, v in sorted(_cells(rows, most, whitened).items())]).reshape(kept + 1, kept + 1)
        mean = sums[kept, :kept] / empty.count
        error = float(np.abs(sums[:kept, :kept] / empty.count - np.outer(mean, mean) - np.eye(kept)).max())
    return Whitener(fitted.count, fitted.sums, fitted.values, fitted.vectors, fitted.trace, error)


OUTPUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, fitted: Whitener | None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per vector and component, numbered from 1.

    Rows whose vector is null, empty or holds a null or non-finite entry take no part. Rows repeated, or with a null or
    repeated id, are rows of their own (equal vectors count once in the fit). Where no vector is left, or all are equal
    (no direction has variance), there are no rows. Other columns are not carried, so their names are free.
    """
    if fitted is None or not len(fitted.values):
        return vectors.sparkSession.createDataFrame([], OUTPUT)
    size, number = len(fitted.sums), len(fitted.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = _unpack(batch["x"], size)
            count = len(grid)
            columns = [
                batch["vec_id"].take(pa.array(np.repeat(np.arange(count), number))),
                pa.array(np.tile(np.arange(1, number + 1, dtype="i4"), count)),
                pa.array(np.full(count * number, fitted.count)),
                pa.array(np.repeat(fitted.deviations(grid), number)),
                pa.array(fitted.whiten(grid).ravel()),
                pa.array(np.tile(fitted.values / fitted.trace, count)),
                pa.array(np.full(count * number, fitted.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUTPUT.split(", ")])

    return gridded(vectors, size, key, column).mapInArrow(project, OUTPUT)
