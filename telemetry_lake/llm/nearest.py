"""Approximate nearest neighbours by p-stable hashing with several probes per table.

The nearest are those of the largest inner product, whatever the vectors' norms, while hashing finds what is near in
distance. So candidates are put in bands of like norm; each band is scaled to norms of at most 1 by its own largest one,
and every vector gets one more coordinate that fills it up to norm 1. Against a query of norm 1 (with 0 there) distance
then falls as the inner product rises. A query visits its buckets in every band.

Every vector travels once, to a task that holds an equal share of all of them with tables of its own, whose lines are
the same in all tasks. Queries go to every task and come back with the best that it holds. With more vectors neighbours are
nearer, buckets fewer that may hold them, and the share of rows that a query meets falls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cache
from math import erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from telemetry_lake.session import scratch_path

MOST_LINES = 24
DRAWS = 256
SLICE = 128


@dataclass(frozen=True)
class Index:
    """Parameters of the hashing. Vectors come with norm 1 (see above).

    Norms of a band lie within a factor ``band`` of each other.

    A table has ``hashes`` lines of random direction (unless given: so many that a bucket of a task has about ``bucket``
    vectors), cut in cells of ``width`` from the vectors' middle on. ``reach`` cells lie on each side of it, the last
    ones open. Lines are at right angles as far as there are dimensions for that. A bucket is a cell of each line. A
    query visits the likeliest buckets of all tables, so many that a neighbour at ``distance`` lies in at least one of
    them with the estimated chance ``mass``. Unless given, the distance is that of the last wanted neighbour among as
    many random directions; neighbours that are nearer have a greater chance.
    """

    dimension: int
    tables: int = 6
    hashes: int | None = None
    width: float = 1.6
    distance: float | None = None
    mass: float = 0.91
    reach: int = 1
    seed: int = 17
    band: float = 1.25
    bucket: int = 256

    def bands(self, norms: np.ndarray) -> np.ndarray:
        return np.floor(np.log(norms) / log(self.band) + 0.5).astype(np.int64)

    def lines(self, count: int) -> np.ndarray:
        """Random directions, one a column; their coordinates have variance 1."""
        random = np.random.default_rng(self.seed)
        size = self.dimension + 1
        frames = [np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(-(-count // size))]
        return np.concatenate([np.zeros((size, 0)), *frames], axis=1)[:, :count] * sqrt(size)

    def near(self, rows: int, k: int) -> float:
        """Inner product with the last wanted neighbour: of random directions a share of ``k / rows`` is above it."""
        if self.distance is not None:
            return 1 - self.distance**2 / 2
        if rows <= 2 * k:
            return 0.0
        at = np.linspace(0, 1, 100_001)
        above = np.cumsum((np.maximum(1 - at * at, 0) ** ((self.dimension - 3) / 2 if self.dimension > 3 else 0))[::-1])[::-1]
        return float(at[np.searchsorted(-above / above[0] / 2, -k / rows)])


@dataclass(frozen=True)
class Band:
    """Vectors of like norm: the lines of their tables, their middle along them, and how neighbours spread there."""

    index: Index
    number: int
    largest: float
    lines: list[np.ndarray]
    middle: list[np.ndarray]
    near: float
    spread: float

    @property
    def cells(self) -> int:
        return 2 * self.index.reach

    def weights(self) -> np.ndarray:
        return self.cells ** np.arange(len(self.middle[0]), dtype=np.int64)[::-1]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Number of the bucket of each vector, table by table."""
        scaled = vectors / self.largest
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
        out, reach = [], self.index.reach
        for lines, middle in zip(self.lines, self.middle):
            along = (scaled @ lines[:-1] + rest[:, None] * lines[-1] - middle) / self.index.width
            out.append((np.clip(np.floor(along), -reach, reach - 1) + reach).astype(np.int64) @ self.weights())
        return np.stack(out)

    def chances(self, table: int, directions: np.ndarray) -> np.ndarray:
        """Logarithm of the chance that a neighbour lies in a cell: query, line, cell."""
        edges = np.arange(1 - self.index.reach, self.index.reach) * self.index.width
        away = self.near * (directions @ self.lines[table][:-1] - self.middle[table])
        below = _normal((edges - away[:, :, None]) / (self.spread * sqrt(max(1e-6, 1 - self.near**2))))
        whole = np.concatenate([np.zeros((*away.shape, 1)), below, np.ones((*away.shape, 1))], axis=2)
        return np.log(np.maximum(np.diff(whole, axis=2), 1e-6)).astype(np.float32)

    def least(self, directions: np.ndarray) -> np.ndarray:
        """The least chance (logarithm) of a bucket that a query visits; those above it hold the wanted mass.

        Buckets that neighbours may lie in are drawn from the estimated chances, and the bound is put where the wanted
        share of neighbours has a bucket above it in some table.
        """
        out = np.zeros(len(directions), np.float32)
        if not len(self.middle[0]):
            return out
        drawn = np.random.default_rng(self.index.seed + 1).random((len(self.lines), DRAWS, len(self.middle[0])), dtype=np.float32)
        for start in range(0, len(directions), 1024):
            some = directions[start : start + 1024]
            totals = np.zeros((len(self.lines), len(some), DRAWS), np.float32)
            for table in range(len(self.lines)):
                chances = self.chances(table, some)
                whole = np.cumsum(np.exp(chances), axis=2)
                for line in range(chances.shape[1]):
                    cell = np.zeros((len(some), DRAWS), np.int8)
                    for c in range(self.cells - 1):
                        cell += drawn[table, :, line] > whole[:, line, c, None]
                    for c in range(self.cells):
                        totals[table] += np.where(cell == c, chances[:, line, c, None], np.float32(0))
            low, high = totals.min(axis=(0, 2)), totals.max(axis=(0, 2))
            for _ in range(16):
                middle = (low + high) / 2
                missed = np.prod(1 - (totals >= middle[:, None]).mean(axis=2), axis=0)
                low, high = np.where(missed <= 1 - self.index.mass, middle, low), np.where(missed <= 1 - self.index.mass, high, middle)
            out[start : start + 1024] = low
        return out - np.float32(1e-4)

    def share(self) -> float:
        """Products that a query takes for each row, among random directions; a row counts in every table it is met in."""
        points = np.random.default_rng(self.index.seed + 2).standard_normal((2048, self.index.dimension))
        points /= np.linalg.norm(points, axis=1)[:, None]
        queries, met = points[:64], 0.0
        least = self.least(queries)
        for table, codes in enumerate(self.codes(points * self.largest)):
            chances, cells = self.chances(table, queries), codes[:, None] // self.weights() % self.cells
            met += (sum(chances[:, i][:, cells[:, i]] for i in range(cells.shape[1])) >= least[:, None]).mean()
        return float(met)


@cache
def _normal_steps() -> tuple[np.ndarray, np.ndarray]:
    at = np.linspace(-8, 8, 8001)
    return at, np.array([0.5 * (1 + erf(x / sqrt(2))) for x in at])


def _normal(x: np.ndarray) -> np.ndarray:
    return np.interp(x, *_normal_steps())


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """``vec_id`` and ``vector`` (array<float> where the column is, else array<double>) of the rows that take part.

    A vector that is null, empty, zero or holds a null or non-finite component takes no part, nor does a row without
    id. Rows repeated with one id and vector count once; an id with several vectors is one candidate, at its best score.
    """
    kind = "float" if isinstance(vectors.schema[column].dataType.elementType, FloatType) else "double"
    vector = F.col(column).cast(f"array<{kind}>")
    most, least, bound = F.array_max(vector), F.array_min(vector), F.lit(float("inf")).cast(kind)
    # Searching for NaN gives null where there is a null among others.
    fine = ~F.array_contains(vector, F.lit(float("nan")).cast(kind)) & (most < bound) & (least > -bound)
    return vectors.filter(F.col(key).isNotNull() & fine & ((most > 0) | (least < 0))).select(
        F.col(key).cast("bigint").alias("vec_id"), vector.alias("vector")
    )


def _matrix(batch: pa.RecordBatch, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return batch.column("vec_id").to_numpy(zero_copy_only=False), values.reshape(batch.num_rows, dimension) + values.dtype.type(0)


def _norms(x: np.ndarray) -> np.ndarray:
    """Euclidean norms, by the largest component so that no square leaves the range of doubles."""
    most = np.abs(x).max(axis=1).astype(float) if len(x) else np.zeros(0)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new value of the sorted keys begins, and the end."""
    size = len(keys[0])
    new = np.ones(size + 1, bool)
    if size:
        new[1:-1] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new) if size else np.zeros(1, np.int64)


def _ranks(sorted_keys: np.ndarray) -> np.ndarray:
    starts = _runs(sorted_keys)
    return np.arange(len(sorted_keys)) - np.repeat(starts[:-1], np.diff(starts))


def _best(at: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k`` ids for each ``at``, in order; every id once, at its best score."""
    order = np.lexsort((ids, -scores, at))
    order = order[_runs(at[order], ids[order])[:-1]]
    few = order[_ranks(at[order]) < 4 * k]
    again = few[np.lexsort((ids[few], at[few]))]
    if len(_runs(at[again], ids[again])) - 1 < len(few):
        order = np.lexsort((-scores, ids, at))
        order = order[_runs(at[order], ids[order])[:-1]]
        few = order[np.lexsort((ids[order], -scores[order], at[order]))]
    return few[_ranks(at[few]) < k]


class _Rows:
    """Rows as they come, in one place: about ``share`` of them are expected."""

    def __init__(self, share: int):
        self.share, self.count, self.ids, self.vectors = share + share // 50 + 4096, 0, None, None

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        end = self.count + len(ids)
        if self.ids is None or end > len(self.ids):
            size = max(self.share, end + end // 4)
            old = (self.ids[: self.count], self.vectors[: self.count]) if self.count else (ids[:0], x[:0])
            self.ids, self.vectors = np.empty(size, np.int64), np.empty((size, x.shape[1]), x.dtype)
            self.ids[: self.count], self.vectors[: self.count] = old
        self.ids[self.count : end], self.vectors[self.count : end] = ids, x
        self.count = end

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        return self.ids[: self.count], self.vectors[: self.count]


class _Held:
    """The rows of a task, and its tables: for each band of norms the rows in order of their buckets."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bands: dict[int, Band], index: Index, k: int):
        self.ids, self.vectors = ids, vectors
        of = np.concatenate([index.bands(_norms(vectors[i : i + 32768])) for i in range(0, len(ids), 32768)])
        live = self.rows = self._once(k)
        self.single = len(np.unique(self.ids[live])) == len(live)
        self.tables: list[tuple[Band, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]] = []
        for name in sorted(np.unique(of[live]).tolist(), reverse=True) if bands else ():
            rows, band = live[of[live] == name], bands[name]
            codes = np.concatenate([band.codes(self.vectors[rows[i : i + 32768]]) for i in range(0, len(rows), 32768)], axis=1)
            tables = []
            for own in codes:
                order = np.argsort(own, kind="stable")
                starts = _runs(own[order])
                tables.append((own[order[starts[:-1]]], starts, rows[order].astype(np.int32)))
            self.tables.append((band, tables))

    def _once(self, k: int) -> np.ndarray:
        """Rows that count: equal rows once. Of equal vectors, whose scores are equal, only ``k + 1`` ids can be wanted."""
        x = self.vectors
        odd = np.random.default_rng(0).integers(0, 1 << 62, x.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        marks = np.empty(len(x), np.uint64)
        for i in range(0, len(x), 32768):
            marks[i : i + 32768] = (x[i : i + 32768].view(f"<u{x.dtype.itemsize}") * odd).sum(axis=1, dtype=np.uint64)
        order = np.lexsort((self.ids, marks))
        same = marks[order][1:] == marks[order][:-1]
        if not same.any():
            return np.arange(len(x))
        at = np.flatnonzero(same)
        for i in range(0, len(at), 32768):
            part = at[i : i + 32768]
            same[part] = (x[order[part + 1]] == x[order[part]]).all(axis=1)
        run = np.cumsum(np.append(0, ~same))
        keep = np.append(True, ~(same & (self.ids[order][1:] == self.ids[order][:-1])))
        order, run = order[keep], run[keep]
        return np.sort(order[_ranks(run) <= k])


class _Chunk:
    """Queries that go through a task's rows together, and the best that each has met: rough scores, exact at the end.

    Rough scores are 32-bit products of scaled vectors. All that may be among the best ``k`` by exact products is kept.
    """

    def __init__(self, held: _Held, ids: np.ndarray, vectors: np.ndarray, bound: np.ndarray, unit: float, k: int):
        unit = 1.0 if 0.5 < unit < 2 else unit
        self.held, self.ids, self.vectors, self.unit, self.k = held, ids, vectors, unit, k
        self.norms = _norms(vectors)
        self.directions = vectors / self.norms[:, None]
        self.rough = self.directions.astype(np.float32)
        self.slack = np.float32(2 * (vectors.shape[1] + 8) * 6e-8)
        self.cut = (bound / self.norms / unit).astype(np.float32) - self.slack
        self.most = self.cut.max(initial=-np.inf)
        # Vectors that are 32-bit numbers of about norm 1 need no scaling.
        self.plain = held.vectors.dtype == np.float32 and unit == 1
        self.taken, self.space = np.empty((1024, vectors.shape[1]), np.float32), np.empty(512 * 1024, np.float32)
        self.seen = np.zeros(len(ids), np.int64)
        self.state = (np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.int32))
        self.pending, self.waiting = [], 0
        self.limit = max(1 << 16, k * len(ids))

    def meet(self, rows: np.ndarray, at: np.ndarray, largest: float) -> None:
        """Rows of a bucket against queries. Only what reaches the cut of its query is kept."""
        least = largest / self.unit + self.slack
        if least < self.most:
            at = at[self.cut[at] <= least]
        for low in range(0, len(rows), 512):
            some = rows[low : low + 512]
            x = self.held.vectors[some]
            x = x if self.plain else (x / self.unit).astype(np.float32)
            for first in range(0, len(at), 1024):
                self._products(some, x, at[first : first + 1024])
        if self.waiting > self.limit:
            self.settle()

    def _products(self, rows: np.ndarray, x: np.ndarray, at: np.ndarray) -> None:
        # Both are written in place each time, which spares the system new pages.
        queries = np.take(self.rough, at, axis=0, out=self.taken[: len(at)], mode="clip")
        scores = np.matmul(x, queries.T, out=self.space[: len(x) * len(at)].reshape(len(x), len(at)))
        cut = self.cut[at]
        fresh = np.flatnonzero(np.isneginf(cut)) if self.held.single and len(x) > self.k + 1 else ()
        if len(fresh):
            # One more than wanted, since the query itself may be among them.
            last = len(x) - self.k - 1
            cut[fresh] = np.partition(scores[:, fresh], last, axis=0)[last] - self.slack
        hit = np.flatnonzero(scores.max(axis=0) >= cut)
        if not len(hit):
            return
        some = np.take(scores, hit, axis=1, mode="clip")
        place = np.flatnonzero(some >= cut[hit])
        row, column = np.divmod(place, len(hit))
        score, query, row = some.ravel()[place], at[hit][column], rows[row]
        own = self.held.ids[row] == self.ids[query]
        if own.any():
            score, query, row = score[~own], query[~own], row[~own]
        self.pending.append((query, score, row))
        self.waiting += len(row)

    def settle(self) -> None:
        """What cannot be among the best ``k`` goes; the cuts rise."""
        at, score, row = (np.concatenate(a) for a in zip(self.state, *self.pending))
        self.pending, self.waiting = [], 0
        # A pair can come from several tables.
        key = (at.astype(np.uint64) << np.uint64(32)) | row.astype(np.uint64)
        order = np.argsort(key)
        order = order[_runs(key[order])[:-1]]
        at, score, row = at[order], score[order], row[order]
        bits = score.view(np.uint32)
        falling = np.where(bits >> 31, bits, ~(bits | np.uint32(1 << 31)))
        order = np.argsort((at.astype(np.uint64) << np.uint64(32)) | falling)
        at, score, row = at[order], score[order], row[order]
        if self.held.single:
            lasts = np.flatnonzero(_ranks(at) == self.k - 1)
            keep = np.ones(len(at), bool)
        else:
            ids = self.held.ids[row]
            first = np.lexsort((-score, ids, at))
            starts = _runs(at[first], ids[first])
            best = np.empty(len(at), np.float32)
            best[first] = np.repeat(score[first[starts[:-1]]], np.diff(starts))
            keep = score >= best - self.slack
            chosen = np.sort(first[starts[:-1]])
            lasts = chosen[_ranks(at[chosen]) == self.k - 1]
        self.cut[at[lasts]] = np.maximum(self.cut[at[lasts]], score[lasts] - self.slack)
        self.most = self.cut.max(initial=-np.inf)
        keep &= score >= self.cut[at]
        self.state = at[keep], score[keep], row[keep]

    def _exact(self) -> np.ndarray:
        at, _, row = self.state
        scores = np.empty(len(at))
        for start in range(0, len(at), 8192):
            part = slice(start, start + 8192)
            scores[part] = (self.held.vectors[row[part]].astype(float) * self.vectors[at[part]]).sum(axis=1)
        return scores

    def scale(self, largest: float) -> None:
        """Much smaller vectors follow: scores are told in their size, so that one precision fits them."""
        if largest * 4 >= self.unit:
            return
        self.settle()
        at, _, row = self.state
        with np.errstate(over="ignore"):
            self.cut *= np.float32(self.unit / largest)
            self.unit, self.plain, self.most = largest, False, np.inf
            self.state = at, (self._exact() / self.norms[at] / largest).astype(np.float32), row

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.settle()
        scores = self._exact()
        at, _, row = self.state
        ids = self.held.ids[row]
        top = _best(at, ids, scores, self.k)
        return at[top], ids[top], scores[top]


def _go_through(held: _Held, chunk: _Chunk, least: np.ndarray, enough: int) -> None:
    """Queries visit their buckets; ``least`` has a column for each band. Without any bound one table holds all.

    Rows are counted until each query has seen ``enough``.
    """
    gains, visits = np.empty((SLICE, len(chunk.ids)), np.float32), np.empty((SLICE, len(chunk.ids)), bool)
    few = True
    for band, tables in held.tables:
        chunk.scale(band.largest)
        limits = least[:, band.number]
        for table, (codes, starts, rows) in enumerate(tables[:1] if np.isneginf(limits).all() else tables):
            chances = band.chances(table, chunk.directions)
            # A bucket's chance is that of its first cells and what other cells gain or lose.
            base = chances[:, :, 0].sum(axis=1) - limits
            gain = (chances[:, :, 1:] - chances[:, :, :1]).reshape(len(chances), -1)
            weights = np.concatenate([gain, base[:, None]], axis=1).T
            for first in range(0, len(codes), SLICE):
                some = codes[first : first + SLICE]
                cells = some[:, None] // band.weights() % band.cells
                there = (cells[:, :, None] == np.arange(1, band.cells)).astype(np.float32).reshape(len(some), -1)
                there = np.append(there, np.ones((len(some), 1), np.float32), axis=1)
                visited = np.greater_equal(np.matmul(there, weights, out=gains[: len(some)]), 0, out=visits[: len(some)])
                ends = starts[first : first + len(some) + 1]
                if few:
                    chunk.seen += (np.diff(ends).astype(np.float32) @ visited.astype(np.float32)).astype(np.int64)
                    few = int(chunk.seen.min()) < enough
                for row, start, end in zip(visited, ends.tolist(), ends[1:].tolist()):
                    at = np.flatnonzero(row)
                    if len(at):
                        chunk.meet(rows[start:end], at, band.largest)


DEALT = "task int, kind int, block bigint, ids binary, vectors binary, limits binary, bounds binary"
ASKED = "block bigint, ids binary, vectors binary, limits binary, bounds binary, slots binary, found binary, scores binary"
FOUND = "block bigint, queries binary, slots binary, ids binary, scores binary, seen binary"


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [() for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields]
    )


def _gathered(batches: Iterator[pa.RecordBatch], dimension: int, size: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of several batches at once."""
    waiting, count = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(_matrix(batch, dimension))
            count += batch.num_rows
        if count >= size:
            yield tuple(np.concatenate(a) for a in zip(*waiting))
            waiting, count = [], 0
    if waiting:
        yield tuple(np.concatenate(a) for a in zip(*waiting))


def _bands(vectors: DataFrame, k: int, index: Index, rows: int) -> tuple[dict[int, Band], int, int]:
    """The bands by name, and the numbers of vectors and of tasks."""
    told_as = "band int, n bigint, largest double, total double, directions binary"

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list] = {}
        for _, x in _gathered(batches, index.dimension):
            norms = _norms(x)
            names = index.bands(norms)
            for name in np.unique(names).tolist():
                own = norms[names == name]
                n, largest, total, directions = known.get(name, (0, 0.0, 0.0, 0))
                total = total + (own / own.max()).sum() * own.max()
                known[name] = [n + len(own), max(largest, own.max()), total, directions + (x[names == name] / own[:, None]).sum(axis=0)]
        yield _rows(told_as, [(b, n, m, t, np.asarray(d, "<f8").tobytes()) for b, (n, m, t, d) in known.items()])

    # A band per factor of the norms there are: few, and at most as many as the range of doubles has.
    known: dict[int, list] = {}
    for name, n, largest, total, directions in vectors.mapInArrow(told, told_as).collect():
        old = known.get(name, [0, 0.0, 0.0, np.zeros(index.dimension)])
        known[name] = [old[0] + n, max(old[1], largest), old[2] + total, old[3] + np.frombuffer(directions)]
    count = sum(n for n, *_ in known.values())
    tasks = max(1, -(-count // min(rows, max(1 << 15, count // 12))))
    out = {}
    for number, (name, (n, largest, total, directions)) in enumerate(sorted(known.items(), reverse=True)):
        lines = index.hashes if index.hashes is not None else round(log(max(1, n / tasks / index.bucket)) / log(2 * index.reach))
        lines = min(MOST_LINES, max(0, lines))
        size = total / n / largest
        middle = np.append(directions / n * size, sqrt(max(0.0, 1 - size * size)))
        spread = sqrt(max(0.01, 1 - float(middle @ middle)))
        of = np.split(index.lines(lines * index.tables), index.tables, axis=1) if lines else [index.lines(0)]
        out[name] = Band(index, number, largest, of, [middle @ own for own in of], index.near(n, k), spread)
        if lines and index.hashes is None and out[name].share() >= 0.4:
            # Products in small buckets take about three times as long: so few rows are one bucket, with all neighbours.
            out[name] = replace(out[name], lines=[index.lines(0)], middle=[np.zeros(0)])
    return out, count, tasks


def nearest(vectors: DataFrame, queries: DataFrame, k: int, index: Index, rows: int = 3 << 18, sampled: int = 1 << 20) -> DataFrame:
    """The ``k`` nearest found by inner product for every query: ``query_id, rank, vec_id, score``.

    ``vectors`` and ``queries`` come from ``usable``; vectors of another dimension than the index's take no part. A
    query's own row is no candidate. A task holds about ``rows`` rows at most. From ``sampled`` vectors on each query
    first meets a sample of them, whose best ``k`` are candidates too, so a task need not tell what is worse. A query
    that met few rows (few vectors, or a lonely place) is then held against every bucket, so it gets all candidates if
    there are no more than ``k``.
    """
    spark = vectors.sparkSession
    sized = F.size("vector") == index.dimension
    vectors, queries = vectors.filter(sized), queries.filter(sized)
    bands, count, tasks = _bands(vectors, k, index, rows)
    sample = _sample(vectors, count, index) if count >= sampled else None
    enough = 4 * index.tables * k

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _gathered(batches, index.dimension):
            task = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % tasks
            order = np.argsort(task, kind="stable")
            starts = _runs(task[order])
            places = [order[a:b] for a, b in zip(starts[:-1], starts[1:])]
            yield _rows(DEALT, [(int(task[p[0]]), 0, 0, ids[p].tobytes(), x[p].tobytes(), None, None) for p in places])

    def ranked(asked: DataFrame, everywhere: bool) -> DataFrame:
        """The best ``k`` of each query; one that needs every bucket has a row of rank 0 (unless it had them)."""
        path = scratch_path(spark, "nearest_queries")
        pack = _packed(index, bands, sample, k, everywhere)
        asked.repartition("vec_id").sortWithinPartitions("vec_id").mapInArrow(pack, ASKED).write.parquet(path)
        blocks = spark.read.schema(ASKED).parquet(path)
        task = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task")
        sent = blocks.select(task, F.lit(1).alias("kind"), "block", "ids", "vectors", "limits", "bounds")
        both = vectors.mapInArrow(dealt, DEALT).unionByName(sent).repartitionById(tasks, "task")
        search = _searched(bands, index, [_kind(d) for d in (vectors, asked)], k, count // tasks, enough)
        met = both.sortWithinPartitions("task", "kind").mapInArrow(search, FOUND)
        own = blocks.select(
            "block", F.col("ids").alias("queries"), "slots", F.col("found").alias("ids"), "scores", F.lit(None).cast("binary").alias("seen")
        )
        hashed = any(len(band.middle[0]) for band in bands.values()) and not everywhere
        merge = _merged(k, enough if hashed else 0)
        merged = own.unionByName(met).repartition("block").sortWithinPartitions("block")
        return merged.mapInArrow(merge, "query_id bigint, rank int, vec_id bigint, score double")

    path = scratch_path(spark, "nearest")
    ranked(queries, False).write.parquet(path)
    first = spark.read.schema("query_id bigint, rank int, vec_id bigint, score double").parquet(path)
    short = first.filter(F.col("rank") == 0).select(F.col("query_id").alias("vec_id"))
    if short.isEmpty():
        return first
    rest = first.join(short.withColumnRenamed("vec_id", "query_id"), "query_id", "left_anti")
    return rest.select(first.columns).unionByName(ranked(queries.join(short, "vec_id", "left_semi"), True))


def _kind(vectors: DataFrame) -> str:
    return "<f4" if isinstance(vectors.schema["vector"].dataType.elementType, FloatType) else "<f8"


def _nothing() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)


def _sample(vectors: DataFrame, count: int, index: Index) -> Broadcast:
    """About one vector of 256 (60,000 at most) by the hash of its id, for all tasks."""
    share = max(256, count // 60_000)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _gathered(batches, index.dimension):
            yield _rows("ids binary, vectors binary", [(ids.tobytes(), x.tobytes())])

    some = vectors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(share)) == 0).mapInArrow(packed, "ids binary, vectors binary").collect()
    ids = np.frombuffer(b"".join(r["ids"] for r in some), "<i8")
    x = np.frombuffer(b"".join(r["vectors"] for r in some), _kind(vectors)).reshape(len(ids), -1)
    return vectors.sparkSession.sparkContext.broadcast((ids, x, float(_norms(x).max(initial=0.0))))


def _packed(index: Index, bands: dict[int, Band], sample: Broadcast | None, k: int, everywhere: bool) -> Callable:
    """Queries in order of ids, in blocks of about 4096, with their bounds; an id with several vectors is in one block."""
    count = 0

    def block(ids: np.ndarray, x: np.ndarray, held: _Held | None) -> pa.RecordBatch:
        nonlocal count
        count += 1
        context = TaskContext.get()
        number = ((context.partitionId() if context else 0) << 32) + count
        bounds, (at, found, scores) = np.full(len(ids), -np.inf), _nothing()
        if held is not None:
            chunk = _Chunk(held, ids, x, bounds, sample.value[2], k)
            chunk.meet(held.rows, np.arange(len(ids)), sample.value[2])
            at, found, scores = chunk.best()
            full = _ranks(at) == k - 1
            bounds[at[full]] = scores[full]
        directions = x / _norms(x)[:, None]
        limits = np.full((len(ids), len(bands)), -np.inf, np.float32)
        for band in () if everywhere else bands.values():
            limits[:, band.number] = band.least(directions)
        values = (ids, x, limits, bounds, at.astype(np.int32), found, scores)
        return _rows(ASKED, [(number, *(v.tobytes() for v in values))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(*sample.value[:2], {}, index, k) if sample is not None and len(sample.value[0]) else None
        rest: tuple[np.ndarray, np.ndarray] | None = None
        for ids, x in _gathered(batches, index.dimension, 4096):
            if rest is not None:
                ids, x = np.concatenate([rest[0], ids]), np.concatenate([rest[1], x])
            last = int(np.searchsorted(ids, ids[-1]))
            rest = ids[last:], x[last:]
            if last:
                yield block(ids[:last], x[:last], held)
        if rest is not None:
            yield block(*rest, held)

    return pack


def _searched(bands: dict[int, Band], index: Index, kinds: list[str], k: int, share: int, enough: int) -> Callable:
    """The rows of a task come first, then blocks of queries, of which about ``size`` go through its tables together."""
    size = 1 << 15

    def answer(held: _Held, blocks: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, x, limits, bounds = (np.concatenate([b[i] for b in blocks]) for i in (1, 2, 3, 4))
        chunk = _Chunk(held, ids, x, bounds, held.tables[0][0].largest, k)
        _go_through(held, chunk, limits, enough)
        at, found, scores = chunk.best()
        end = 0
        for number, own, *_ in blocks:
            start, end = end, end + len(own)
            low, high = np.searchsorted(at, [start, end])
            seen = np.minimum(chunk.seen[start:end], 1 << 30).astype(np.int32)
            values = ((at[low:high] - start).astype(np.int32), found[low:high], scores[low:high], seen)
            yield _rows(FOUND, [(number, None, *(v.tobytes() for v in values))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows, held, waiting = -1, None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["task"] != task:
                    if waiting:
                        yield from answer(held, waiting)
                    task, rows, held, waiting = row["task"], _Rows(share), None, []
                ids = np.frombuffer(row["ids"], "<i8")
                x = np.frombuffer(row["vectors"], kinds[row["kind"]]).reshape(-1, index.dimension)
                if row["kind"] == 0:
                    rows.add(ids, x)
                    continue
                if held is None and rows.count:
                    held = _Held(*rows.all(), bands, index, k)
                if held is not None:
                    limits = np.frombuffer(row["limits"], "<f4").reshape(len(ids), -1)
                    waiting.append((row["block"], ids, x, limits, np.frombuffer(row["bounds"], "<f8")))
                if sum(len(w[1]) for w in waiting) >= size:
                    yield from answer(held, waiting)
                    waiting = []
        if waiting:
            yield from answer(held, waiting)

    return search


def _merged(k: int, fewest: int) -> Callable:
    out = "query_id bigint, rank int, vec_id bigint, score double"

    def merge(rows: list[dict]) -> pa.RecordBatch:
        queries = np.frombuffer(next(r["queries"] for r in rows if r["queries"] is not None), "<i8")
        names, number = np.unique(queries, return_inverse=True)
        seen = np.zeros(len(names), np.int64)
        for r in rows:
            if r["seen"] is not None:
                np.add.at(seen, number, np.frombuffer(r["seen"], "<i4"))
        at = number[np.frombuffer(b"".join(r["slots"] for r in rows), "<i4")]
        ids = np.frombuffer(b"".join(r["ids"] for r in rows), "<i8")
        scores = np.frombuffer(b"".join(r["scores"] for r in rows), "<f8")
        top = _best(at, ids, scores, k)
        rank = _ranks(at[top]) + 1
        short = np.flatnonzero((np.bincount(at[top], minlength=len(names)) < k) | (seen < fewest)) if fewest else np.zeros(0, np.int64)
        columns = [names[np.append(at[top], short)], np.append(rank, np.zeros(len(short))).astype(np.int32)]
        columns += [np.append(ids[top], np.zeros(len(short), np.int64)), np.append(scores[top], np.zeros(len(short)))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in out.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if waiting and waiting[0]["block"] != row["block"]:
                    yield merge(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield merge(waiting)

    return run
