"""Whitening of embeddings by contour integration.

Spark adds up the covariance over all rows; it is a matrix of the number of dimensions. Its spectrum is
then cut into intervals of a few eigenvalues each, and every interval is a task of its own:

    slices      a tridiagonal form of the same eigenvalues gives, by the signs of its pivots, how many lie
                below any shift (the inertia); cuts stand in gaps found by bisection of these counts
    project     a quadrature of (zI - V)^-1 Y along a half circle around an interval applies the projector
                onto its eigenvectors to a few random columns Y (FEAST; Polizzi, 2009)
    extract     Rayleigh-Ritz in the projected space gives eigenpairs; repeated until nothing is left over
    verify      an interval must give as many pairs as its inertia counts say, else the fit fails

The rows are projected onto the components in one more pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm.common import ship

COMPONENTS = 32
STEPS = 64  # an entry c becomes floor(STEPS * c) + SHIFT
SHIFT = 1_000_000
LARGEST = 2.0**40  # of STEPS * c: beyond, no sum of integers is safe
NODES = 8  # of the quadrature on half a circle
IN_INTERVAL = 6  # eigenvalues, more only where they stand too close together to cut
GAP = 1e-5  # of the largest eigenvalue: the least gap a cut stands in
ROUNDS = 40
TASKS_PER_CORE = 4  # each sends one triangle of the covariance


@dataclass(frozen=True)
class Whitening:
    size: int  # dimensions
    n: int  # rows of the fit
    sums: tuple[int, ...]  # of the integers, by dimension
    trace: float
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors as columns
    identity_error: float = 0.0

    @property
    def floors(self) -> np.ndarray:
        """Integers at most 1 below the means: rows less these are small, so nothing cancels."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rests(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floors).astype(float) - self.rests / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Of each row the sum of (n * x - sum) ** 2, exactly; null beyond a long."""
        near = x - self.floors
        if float(np.abs(near).max(initial=0) + 1) ** 2 * float(self.n) ** 2 * self.size < 2.0**62:
            return ((near * self.n - self.rests) ** 2).sum(axis=1).tolist()
        exact = ((near.astype(object) * self.n - self.rests.astype(object)) ** 2).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in exact]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, vector, size of the rows that take part."""
    near = F.forall("vector", lambda c: F.coalesce(F.abs(c) < LARGEST / STEPS, F.lit(False)))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return rows.filter(F.coalesce(near, F.lit(False))).withColumn("size", F.size("vector")).filter("size > 0")


def fit(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> Whitening | None:
    """The largest components of the covariance of all usable rows; None if there are none.

    Rows whose vector is null, empty or holds an entry that is null, not finite or 2**34 and beyond take no
    part. Of vectors of different numbers of dimensions the commonest number counts, of equally common ones
    the larger. Every row counts, also one that repeats another or has no key. Components without
    variance (below rounding of the largest) are none: fewer are returned, no rows for equal vectors.

    What reaches the driver is the covariance, a number for each pair of dimensions."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, key, vector)
    common = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return None
    size, n = common["size"], common["count"]
    rows = rows.filter(F.col("size") == size).select("id", "vector")
    total = _added(rows, lambda x: x.sum(axis=0), size, "decimal(38,0)")
    model = Whitening(size, n, tuple(int(s) for s in total), 0.0, np.zeros(0), np.zeros((size, 0)))
    upper = np.triu_indices(size)

    def products(of: Callable[[np.ndarray], np.ndarray], at: tuple) -> Callable[[np.ndarray], np.ndarray]:
        def work(x: np.ndarray) -> np.ndarray:
            z = of(x)
            return (z.T @ z)[at]

        return work

    covariance = _square(np.array(_added(rows, products(model.centred, upper), len(upper[0]), "double")) / n, size)
    values, columns = eigenpairs(covariance, components, spark)
    model = Whitening(size, n, model.sums, float(np.trace(covariance)), values, columns)
    if not len(values):
        return model
    # Rows are centred before they are projected, so this is the covariance of what is returned.
    at = np.triu_indices(len(values))
    found = _square(np.array(_added(rows, products(model.whitened, at), len(at[0]), "double")) / n, len(values))
    return Whitening(size, n, model.sums, model.trace, values, columns, float(np.abs(found - np.eye(len(values))).max()))


def whiten(vectors: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row with as many
    dimensions as the fit has, for each component from 1 on. Other columns are not read."""
    schema = f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    ship(vectors.sparkSession)
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    many = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                x, rows = _integers(batch), np.repeat(np.arange(batch.num_rows), many)
                columns = [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows), model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(rows)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(model.values / model.trace, len(x))),
                    pa.array(np.full(len(rows), model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = usable(vectors, key, vector).filter(F.col("size") == model.size).select("id", "vector")
    return rows.mapInArrow(run, schema)


def _integers(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    return np.floor(STEPS * flat.reshape(batch.num_rows, -1)).astype(np.int64) + SHIFT


def _square(upper: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = upper
    return out + np.triu(out, 1).T


def _added(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], size: int, kind: str) -> list:
    """Sums over all rows of what a function makes of blocks of them. A task adds up its own and sends one
    row; these are added by place, so no task gets more than a share of the places."""
    exact = kind != "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object if exact else float)
        for batch in batches:
            if batch.num_rows:
                total = total + of(_integers(batch))
        values = [Decimal(int(t)) for t in total] if exact else total
        yield pa.RecordBatch.from_arrays([pa.array([values], pa.list_(pa.decimal128(38, 0) if exact else pa.float64()))], ["sums"])

    context = rows.sparkSession.sparkContext
    parts = rows.coalesce(TASKS_PER_CORE * max(context.defaultParallelism, 1)).mapInArrow(run, f"sums array<{kind}>")
    added = parts.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    table = added.toArrow().sort_by("at")
    return table.column("value").to_pylist()


def eigenpairs(a: np.ndarray, most: int, spark=None) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix without negative ones, falling, and unit eigenvectors
    as columns; of each, the entry of largest magnitude is positive. With a session, every interval of
    the spectrum is a task; the matrix travels as a broadcast, 8 bytes for each pair of dimensions."""
    scale = np.abs(a).max(initial=0)
    if not scale:
        return np.zeros(0), np.zeros((len(a), 0))
    work = a / scale
    intervals = slices(work, most)
    if spark is None:
        found = [(v, c) for i in intervals for values, columns in [in_interval(work, *i)] for v, c in zip(values, columns.T)]
    else:
        shared = spark.sparkContext.broadcast(work)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    values, columns = in_interval(shared.value, row["low"], row["high"], row["count"])
                    arrays = [pa.array(values), pa.array(columns.T.tolist(), pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(arrays, ["value", "column"])

        tasks = spark.createDataFrame(intervals, "low double, high double, count int").repartition(len(intervals))
        found = [(r["value"], np.array(r["column"])) for r in tasks.mapInArrow(run, "value double, column array<double>").collect()]
        shared.unpersist()
    found = sorted(found, key=lambda pair: -pair[0])[:most]
    found = [pair for pair in found if pair[0] > nothing(len(a)) * found[0][0]]
    columns = np.array([c for _, c in found]).T
    return np.array([v for v, _ in found]) * scale, columns * np.sign(columns[np.abs(columns).argmax(axis=0), range(len(found))])


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The diagonal and what stands beside it after Householder reflections from both sides."""
    a = a.copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        size = v @ v
        if size:
            v *= np.sqrt(2 / size)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = p - v * (v @ p) / 2
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] -= v * (v @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def nothing(size: int) -> float:
    """Share of the largest eigenvalue that rounding may make out of none."""
    return 32 * size * np.finfo(float).eps


def below(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny ** 0.5
    pivot = diagonal[0] - shifts
    count = (pivot < 0).astype(int)
    for d, b in zip(diagonal[1:], beside):
        pivot = d - shifts - b * b / np.where(pivot == 0, tiny, pivot)
        count += pivot < 0
    return count


def slices(a: np.ndarray, most: int) -> list[tuple[float, float, int]]:
    """Intervals that hold the largest eigenvalues, each with its number of them by inertia."""
    diagonal, beside = tridiagonal(a)
    reach = np.abs(np.append(beside, 0)) + np.abs(np.append(0, beside))
    top = (diagonal + reach).max()
    low, high = np.full(len(a), (diagonal - reach).min()), np.full(len(a), top)
    above = np.arange(len(a), 0, -1)  # the k-th from above has this many below the shift once it lies above it
    for _ in range(60):
        middle = (low + high) / 2
        over = below(diagonal, beside, middle) >= above
        low, high = np.where(over, low, middle), np.where(over, middle, high)
    values = (low + high) / 2  # falling
    some = int(min(most, (values > nothing(len(a)) * top).sum()))
    gaps = np.append(values[:-1] - values[1:], np.inf)
    cuts, start = [top * (1 + GAP) + GAP * GAP], 0
    while start < some:
        ends = range(start + IN_INTERVAL // 2, min(start + IN_INTERVAL, len(a)) + 1)
        end = max((e for e in ends if e <= len(a)), key=lambda e: gaps[e - 1], default=len(a))
        while gaps[end - 1] < GAP * top:
            end += 1
        cuts.append(values[end - 1] - GAP * top if end == len(a) else (values[end - 1] + values[end]) / 2)
        start = end
    counts = below(diagonal, beside, np.array(cuts))
    return [(float(b), float(c), int(n - m)) for c, b, n, m in zip(cuts, cuts[1:], counts, counts[1:])]


def in_interval(a: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All eigenpairs of a symmetric matrix between two bounds, `count` by inertia."""
    size, middle, radius = len(a), (low + high) / 2, (high - low) / 2
    wide = min(size, 2 * count + 4)
    y = np.random.default_rng(size + count).standard_normal((size, wide))
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 + nodes))
    accuracy = 4 * (size + 4) * np.finfo(float).eps
    for _ in range(ROUNDS):
        projected = np.zeros_like(y)
        for turn, weight in zip(turns, weights):
            z = middle + radius * turn
            projected += weight / 2 * (radius * turn * np.linalg.solve(z * np.eye(size) - a, y.astype(complex))).real
        base, strength, _ = np.linalg.svd(projected, full_matrices=False)
        base = base[:, strength > strength[0] * 1e-14]
        values, small = np.linalg.eigh(base.T @ a @ base)
        y = base @ small
        left = np.linalg.norm(a @ y - y * values, axis=0)
        # Directions that the projector has put out leave noise, whose values may fall inside, but no pairs.
        good = (values > low) & (values < high) & (left <= accuracy)
        if good.sum() == count:
            return values[good], y[:, good]
    raise ArithmeticError(f"{good.sum()} of {count} eigenvalues found between {low} and {high}")
