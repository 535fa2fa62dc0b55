"""Nearest neighbours by inner product, as a block matrix join.

Queries and candidates are dealt into blocks; every pair of blocks is a tile. In a tile the vectors
are rounded to int8 and multiplied as matrices. Cauchy-Schwarz on what rounding took away bounds each
product, so whatever cannot be among a query's best is left out for certain; the surviving pairs are
recomputed in double precision and a heap keeps the best of each query. The best of all tiles meet in
one window per query. Nothing is approximate about the result.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingmill.llm.common import ship

NEAREST = 20
BLOCK_BYTES = 4_000_000  # of a block's vectors as floats
BLOCK_ROWS = 8192
STRIP = 256  # queries multiplied at a time
EXACT = 1024  # dimensions whose int8 products a float adds up exactly: 127 * 127 * 1024 < 2 ** 24
PAIRS = 500_000  # recomputed at a time


def usable(vector: str) -> Column:
    """Not null, without null or non-finite components, not zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False))


def search(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: of each query the k nearest rows, the nearest first, of equal ones
    the smaller vec_id; all candidates, if fewer.

    Every usable row is a candidate for every query with another key and as many dimensions. Rows
    without a key and vectors that are not usable take no part. Queries that share a key are one, the
    smallest vector by components. Candidates that share a key are all candidates. Components may be of any
    size; products beyond the largest double are infinite and tie. An empty table gives no rows; other
    columns, also of the results' names, are not read."""
    ship(vectors.sparkSession)
    rows = vectors.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("is_query"))
    rows = rows.filter(usable("vector")).withColumn("vector", F.col("vector").cast("array<double>")).withColumn("size", F.size("vector"))
    total = rows.agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col("is_query"), F.lit(False)).cast("long")).alias("q"), F.max("size").alias("size")).first()
    per_block = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(total["size"] or 1, 1))))
    blocks = [int(n or 0) // per_block + 1 for n in (total.q, total.n)]

    def dealt(frame: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        """Each row in its block, once for each block of the other side."""
        return frame.select(
            "id", "vector", "size",
            F.pmod(F.xxhash64("id", F.lit(own)), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
        )

    queries = rows.filter("is_query").groupBy("id", "size").agg(F.min("vector").alias("vector"))
    keys = ["size", "query_block", "block"]
    left = dealt(queries, "query_block", blocks[0], "block", blocks[1]).groupBy(*keys)
    right = dealt(rows, "block", blocks[1], "query_block", blocks[0]).groupBy(*keys)

    def tile(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = best_of_tile(*_matrix(queries), *_matrix(candidates), k)
        types = (("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))
        return pa.table({name: pa.array(column, kind) for (name, kind), column in zip(types, found)})

    best = left.cogroup(right).applyInArrow(tile, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids, flat.reshape(len(ids), -1) if len(ids) else np.zeros((0, 1))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and norms of what they stand for and of what rounding took away."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = np.finfo(float).tiny  # too small to divide
    small = np.rint(x / scale[:, None]).clip(-127, 127)
    stands = small * scale[:, None]
    return small.astype(np.int8), scale, np.linalg.norm(stands, axis=1), np.linalg.norm(x - stands, axis=1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int8 matrices, exactly: floats hold every sum of EXACT products."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT):
        out += a[:, at : at + EXACT].astype(np.float32) @ b[:, at : at + EXACT].T.astype(np.float32)
    return out


def inner(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows i of a and j of b, summed from the first component to the last, so
    equal vectors have equal products wherever they stand. Where that overflows on the way, the exact
    sum is rounded; it is infinite only if it is beyond the largest double."""
    out = np.zeros(len(i))
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(a.shape[1]):
            out += a[i, k] * b[j, k]
    for at in np.flatnonzero(~np.isfinite(out)).tolist():
        exact = sum(Fraction(x) * Fraction(y) for x, y in zip(a[i[at]].tolist(), b[j[at]].tolist()))
        try:
            out[at] = float(exact)
        except OverflowError:
            out[at] = np.inf if exact > 0 else -np.inf
    return out


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose largest component is from 0.5 to 1, and the powers of two they were divided by: norms
    and products of these neither overflow nor vanish."""
    power = np.frexp(np.abs(x).max(axis=1))[1]
    return np.ldexp(x, -power[:, None]), power


def first_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among any query's best: of equal vectors the k + 1 with the smallest ids, as
    ties go to the smaller id and one may be the query itself."""
    order = np.lexsort((ids, *vectors.T))
    same = np.append(False, (vectors[order[1:]] == vectors[order[:-1]]).all(axis=1))
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    return np.sort(order[np.arange(len(order)) - start <= k])


def best_of_tile(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[list[int], list[int], list[float]]:
    """Of each query the k best candidates of the tile, as lists of query ids, ids and scores."""
    out: tuple[list[int], list[int], list[float]] = ([], [], [])
    if not len(query_ids) or not len(ids):
        return out
    kept = first_copies(ids, vectors, k)
    ids, vectors = ids[kept], np.asfortranarray(vectors[kept])
    unit, power = scaled(vectors)
    small, scale, stands, lost = quantised(unit)
    whole = np.linalg.norm(unit, axis=1)
    for at in range(0, len(query_ids), STRIP):
        some = queries[at : at + STRIP]
        q_unit, q_power = scaled(some)
        q_small, q_scale, q_stands, q_lost = quantised(q_unit)
        # |x.y - x'.y'| = |x'.(y - y') + (x - x').y|; the margin covers rounding of the bound itself.
        error = np.outer(q_stands, lost) + np.outer(q_lost, whole)
        error += 1e-9 * np.outer(np.linalg.norm(q_unit, axis=1), whole)
        middle = product(q_small, small) * np.outer(q_scale, scale)
        own = query_ids[at : at + STRIP, None] == ids
        powers = q_power[:, None] + power
        with np.errstate(over="ignore"):  # bounds beyond the largest double are infinite, as are the products
            low, high = np.ldexp(middle - error, powers), np.ldexp(middle + error, powers)
        low = np.where(own, -np.inf, low)
        if low.shape[1] > k:
            limit = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k, None]
        else:
            limit = np.full((len(some), 1), -np.inf)
        i, j = np.nonzero((high >= limit) & ~own)
        scores = np.concatenate([inner(some, vectors, i[s : s + PAIRS], j[s : s + PAIRS]) for s in range(0, max(len(i), 1), PAIRS)])
        bounds = np.searchsorted(i, np.arange(len(some) + 1))
        for row, (a, b) in enumerate(zip(bounds, bounds[1:])):
            best = heapq.nsmallest(k, zip((-scores[a:b]).tolist(), ids[j[a:b]].tolist()))
            out[0].extend([int(query_ids[at + row])] * len(best))
            out[1].extend(x[1] for x in best)
            out[2].extend(-x[0] for x in best)
    return out
