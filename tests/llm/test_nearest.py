"""Nearest neighbours against all products; bounds; odd vectors."""

from fractions import Fraction
from functools import reduce
from operator import add, mul

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingmill.llm import nearest


def brute_force(rows, k):
    def good(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    usable = [(i, v) for i, v in rows if i is not None and good(v)]
    queries = {}
    for i, v in usable:
        if i % 20 == 0:
            queries.setdefault((i, len(v)), v)
            queries[i, len(v)] = min(queries[i, len(v)], v)
    out = []
    for (q, size), x in queries.items():
        found = [(-reduce(add, map(mul, x, y)), i) for i, y in usable if i != q and len(y) == size]
        out += [(q, r, i, -s + 0.0) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def rows_of(rng, n, dims):
    rows = [(i, rng.normal(size=dims).astype(np.float32).tolist()) for i in range(n)]
    common = rng.normal(size=dims).astype(np.float32).tolist()
    rows += [(n + i, common) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * dims, [nan] * dims, [1.0] * (dims - 1) + [inf], [1.0] * (dims - 1) + [None], [1e-40] * dims, [3e38] * dims, [1.0, 2.0]]
    rows += [(2000 + 20 * i, v) for i, v in enumerate(odd)]
    rows += [(2003, [1.0, 5.0]), (None, common), (40, common), (41, common), (41, common)]
    return rows


@pytest.mark.parametrize("block", [nearest.BLOCK_ROWS, 37])
def test_equals_all_products(spark, monkeypatch, block):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", block)
    rows = rows_of(np.random.default_rng(0), 150, 8)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = nearest.search(frame, F.col("vec_id") % 20 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == brute_force(exact, 20)
    assert nearest.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    for dims in (3, 64, 2500):
        a, b = rng.normal(size=(20, dims)), rng.normal(size=(300, dims)) * rng.exponential(size=(300, 1))
        (sa, ca, na, la), (sb, cb, _, lb) = nearest.quantised(a), nearest.quantised(b)
        assert (nearest.product(sa, sb) == sa.astype(int) @ sb.T.astype(int)).all()
        middle = nearest.product(sa, sb) * np.outer(ca, cb)
        assert (np.abs(a @ b.T - middle) <= np.outer(na, lb) + np.outer(la, np.linalg.norm(b, axis=1)) + 1e-9).all()


def test_copies_beyond_the_nearest_are_left_out():
    ids = np.array([5, 3, 9, 1, 7])
    vectors = np.array([[1.0], [1.0], [1.0], [2.0], [1.0]])
    assert nearest.first_copies(ids, vectors, 1).tolist() == [0, 1, 3]


def test_huge_and_tiny_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1.0, 2.0]), (3, [3.0, 4.0]), (4, [1e-200, 1e-200]), (5, [-1e200, -1e200]),
            (6, [1e300, -1e300]), (20, [1e-200, 0.0]), (40, [1e-320, 1e-310]), (60, [1.0, -1.0]), (80, [1e308, 1e308])]
    rows += [(100 + i, [float(i), 1e200 * (i % 3 - 1)]) for i in range(1, 60)]

    def exact(x, y):
        value = sum(Fraction(a) * Fraction(b) for a, b in zip(x, y))
        try:
            return float(value)
        except OverflowError:
            return float("inf") if value > 0 else -float("inf")

    found = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: r.rank):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q, x in rows:
        if q % 20 == 0:
            best = sorted((-exact(x, y), i) for i, y in rows if i != q)[:20]
            assert [i for i, _ in by_query[q]] == [i for _, i in best]
            assert [s for _, s in by_query[q]] == pytest.approx([-s for s, _ in best], rel=1e-12)
