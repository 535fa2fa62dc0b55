"""Whitening against a dense eigensolver, exact integers, odd vectors and degenerate spectra."""

from fractions import Fraction

import numpy as np
import pytest

from filingmill.llm import whitening
from filingmill.llm.queries import op12_whitening

SCHEMA = "vec_id long, embedding array<float>, component int, n string"


def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return q * np.array(values, float) @ q.T


SPECTRA = {
    "spread": [2.0**-i for i in range(40)],
    "equal": [1.0] * 30 + [0.5] * 10,
    "clusters": [5.0] * 9 + [5.0 - 1e-7] * 3 + [1.0] * 20 + [1e-6] * 10,
    "low rank": [3.0, 2.0, 1.0] + [0.0] * 20,
    "close": [1 + 1e-6 * i for i in range(50)],
    "linear": list(range(64, 0, -1)),
    "one": [7.0],
    "two": [7.0, 7.0],
}


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("most", [1, 5, 32])
def test_eigenpairs_equal_a_dense_solver(name, most):
    a = spectrum(SPECTRA[name])
    values, columns = whitening.eigenpairs(a, most)
    true = np.linalg.eigvalsh(a)[::-1]
    true = true[true > 1e-12 * true[0]][:most]
    assert np.allclose(values, true, rtol=1e-9, atol=1e-12 * true[0])
    assert np.allclose(columns.T @ columns, np.eye(len(values)), atol=1e-7)
    assert np.abs(a @ columns - columns * values).max() < 1e-11 * true[0]


def test_inertia_counts_and_slices():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 17, 64):
        a = np.cov(rng.normal(size=(size, 3 * size + 5))) if size > 1 else np.array([[2.0]])
        true = np.linalg.eigvalsh(a)
        diagonal, beside = whitening.tridiagonal(a)
        shifts = np.concatenate([[true[0] - 1, true[-1] + 1], (true[1:] + true[:-1]) / 2])
        assert (whitening.below(diagonal, beside, shifts) == [(true < s).sum() for s in shifts]).all()
        cut = whitening.slices(a, 32)
        assert sum(n for *_, n in cut) >= min(32, size) and all(n == ((true > b) & (true < c)).sum() for b, c, n in cut)
    assert not len(whitening.eigenpairs(np.zeros((4, 4)), 3)[0])
    with pytest.raises(ArithmeticError):
        whitening.in_interval(np.diag([1.0, 2.0, 3.0]), 1.5, 2.5, 2)  # one pair is not two


def expected(rows, size, components=32):
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) and abs(c) < 2.0**34 for c in v) and len(v) == size]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums)] for row in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [i for i, _ in good], n, exact, centred @ vectors / np.sqrt(values), values / np.trace(covariance)


def check(found, rows, size):
    ids, n, exact, white, explained = expected(rows, size)
    many = len(explained)
    place = lambda i, c, d: (i is None, i or 0, d or 0, c)
    found = sorted(found, key=lambda r: place(r.vec_id, r.component, r.deviation))
    exact = [d if d < 1 << 63 else None for d in exact]
    want = sorted(((ids[i], c, exact[i], i) for i in range(n) for c in range(1, many + 1)), key=lambda w: place(*w[:3]))
    assert [(r.vec_id, r.component, r.deviation) for r in found] == [w[:3] for w in want]
    got = np.array([r.whitened for r in found])
    true = np.array([white[i, c - 1] for _, c, _, i in want])
    at = np.array([w[1] for w in want])
    turned = np.array([0, *(np.sign((got * true)[at == c].sum()) for c in range(1, many + 1))])
    assert np.allclose(got * turned[at], true, atol=1e-7)
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-8 and np.allclose([r.explained for r in found], explained[at - 1], rtol=1e-8)


def test_equals_a_dense_solver_on_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=40).astype(np.float32).tolist()) for i in range(200)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[9][1]), (None, rows[3][1])] + [(900 + i, [0.25] * 40) for i in range(60)]
    nan, inf = float("nan"), float("inf")
    rows += [(500, None), (501, []), (502, [nan] * 40), (503, [0.0] * 39 + [inf]), (504, [None] * 40), (505, [1.0, 2.0]), (506, [3e38] * 40), (507, [-0.0] * 40)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    check(whitening.whiten(frame, whitening.fit(frame)).collect(), rows, 40)


def test_large_entries_few_rows_and_none(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=3) * 2.0**30).astype(np.float32).tolist()) for i in range(12)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    check(whitening.whiten(frame, whitening.fit(frame)).collect(), rows, 3)  # deviations beyond a long are null
    for few in (frame.limit(0), frame.limit(1), frame.filter("vec_id = 1").union(frame.filter("vec_id = 1"))):
        found = whitening.whiten(few, whitening.fit(few))
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert found.count() == 0  # no variance, no component
    two = frame.limit(2)
    assert {r.component for r in whitening.whiten(two, whitening.fit(two)).collect()} == {1}


def test_query_equals_a_dense_solver(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(op12_whitening(spark, folder).collect(), rows, len(rows[0][1]))
