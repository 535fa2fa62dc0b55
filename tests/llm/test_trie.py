"""The conversation trie against a trie of dictionaries; components of any size; odd rows and long conversations."""

import hashlib
import random
import zlib

import pytest

from filingmill.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, node int"


def brute_force(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(found)] for c, found in own.items()}
    members = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    totals = {}
    for path in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children.get(path, [])]
        saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        totals[path] = (sum(x for x, _ in below) or (0 if below else 1), saved + sum(y for _, y in below))
    out = []
    for path, found in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, end in found if end))
        parent = min(c for c, _ in members[path[:-1]]) if path else None
        row = (min(c for c, _ in found), len(path), parent, len(found), len(children.get(path, [])), *totals[path])
        out.append((*row, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def check(spark, rows, piece=trie.PIECE):
    found = trie.trie(spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA), piece)
    assert sorted(map(tuple, found.collect())) == brute_force(rows)


def branching(n, depth, words, seed=0):
    rng = random.Random(seed)
    return [(c, d, rng.choice("ua"), "x" * rng.choice(words)) for c in range(n) for d in range(rng.randint(1, depth))]


SHAPES = {
    "bushy": branching(60, 12, [0, 1, 2]),
    "wide": [(c, 0, "u", f"only {c}") for c in range(150)],
    "copies": [(c, d, "u", "same") for c in range(80) for d in range(c % 7 + 1)],
    "deep": [(c, d, "u", "same" if d < 150 else f"{c}") for c in (0, 5, 10) for d in range(160)],
    "odd": [
        (None, 1, "u", "no conversation"), (7, None, "u", "first"), (7, None, None, None), (7, 3, "u", "é€😀"), (7, 3, "u", "é€😀"),
        (7, 3, "a", "tie"), (-3, 1, "u", "negative"), (-5, 1, "u", ""), (-5, 2, None, "x"), (4, 1, "u", None), (10**15, 1, "u", "far"),
        *[(9, i, "u", "long " * 5000) for i in range(3)], *[(5, i, "u", "of five") for i in range(12)], (6, 0, "u", "short"), (6, 9, "u", "end"),
    ],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_equals_a_trie_of_dictionaries(spark, shape):
    check(spark, SHAPES[shape])


@pytest.mark.parametrize("shape", ["bushy", "deep"])
def test_rounds_over_large_components(spark, shape):
    check(spark, SHAPES[shape], piece=90)


def test_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 5)  # of hashed turns
    check(spark, branching(12, 40, [1], 3) + [(c, 0, "u", "hub") for c in range(200, 230)])


def test_empty_table(spark):
    found = trie.trie(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and "n_leaves" in found.columns


def deep_totals(component):
    parents = {(r[0], r[1]): (r[2], r[1] - 1) for r in component}
    totals = {k: [0, 0] for k in parents}
    for row in component:
        at = (row[0], row[1])
        while at in totals:
            totals[at][0] += row[4]
            totals[at][1] += row[5]
            at = parents[at]
    return sorted((*k, *v) for k, v in totals.items())


@pytest.mark.parametrize("seed", range(20))
def test_split_up_of_random_trees(seed):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 3, 30, 400])
    parent = [None] + [rng.randint(max(0, i - rng.choice([1, 3, 400])), i - 1) for i in range(1, n)]
    depth = [0] * n
    weight = [rng.randint(1, 5) for _ in range(n)]
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    for i in range(n - 1, 0, -1):
        weight[parent[i]] += weight[i]
    rows = [[i, depth[i], parent[i], weight[i], rng.randint(0, 1), rng.randint(0, 99), 0, 0] for i in range(n)]
    rows.sort(key=lambda r: r[1])
    assert sorted(trie.split_up(rows)) == deep_totals(rows)
