"""The similarity join against all pairs; its bounds; groups of copies; odd rows."""

import itertools
import random
import re
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filingmill.llm import components, jaccard


def shingles(text, words=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return set()
    n = min(words, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)}


def brute_force(rows):
    """(doc_id, set size, component) of every row."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if i is not None and j is not None and a and b and 100 * len(a & b) >= 90 * len(a | b):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def corpus(rng, n=400):
    vocabulary = [f"w{i}" for i in range(400)]
    rows, texts = [], []
    passage = rng.choices(vocabulary, k=80)
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.55:
            words = edited(rng, rng.choice(texts), rng.choice([0, 1, 1, 2, 3, 4, 8]))
            if rng.random() < 0.3:
                words = words[: max(1, len(words) - rng.randrange(1, 8))]
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 9, 12, 20, 40, 60, 150, 400]))
            words += passage * (rng.random() < 0.2)
        texts.append(words)
        rows.append((1000 - i, " ".join(words)))
    return rows


def join(spark, rows):
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, n long, node int")
    return sorted((tuple(r) for r in jaccard.similarity_join(docs).collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_equals_all_pairs(spark, seed):
    rows = corpus(random.Random(seed))
    assert join(spark, rows) == brute_force(rows)


def test_a_group_without_its_original(spark):
    """Copies of a text that is not there: some are linked, some only through others, some not at all."""
    rng = random.Random(5)
    words = [f"x{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rng, words, 1 + i % 4))) for i in range(160)]
    chain = [(500 + i, " ".join([f"c{j}" for j in range(3 * i, 3 * i + 120)])) for i in range(40)]
    assert join(spark, rows + chain) == brute_force(rows + chain)


def test_odd_rows(spark):
    rows = [(1, "a b c d"), (2, "A\tb  c\x0bd"), (3, None), (4, ""), (5, " \n"), (6, "a"), (7, "A"), (8, "a b"), (9, "É b c"), (10, "é b c"),
            (None, "a b c d"), (None, "q"), (11, "t u v"), (11, "t u v"), (12, "t u v"), (13, "m n o p"), (13, "a b c d"),
            (14, "long " * 100_000 + "a b c"), (15, "LONG " * 90_000 + "a b c")]
    found = join(spark, rows)
    expected = brute_force([r for r in rows if r[0] != 13])
    assert [r for r in found if r[0] != 13] == [(i, n, None if i is None else c) for i, n, c in expected]
    assert {r[2] for r in found if r[0] == 13} == {1}  # by the row that is linked
    assert join(spark, []) == []


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 300), st.integers(0, 40), st.integers(0, 40), st.integers(0, 2**32), st.sampled_from([90, 80]))
def test_similar_sets_share_a_segment(n, more_a, more_b, seed, percent):
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 2**64, n + more_a + more_b, np.uint64))
    rng.shuffle(pool)
    a, b = np.sort(pool[: n + more_a]), np.sort(np.append(pool[:n], pool[n + more_a :]))
    if 100 * n >= percent * len(pool) and len(a) + len(b) > 2 * n:
        shared = set(jaccard.segment_keys(a, percent)) & set(jaccard.segment_keys(b, percent))
        assert len(shared) >= max(jaccard.least_shared(len(x), percent) for x in (a, b))


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 300), st.integers(0, 60), st.integers(0, 60), st.integers(0, 2**32), st.sampled_from([90, 80]))
def test_similar_sets_share_the_front_of_the_order(n, more_a, more_b, seed, percent):
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 2**64, n + more_a + more_b, np.uint64))
    rng.shuffle(pool)
    a, b = np.sort(pool[: n + more_a]), np.sort(np.append(pool[:n], pool[n + more_a :]))
    if 100 * n >= percent * len(pool) and len(a) + len(b) > 2 * n:
        shared = set(jaccard.prefix(a, percent).tolist()) & set(jaccard.prefix(b, percent).tolist())
        assert len(shared) >= max(jaccard.least_of_prefix(len(x), percent) for x in (a, b)) >= 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(130)]
    parent = {i: i for e in edges for i in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: root(i) for e in edges if e[0] != e[1] for i in e} | {i: root(i) for i in found}


def test_first_of_groups(spark):
    rows = corpus(random.Random(9), 150)
    rows += [(1, rows[3][1]), (1, rows[3][1]), (None, "a b c"), (None, "a b c"), (2000, "")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, component_id int")
    kept = jaccard.first_of_groups(docs)
    first = {c for i, _, c in brute_force(rows) if i is not None}
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*first, None, None], key=str)


def test_overlaps_are_counted_by_fragment(spark):
    """No row holds more than a segment, and the parts of a pair add up."""
    rows = [(i, " ".join(f"w{j}" for j in range(10 * i, 10 * i + 200))) for i in range(1, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.sets(docs, 3, 90, "doc_id", "text")
    node = {r.doc_id: r.node for r in found.collect()}
    segments = jaccard.grams_of(docs, found, found.select("node"), 3, "doc_id", "text").cache()
    assert segments.groupBy("node").count().filter(f"count <> {jaccard.FRAGMENTS}").isEmpty()
    pairs = spark.createDataFrame([(node[1], node[2]), (node[1], node[3])], "a long, b long")
    assert {(r.a, r.b): r.overlap for r in jaccard.overlaps(pairs, segments).collect()} == {(node[1], node[2]): 188, (node[1], node[3]): 178}


def test_near_copies_that_are_apart_are_not_all_compared(spark, monkeypatch):
    """2,000 copies of one text with edits of their own: a few are similar, nearly all pairs are not, and
    pairs are compared in proportion to the copies; none that is similar is missing."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rng, words, rng.choice([1, 2, 2, 3, 3, 4, 6])))) for i in range(1, 2001)]
    compared = []
    real = jaccard.similar

    def similar(pairs, *rest):
        compared.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(jaccard, "similar", similar)
    assert join(spark, rows) == brute_force_by_index(rows)
    assert sum(compared) < 20 * len(rows) < len(rows) ** 2 / 50


def brute_force_by_index(rows):
    """As `brute_force`, all pairs by products of their sets as rows of bits."""
    sets = [shingles(t) for _, t in rows]
    number = {}
    for s in sets:
        for g in s:
            number.setdefault(g, len(number))
    bits = np.zeros((len(sets), len(number)), np.float32)
    for i, s in enumerate(sets):
        bits[i, [number[g] for g in s]] = 1
    common, sizes = bits @ bits.T, bits.sum(axis=1)
    linked = 100 * common >= 90 * (sizes[:, None] + sizes - common)
    component = np.arange(len(sets))
    while (now := np.where(linked, component, len(sets)).min(axis=1)).tolist() != component.tolist():
        component = now
    return sorted(((i, len(s), rows[component[k]][0]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def test_near_copies_bring_only_what_others_outside_may_share(spark, monkeypatch):
    """Copies that differ alike, in nothing that the texts outside their component differ in."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(10, 150, 10), 2):
            words[at] = f"x{rng.randrange(2)}"
        rows.append((i, " ".join(words)))
    for i in range(3):
        words = list(base)
        for at in range(160, 250, 10):
            words[at] = f"y{i}{at}"
        rows.append((100 + i, " ".join(words)))
    counted, inner = [], jaccard.stored

    def spied(frame, label):
        found = inner(frame, label)
        if label == "common":
            counted.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "stored", spied)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, jaccard.similarity_join(docs).collect()), key=str)
    assert found == brute_force(rows)
    assert len(counted) == 1 and counted[0] <= 1300  # all that any two of the group differ in: 1788


def test_steps_leave_only_what_is_read_again(spark, monkeypatch):
    """What the comparison of the rest has made is deleted, and a place where texts differ is one number."""
    frames, inner = [], jaccard.stored

    def spied(frame, label):
        found = inner(frame, label)
        frames.append((label, found))
        return found

    monkeypatch.setattr(jaccard, "stored", spied)
    rows = corpus(random.Random(4), 150)
    assert join(spark, rows) == brute_force(rows)
    left = {label for label, frame in frames if Path(frame.stored_in.removeprefix("file:")).exists()}
    assert not left & {"sets", "keys", "shared", "members", "lead", "rows", "met", "compared", "differ", "common"}
    assert [frame.columns for label, frame in frames if label == "differ"] == [["pair", "component", "outside", "at"]]


def test_few_pairs_are_sent_to_the_segments(spark):
    segments = spark.createDataFrame([(1, 0, [1, 2]), (2, 0, [2, 3])], "node long, fragment int, grams array<long>")
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard.overlaps(pairs, segments)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [a" in plan and plan.count("SortMergeJoin") == 1
        assert [tuple(r) for r in found.collect()] == [(1, 2, 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
