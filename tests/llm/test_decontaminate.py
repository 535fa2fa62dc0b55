"""Decontamination against searches word by word; the index against sorting and counting."""

import gc
import re
import weakref

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from filingmill.llm import decontaminate as d


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_force(text, items, window):
    words, hit, found = words_of(text), set(), set()
    for item, content in items:
        other = words_of(content)
        for i in range(max(1, len(other) - window + 1) if other else 0):
            phrase = other[i : i + window]
            for at in range(len(words) - len(phrase) + 1):
                if words[at : at + len(phrase)] == phrase:
                    hit.update(range(at, at + len(phrase)))
                    found.add(item)
    return len(words), hit, sorted(found)


sentence = st.lists(st.sampled_from(["a", "b", "c", "A", "é", "x-y", "9", "a.b", "\n"]), max_size=12).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(sentence, max_size=6), st.lists(sentence, max_size=4), st.integers(1, 4))
def test_equals_word_by_word(texts, items, window):
    items = [(str(i), t) for i, t in enumerate(items)]
    phrases = d.Phrases.of(items, window)
    for text, (n, spans, found) in zip(texts, phrases.hits(texts), strict=True):
        assert (n, {i for a, b in spans for i in range(a, b)}, found) == brute_force(text, items, window)
        assert spans == d.merged(spans)


def test_index():
    rng = np.random.default_rng(0)
    for n_symbols in (2, 3, 9, 40):
        symbols = np.append(rng.integers(0, n_symbols, 700), 0)
        order = d.suffix_order(symbols)
        gaps = np.cumsum(symbols == 0) - 1
        keys = [[(0, gaps[j]) if symbols[j] == 0 else (symbols[j], 0) for j in range(i, min(i + 60, 701))] for i in range(701)]
        if n_symbols > 2:
            assert order.tolist() == sorted(range(701), key=keys.__getitem__)
        index = d.FmIndex(symbols, n_symbols)
        inner = np.flatnonzero(symbols[order] != 0)
        assert (index.locate(inner) == order[inner]).all()


def test_rows_and_blocks(spark, monkeypatch):
    passage = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Start. {passage.upper()}, end"), (2, None), (3, ""), (3, ""), (4, "one two three"), (5, "short item here"),
            (None, passage), (6, "w " * 200_000 + passage + " " + passage)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, items int")
    bench = spark.createDataFrame([(7, passage, 1), (7, passage, 1), (10, "Short item", 1), (11, None, 1), (12, "", 1)], "item_id long, text string, spans int")
    for chars in (d.BLOCK_CHARS, 20):
        monkeypatch.setattr(d, "BLOCK_CHARS", chars)
        found = {r.doc_id: r for r in d.contamination(docs, bench).collect()}
        assert [tuple(s) for s in found[1].spans] == [(1, 12)] and found[1].items == ["7"]
        assert found[2].n_words == 0 and found[4].spans == [] and found[5].items == ["10"]
        assert [tuple(s) for s in found[6].spans] == [(200_000, 200_022)] and found[None].items == ["7"]
        texts = {r.doc_id: r.text for r in d.decontaminated(docs, bench).collect()}
        assert texts[1] == "Start. , end" and texts[5] == " here" and texts[2] == "" and texts[4] == "one two three"
    assert d.contamination(docs, bench.limit(0)).filter("size(items) > 0").count() == 0
    assert d.contamination(docs.limit(0), bench).count() == 0


def test_one_block_at_a_time(spark, monkeypatch):
    """The driver never holds the phrases of two blocks, and results are those of one block."""
    items = [(i, " ".join(f"w{(i * j) % 97}" for j in range(1, 30))) for i in range(1, 9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i % 3, f"x {t} y {t[:40]}", 1) for i, t in items] * 2 + [(None, None, 1)], "doc_id long, text string, other int")
    whole = [sorted(map(str, f(docs, bench).collect())) for f in (d.contamination, d.decontaminated)]
    made_so_far, most = [], []
    of = d.Phrases.of.__func__

    def watched(cls, *args):
        made = of(cls, *args)
        made_so_far.append(weakref.ref(made))
        gc.collect()
        most.append(sum(r() is not None for r in made_so_far))
        return made

    monkeypatch.setattr(d.Phrases, "of", classmethod(watched))
    monkeypatch.setattr(d, "BLOCK_CHARS", 300)
    parted = [sorted(map(str, f(docs, bench).collect())) for f in (d.contamination, d.decontaminated)]
    assert parted == whole and len(most) > 4 and max(most) == 1
