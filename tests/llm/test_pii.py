"""Personal data: the plain patterns against their regular expressions, what the trees add, odd rows."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from filingmill.llm import pii
from filingmill.llm.boosting import BoostedTrees, platt

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute_force(text):
    found = []
    for kind, pattern in enumerate(PATTERNS.values()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m.group().split(".")))
                or (kind == 2 and 16 <= len(digits) <= 19 and luhn(digits))
                or (kind == 3 and 8 <= len(digits) <= 15)
            ):
                found.append((kind, *m.span()))
    return found


pieces = st.sampled_from(
    ["a", "é", "@", ".", "-", " ", "+", "(", ")", "1", "25", "256", "007", "a.b", "x@y.z", "1.2.3.4", "4111 1111-11111111",
     "4785380592391139", "+1 (743) 555-3824", "٣", "\n", "%", "_", "😀"]
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(pieces, max_size=14).map("".join))
def test_patterns(text):
    assert pii.base_spans(text) == brute_force(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1." * 200_000, "a@" * 200_000, "+1(" * 100_000, "1 " * 200_000):
        assert isinstance(pii.base_spans(text), list) and isinstance(pii.candidates(text), list)


def test_trees_learn_and_are_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    model = BoostedTrees().fit(x[:3000], y[:3000])
    a, b = platt(model.margin(x[3000:]), y[3000:])
    p = 1 / (1 + np.exp(-(a * model.margin(x[3000:]) + b)))
    assert ((p > 0.5) == y[3000:]).mean() > 0.95 and abs(p.mean() - y[3000:].mean()) < 0.03
    assert (BoostedTrees().fit(x[:0], y[:0]).margin(x) == 0).all()


def documents(spark, n=400):
    rng = np.random.default_rng(3)

    def card():
        body = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))

    rows = []
    for i in range(n):
        bad = "".join(map(str, rng.integers(0, 10, 16)))
        rows.append((i, f"pay by card {card()} or call +1 (555) 555-{1000 + i} at 10.0.{i % 200}.7 now", 1))
        rows.append((n + i, f"order {bad} of 300.1.{i}.9 and x{i}@host, item 12345{i}", 1))
    both = f"{card()} {card()}"
    rows += [(5000, f"pay by card {both} now", 1), (5001, None, 1), (5002, "", 1), (5003, "clean text, 3 of 12", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, base int"), both


def test_trees_add_numbers_that_stand_together(spark):
    docs, both = documents(spark)
    model = pii.train(docs)
    found = {r.doc_id: r for r in pii.find(docs, model).collect()}
    assert found[5000].base == [] and [tuple(s) for s in found[5000].all_spans] == [("card", 12, 28), ("card", 29, 45)]
    assert found[5001].all_spans == found[5002].all_spans == found[5003].all_spans == []
    assert all(set(r.base) <= set(r.all_spans) for r in found.values())
    texts = {r.doc_id: r.text for r in pii.redacted(docs, model).collect()}
    assert texts[5000] == "pay by card [CARD] [CARD] now" and texts[5001] == ""
    assert texts[5003] == "clean text, 3 of 12" and both not in texts[5000]


def test_odd_tables(spark):
    docs, _ = documents(spark, 2)
    assert pii.train(docs.limit(0)).thresholds == {}
    twice = docs.unionAll(docs)
    assert pii.find(twice, pii.Model()).count() == twice.count()
    assert pii.find(docs.limit(0), pii.Model()).count() == 0


def test_redaction_of_overlaps():
    text = "ab 1.2.3.4 cd"
    assert pii.redact(text, [(1, 3, 10), (3, 5, 12)]) == "ab [IP]d"
    assert pii.redact(text, []) == text


def test_candidates_are_whole():
    """Numbers written digit by digit and long addresses are proposed from end to end, in linear time."""
    number, address = "0 1 5 1 2 3 4 5 6 7 8", "a" * 80 + " (at) " + " (dot) ".join(["host"] * 12)
    assert (3, 0, len(number)) in pii.candidates(number)
    assert (0, 0, len(address)) in pii.candidates(address)
    card = "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"
    assert (2, 0, len(card)) in pii.candidates(card)
    for text in ("a" * 300_000 + "@", "a@" * 100_000, "a@b" + ".c" * 100_000, "a@b" + " (dot) " * 50_000, "1 " * 50_000):
        pii.candidates(text)
