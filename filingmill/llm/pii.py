"""Personal data by candidate gradient boosting.

Generators with high recall propose overlapping spans; boosted trees score them by their format and
their context; per kind, the lowest calibrated probability at which held-out precision is met is the
threshold. What the plain patterns accept is always kept; the trees add what these miss, such as
numbers that stand directly next to each other or addresses written out in words.

There are no labels for personal data, so the trees learn from the patterns: what these accept are
the positive examples, candidates that violate their kind's format the negative ones, and the rest is
not learned from but scored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm.boosting import BoostedTrees, platt
from filingmill.llm.common import map_texts, rewrite, text_rows

KINDS = ("email", "ip", "card", "phone")
SAMPLE_TEXTS = 20_000  # in expectation
SAMPLE_CANDIDATES = 40_000
PRECISION = 0.99
LEAST_EXAMPLES = 20  # held-out ones of either class; with fewer, a kind has the threshold of all kinds

Span = tuple[int, int, int]  # number of the kind, start, end

# The patterns of the four kinds. A match of IP or CARD that starts inside a run of
# digits would fail where the run's start failed, so only starts of runs are tried.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators of the trees' candidates.
WRITTEN_OUT = re.compile(
    r"(?<![\w.%+-])[\w.%+-]++\s?(?:@|\(at\)|\[at\])\s?[\w-]++(?:\s?(?:\.|\(dot\)|\[dot\])\s?[\w-]++)*+"
)
NUMBERS = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9]+(?:[ ().-]{1,2}[0-9]+)*")
DIGITS = re.compile(r"[0-9]+")
QUAD = re.compile(r"(?=(?<![0-9])([0-9]{1,5}(?:\.[0-9]{1,5}){3})(?![0-9]))")

WORDS = (
    ("mail", "contact", "write", "@"),
    ("ip", "host", "server", "addr", "from"),
    ("card", "visa", "credit", "pay", "account"),
    ("tel", "phone", "call", "mobile", "fax"),
)
CONTEXT = 30


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def base_spans(text: str) -> list[Span]:
    """What the plain patterns accept, per kind leftmost and not overlapping, by kind and start."""
    found: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((0, start, end))
        else:
            end = at + 1
        at = text.find("@", end)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := only_digits(m.group())) <= 19 and luhn(d):
            found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(only_digits(m.group())) <= 15:
                found.append((3, *m.span()))
    return found


def candidates(text: str) -> list[Span]:
    """Spans that may be personal data, overlapping ones included. No digit, no sign: no candidate."""
    found: set[Span] = set()
    if "@" in text or "at)" in text or "at]" in text:
        found.update((0, *m.span()) for m in WRITTEN_OUT.finditer(text))
    for m in NUMBERS.finditer(text):
        if m.end() - m.start() < 7:
            continue
        start = m.start()
        groups = [(start + a, start + b) for a, b in (g.span() for g in DIGITS.finditer(m.group()))]
        if "." in m.group():
            found.update((1, start + q.start(1), start + q.end(1)) for q in QUAD.finditer(m.group()))
        for i in range(len(groups)):
            digits = 0
            for j in range(i, len(groups)):
                digits += groups[j][1] - groups[j][0]
                if digits > 19:
                    break
                if digits >= 13:
                    found.add((2, groups[i][0], groups[j][1]))
                if 7 <= digits <= 15 and (j > i or text[groups[i][0] - 1 : groups[i][0]] == "+"):
                    begin = groups[i][0]
                    while begin > start and text[begin - 1] in "+(":
                        begin -= 1
                    found.add((3, begin, groups[j][1]))
    return sorted(found)


def features(text: str, span: Span, lower: str) -> list[float]:
    """Format: length, digits, separators, check sums. Context: neighbours and words before."""
    kind, start, end = span
    value = text[start:end]
    digits = only_digits(value)
    marks = [c for c in value if not c.isalnum()]
    before, after = text[start - 1 : start], text[end : end + 1]
    ahead = lower[max(0, start - CONTEXT) : start]
    behind = text[end : end + CONTEXT]
    parts = value.split(".")
    return [
        kind,
        len(value),
        len(digits),
        len(set(digits)),
        len(marks),
        len(set(marks)),
        luhn(digits) if kind == 2 else 0,
        max((int(p[-9:]) for p in parts if p.isdecimal()), default=0) if kind == 1 else 0,
        len(parts),
        value.startswith("+"),
        value.count("@"),
        len(value) - len(value.rstrip("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")),
        int(digits[0]) if digits else -1,
        _sort(before),
        _sort(after),
        any(w in ahead for w in WORDS[kind]),
        any(w in ahead for k, words in enumerate(WORDS) if k != kind for w in words),
        sum(c.isdecimal() for c in ahead),
        sum(c.isdecimal() for c in behind),
    ]


N_FEATURES = 19


def _sort(char: str) -> int:
    return 0 if not char or char.isspace() else 1 if char.isalpha() else 2 if char.isdecimal() else 3


def violates(text: str, span: Span) -> bool:
    """The candidate cannot be what its kind says."""
    kind, start, end = span
    value = text[start:end]
    if kind == 0:
        return "." not in value.partition("@")[2] and "dot" not in value
    if kind == 1:
        return any(int(p) > 255 for p in value.split("."))
    digits = only_digits(value)
    return not (16 <= len(digits) <= 19 and luhn(digits)) if kind == 2 else not 8 <= len(digits) <= 15


@dataclass
class Model:
    trees: BoostedTrees | None = None
    slope: float = 1.0
    offset: float = 0.0
    thresholds: dict[int, float] = field(default_factory=dict)  # kinds without one add nothing

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.margin(x) + self.offset, -30, 30)))


def _examples(keys: list[int], texts: list[str]) -> dict[str, list]:
    out: dict[str, list] = {"key": [], "at": [], "y": [], "x": []}
    for key, text in zip(keys, texts):
        accepted = base_spans(text)
        taken = set(accepted)
        lower = text.lower()
        for span in sorted({*candidates(text), *taken}):
            other = any(k != span[0] and s < span[2] and span[1] < e for k, s, e in accepted)
            if span in taken or other or violates(text, span):
                out["key"].append(key)
                out["at"].append(span[1])
                out["y"].append(int(span in taken))
                out["x"].append(features(text, span, lower))
    return out


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Trees from about SAMPLE_TEXTS texts and at most SAMPLE_CANDIDATES candidates, both chosen by
    hashes. One third, by the key, is held out for calibration and thresholds."""
    rows = text_rows(docs, key, text)
    n = rows.count()
    draw = F.pmod(F.xxhash64("key", F.lit("pii")), F.lit(1 << 40)) / (1 << 40)
    sample = rows.filter(F.coalesce(draw, F.lit(0.0)) < SAMPLE_TEXTS / max(n, 1))
    found = map_texts(sample, "key long, at long, y long, x array<double>", lambda: _examples)
    found = found.orderBy(F.xxhash64("key", "at", "x")).limit(SAMPLE_CANDIDATES).collect()
    if not found:
        return Model()
    x = np.array([r.x for r in found])
    y = np.array([r.y for r in found])
    fold = np.array([(r.key or 0) % 3 for r in found]) == 0
    model = Model(BoostedTrees().fit(x[~fold], y[~fold]))
    if fold.any():
        model.slope, model.offset = platt(model.trees.margin(x[fold]), y[fold])
        p = model.probabilities(x[fold])
        shared = threshold(p, y[fold])
        for kind in range(len(KINDS)):
            of = x[fold, 0] == kind
            limit = threshold(p[of], y[fold][of]) or shared
            if limit is not None:
                model.thresholds[kind] = limit
    return model


def threshold(p: np.ndarray, y: np.ndarray) -> float | None:
    """The lowest probability from which on precision is met, if there are enough examples to say so."""
    if min(y.sum(), len(y) - y.sum()) < LEAST_EXAMPLES:
        return None
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    last = np.append(np.diff(p[order]) != 0, True)  # equal probabilities are accepted together
    good = np.flatnonzero(last & (right >= PRECISION * np.arange(1, len(p) + 1)))
    return float(max(p[order][good[-1]], 0.5)) if len(good) else None


def added_spans(model: Model, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Candidates above their kind's threshold that overlap nothing accepted, the likeliest first; of
    equal ones the longer, then the left one."""
    open_spans: list[tuple[int, Span]] = []
    x: list[list[float]] = []
    for i, (text, accepted) in enumerate(zip(texts, base)):
        found = [s for s in candidates(text) if s[0] in model.thresholds] if model.thresholds else []
        if not found:
            continue
        lower = text.lower()
        starts = sorted((s, e) for _, s, e in accepted)
        for span in found:
            if not _overlaps(starts, span) and not violates(text, span):
                open_spans.append((i, span))
                x.append(features(text, span, lower))
    out: list[list[Span]] = [[] for _ in texts]
    if not x:
        return out
    p = model.probabilities(np.array(x, dtype=float))
    limits = np.array([model.thresholds[s[0]] for _, s in open_spans])
    order = sorted(np.flatnonzero(p >= limits).tolist(), key=lambda k: (-p[k], open_spans[k][1][1] - open_spans[k][1][2], open_spans[k]))
    taken: dict[int, list[tuple[int, int]]] = {}
    for k in order:
        i, span = open_spans[k]
        kept = taken.setdefault(i, [])
        if not _overlaps(kept, span):
            insort(kept, (span[1], span[2]))
            out[i].append(span)
    return out


def _overlaps(kept: list[tuple[int, int]], span: Span) -> bool:
    """Whether the span overlaps one of these, which are sorted."""
    at = bisect_left(kept, (span[1], 0))
    return (at < len(kept) and kept[at][0] < span[2]) or any(e > span[1] for _, e in kept[max(0, at - 4) : at])



def find(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base and all_spans (kind, start, end in code points) of every whole text, by kind as
    listed in KINDS, then start. Base spans are among all spans.

    Null counts as the empty text; a text without personal data has no spans. Equal rows give equal
    rows, an empty table none; other columns are ignored."""
    span = "array<struct<kind: string, start: long, end: long>>"

    def start():
        def work(keys, texts):
            base = [base_spans(t) for t in texts]
            more = added_spans(model, texts, base)
            return {
                "doc_id": keys,
                "base": [_rows(b) for b in base],
                "all_spans": [_rows(sorted(b + m)) for b, m in zip(base, more)],
            }

        return work

    return map_texts(text_rows(docs, key, text), f"doc_id long, base {span}, all_spans {span}", start)


def _rows(spans: list[Span]) -> list[dict]:
    return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones together, replaced by its first kind in brackets."""
    out, at, last = [], 0, -1
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= last:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            last = at = end
        else:
            last = at = max(last, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: Model, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows of a table with the spans of their texts replaced, and their lengths, if it has them,
    brought up to date. A null text becomes the empty text."""

    def start():
        def work(texts):
            base = [base_spans(t) for t in texts]
            more = added_spans(model, texts, base)
            found = [redact(t, b + m) for t, b, m in zip(texts, base, more)]
            return None, {text: found, length: [len(t) for t in found]}

        return work

    return rewrite(docs, start, text)
