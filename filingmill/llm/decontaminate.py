"""Benchmark decontamination through an FM-index per shard of the training texts.

Texts are taken word by word; each word of the benchmark is a symbol. No phrase holds any other word,
so a text falls into runs of symbols, and runs shorter than every phrase need no place in the index.
A shard's runs, each closed by the separator 0, make one sequence. The symbols left of its sorted
suffixes are its transform, kept in a wavelet tree. Phrases are found by backward search, all of them
at once: each symbol, from the last to the first, narrows the range of suffixes by two ranks in the
tree. Occurrences are located by walking left to the next sampled suffix position, and their words
merged into spans.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm.common import map_texts, rewrite, stored, text_rows

WINDOW = 10
SAMPLED = 8  # every such position of the text is kept
SHARD_WORDS = 4_000_000
BLOCK_CHARS = 4_000_000  # of benchmark items that are searched for at once

# Fixed: a word is what stands between these characters, in lower case as to A-Z. No other byte of
# UTF-8 is ASCII, so bytes can be taken for characters.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_SPACED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in _SEPARATORS else c for c in range(256)
)

_WORD = re.compile(rb"[^ ]+")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_SPACED).split()


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector per bit of the symbols, from the highest, each
    with the number of ones before every place; a level is sorted by the bits above it."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place, counted from where it starts at the last level."""
        at = places
        start = np.zeros_like(places)
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbols >> (self.bits - 1 - i)) & 1
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
            start = np.where(bit == 1, zeros + ones[start], start - ones[start])
        return at - start

    def symbol(self, places: np.ndarray) -> np.ndarray:
        at, out = places, np.zeros_like(places)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[at + 1] - ones[at]
            out = 2 * out + bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return out


class FmIndex:
    """An index of a sequence of symbols whose runs each end in the separator 0, the last one too."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        order = suffix_order(symbols)
        self.size = len(symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        self.tree = WaveletTree(symbols[order - 1], n_symbols)
        # Starts of runs are always kept, so no walk to the left crosses a separator.
        kept = (order % SAMPLED == 0) | (symbols[order - 1] == 0)
        self.kept = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase; rows are filled up on the right."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for i in range(phrases.shape[1] - 1, -1, -1):
            rows = np.flatnonzero((lengths > i) & (low < high))
            symbols = phrases[rows, i]
            start = self.before[symbols]
            low[rows] = start + self.tree.rank(symbols, low[rows])
            high[rows] = start + self.tree.rank(symbols, high[rows])
        return low, high

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Where in the sequence the suffixes of these ranks begin."""
        out = np.empty(len(places), np.int64)
        open_rows, steps = np.arange(len(places)), 0
        while len(open_rows):
            met = self.kept[places + 1] > self.kept[places]
            out[open_rows[met]] = self.positions[self.kept[places[met]]] + steps
            open_rows, places = open_rows[~met], places[~met]
            symbols = self.tree.symbol(places)
            places = self.before[symbols] + self.tree.rank(symbols, places)
            steps += 1
        return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions by the suffixes that begin there. Separators are smaller than words and, by their
    places, different from each other, so doubling the compared length ends at the longest run."""
    gap = symbols == 0
    n_gaps = int(gap.sum())
    rank = np.where(gap, np.cumsum(gap) - 1, symbols + n_gaps).astype(np.int64)
    length = 1
    while True:
        _, rank = np.unique(rank, return_inverse=True)
        top = int(rank.max()) + 1
        if top == len(rank):
            return np.argsort(rank)
        follows = np.zeros(len(rank), np.int64)
        follows[:-length] = rank[length:]
        rank = rank * top + follows
        length *= 2


@dataclass
class Phrases:
    """Distinct windows of a block of benchmark items, and the items that hold each."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    holders: np.ndarray  # (window, number of the item) pairs, sorted
    items: list[str | None]

    @classmethod
    def of(cls, items: list[tuple[str | None, str]], window: int = WINDOW) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        numbers: dict[tuple[int, ...], int] = {}
        holders: set[tuple[int, int]] = set()
        for i, (_, text) in enumerate(items):
            words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            for start in range(max(1, len(words) - window + 1) if words else 0):
                phrase = tuple(words[start : start + window])
                holders.add((numbers.setdefault(phrase, len(numbers)), i))
        windows = np.zeros((len(numbers), window), np.int64)
        lengths = np.zeros(len(numbers), np.int64)
        for phrase, k in numbers.items():
            windows[k, : len(phrase)], lengths[k] = phrase, len(phrase)
        return cls(vocabulary, windows, lengths, np.array(sorted(holders), np.int64).reshape(-1, 2), [i for i, _ in items])

    def hits(self, texts: list[str]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """Of each text its number of words, the spans of words inside any occurrence of a window
        (first word, one past the last) and the items, as text, sorted, that have one there."""
        out: list[tuple[int, list[tuple[int, int]], list[str]]] = []
        shard: list[np.ndarray] = []
        size = 0
        for text in texts:
            words = words_of(text)
            shard.append(np.array([*map(self.vocabulary.get, words, repeat(0))], np.int64))
            size += len(words)
            if size >= SHARD_WORDS:
                out += self._shard(shard)
                shard, size = [], 0
        return out + self._shard(shard)

    def _shard(self, texts: list[np.ndarray]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        sizes = np.array([len(t) for t in texts], np.int64)
        out = [(int(n), [], []) for n in sizes]
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])  # each text closed by a 0
        words = np.zeros(starts[-1], np.int64)
        for start, text in zip(starts.tolist(), texts):
            words[start : start + len(text)] = text
        if not len(words) or not len(self.lengths):
            return out
        edges = np.flatnonzero(np.diff(np.concatenate([[0], words != 0, [0]])))
        first, last = edges[::2], edges[1::2]
        long = last - first >= self.lengths.min()
        first, n = first[long], (last - first)[long]
        if not len(first):
            return out
        begin = np.concatenate([[0], np.cumsum(n + 1)])
        symbols = np.zeros(begin[-1], np.int64)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        symbols[np.repeat(begin[:-1], n) + inside] = words[np.repeat(first, n) + inside]
        index = FmIndex(symbols, len(self.vocabulary) + 1)
        low, high = index.search(self.windows, self.lengths)
        found = np.flatnonzero(high > low)
        times = (high - low)[found]
        if not len(found):
            return out
        phrase = np.repeat(found, times)
        ranks = np.repeat(low[found], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at = index.locate(ranks)
        run = np.searchsorted(begin, at, side="right") - 1
        at = first[run] + at - begin[run]
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + self.lengths[phrase], -1)
        hit = np.cumsum(change) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit])))
        of = np.searchsorted(starts, edges[::2], side="right") - 1
        for i, a, b in zip(of.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
            out[i][1].append((a - int(starts[i]), b - int(starts[i])))
        pairs = np.unique(np.stack([np.searchsorted(starts, at, side="right") - 1, phrase], axis=1), axis=0)
        a, b = (np.searchsorted(self.holders[:, 0], pairs[:, 1], side=s) for s in ("left", "right"))
        items: dict[int, set[str]] = defaultdict(set)
        for i, j, k in zip(pairs[:, 0].tolist(), a.tolist(), b.tolist()):
            items[i].update(x for h in self.holders[j:k, 1] if (x := self.items[h]) is not None)
        for i, some in items.items():
            out[i][2].extend(sorted(some))
        return out


def blocks(
    benchmark: DataFrame, window: int = WINDOW, key: str = "item_id", text: str = "text"
) -> list[Callable[[], Phrases]]:
    """The benchmark's phrases in blocks of about BLOCK_CHARS characters, each collected when it is
    called for, so that the driver and a task hold one of them however long the benchmark is."""
    items = benchmark.select(F.col(key).cast("string").alias("item"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = int(chars // BLOCK_CHARS) + 1
    in_block = F.pmod(F.xxhash64("item", "text"), F.lit(n))

    def block(i: int) -> Phrases:
        return Phrases.of([(r.item, r.text) for r in items.filter(in_block == i).collect()], window)

    return [partial(block, i) for i in range(n)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SPANS = "array<struct<start: long, end: long>>"
HITS = "hits of all blocks"
ROW = "number of the row"


def by_block(rows: DataFrame, found: list[Callable[[], Phrases]], text: str) -> DataFrame:
    """The rows, that have a ROW each, with HITS: spans and items of all blocks. One pass for each block
    stores what it hits; only rows with a hit have any."""
    stores = []
    for make in found:
        phrases = make()

        def start(phrases=phrases):
            def work(keys, texts):
                hits = [(k, *h[1:]) for k, h in zip(keys, phrases.hits(texts)) if h[1]]
                return {
                    "row": [k for k, _, _ in hits],
                    "spans": [[{"start": a, "end": b} for a, b in spans] for _, spans, _ in hits],
                    "items": [items for _, _, items in hits],
                }

            return work

        stores.append(stored(map_texts(text_rows(rows, ROW, text), f"row long, spans {SPANS}, items array<string>", start), "hits"))
        del phrases, start
    hits = reduce(DataFrame.unionByName, stores).groupBy(F.col("row").alias(ROW)).agg(
        F.struct(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")).alias(HITS)
    )
    return rows.join(hits, ROW, "left")


def numbered(rows: DataFrame) -> DataFrame:
    return stored(rows.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def _spans(hits) -> list[tuple[int, int]]:
    return merged([(s["start"], s["end"]) for s in hits["spans"]]) if hits else []


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, spans (first word, one past the last), items (ids as text, sorted as text).

    An item shorter than the window is one phrase; one without words is none. Null texts have no
    words. Items that occur more than once count once; rows of documents stay rows. Other columns are
    ignored; an empty benchmark finds nothing."""
    found = blocks(benchmark, window)
    rows = text_rows(docs, key, text)
    schema = f"doc_id long, n_words long, spans {SPANS}, items array<string>"

    def result(keys, hits):
        return {
            "doc_id": keys,
            "n_words": [h[0] for h in hits],
            "spans": [[{"start": a, "end": b} for a, b in h[1]] for h in hits],
            "items": [h[2] for h in hits],
        }

    if len(found) > 1:
        joined = by_block(numbered(rows), found, "text").select(F.struct("key", F.col(HITS).alias("hits")).alias("key"), "text")

        def merge(keys, texts):
            hits = [k["hits"] for k in keys]
            return result(
                [k["key"] for k in keys],
                [(len(words_of(t)), _spans(h), sorted(h["items"]) if h else []) for t, h in zip(texts, hits)],
            )

        return map_texts(joined, schema, lambda: merge)
    phrases = found[0]()
    return map_texts(rows, schema, lambda: lambda keys, texts: result(keys, phrases.hits(texts)))


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without these spans of words. What stands between words of a span goes with them."""
    if not spans:
        return text
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.translate(_SPACED))]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows of a table without the benchmark's passages in their texts, and their lengths, if it
    has them, brought up to date. A null text becomes the empty text."""
    found = blocks(benchmark, window)

    def result(texts, spans):
        kept = [cut(t, s) for t, s in zip(texts, spans)]
        return None, {text: kept, length: [len(t) for t in kept]}

    if len(found) > 1:
        rows = by_block(numbered(docs), found, text)
        out = rewrite(rows, lambda: lambda texts, hits: result(texts, map(_spans, hits)), text, HITS)
        return out.select(*docs.columns)
    phrases = found[0]()
    return rewrite(docs, lambda: lambda texts: result(texts, [h[1] for h in phrases.hits(texts)]), text)
