"""Language identification of mixed-language text.

Each word gets a score per language, from counts of its character n-grams in labelled texts. The
word's script narrows the languages down to those that are written in it. Viterbi's algorithm then
labels the words of a text: staying in a language is free, switching costs a penalty, so a few
ambiguous words do not break a span while a passage in another language becomes a span of its own.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.llm.common import map_texts, rewrite, stored, text_rows

UNDETERMINED = "und"
SAMPLE_PER_LANGUAGE = 4_000  # labelled texts, in expectation
SAMPLE = 1_000_000  # of all languages
GRAMS = 60_000  # the most frequent ones make the model
SWITCH_PENALTY = 12.0  # nats
WORD_LIMIT = 6.0  # nats by which one word can favour a language over another
SCRIPT_SHARE = 0.01  # of a language's letters, from which on it counts as written in a script
CACHED_WORDS = 150_000
BATCH_CHARS = 1_000_000  # of the texts whose paths are found together
LEARNED = 200_000  # words times languages scored at a time
MAX_WORD = 32
LONG_SPAN = 40  # letters, from which on a span is prose of its language and no part of a jumble
FOUND = "language found by the model"

# First code point and name of the ranges in which scripts lie. What is not listed
# lies in a range without a name and is a script of its own.
SCRIPTS = [
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0700, "other Semitic"),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"),
    (0x0B80, "Tamil"),
    (0x0C00, "Telugu"),
    (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"),
    (0x0E00, "Thai"),
    (0x0E80, "Lao"),
    (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Ethiopic"),
    (0x13A0, "other"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "other"),
    (0x2E80, "Han"),
    (0x3040, "Kana"),
    (0x3100, "Han"),
    (0x3130, "Hangul"),
    (0x3190, "Han"),
    (0xA000, "other"),
    (0xAC00, "Hangul"),
    (0xD7B0, "other"),
    (0xF900, "Han"),
    (0xFB00, "Latin"),
    (0xFB13, "Armenian"),
    (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"),
    (0xFE00, "other"),
    (0xFF21, "Latin"),
    (0xFF66, "Kana"),
    (0xFFA0, "Hangul"),
    (0x10000, "other"),
    (0x20000, "Han"),
    (0x32000, "other"),
]
_STARTS = [start for start, _ in SCRIPTS]

WORDS = re.compile(r"[^\W\d_]{1,%d}" % MAX_WORD)


def script(word: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(word[0])) - 1][1]


def words_of(text: str) -> list[str]:
    """Runs of letters; very long runs, as in scripts without spaces, in parts. Signs such as raised
    digits, fractions and Roman numerals are no letters and end a run."""
    found = WORDS.findall(text.lower())
    if text.isascii():
        return found
    return [part for w in found for part in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def grams_of(word: str) -> list[str]:
    """One to three characters of the word with its ends marked, and a short word as a whole."""
    marked = f"^{word}$"
    found = [*word, *(marked[i : i + 2] for i in range(len(marked) - 1)), *(marked[i : i + 3] for i in range(len(marked) - 2))]
    if 2 <= len(word) <= 5:
        found.append(marked)
    return found


def _number(gram: str) -> int:
    """One number for up to three characters, each of 21 bits."""
    out = 0
    for char in gram:
        out = out << 21 | ord(char)
    return out


def held_out(key: str | Column = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string") if isinstance(key, str) else key) % 4 == 2, F.lit(False))


@dataclass
class Model:
    languages: list[str]
    grams: dict[str, int]
    scores: np.ndarray  # by gram and language; the last row is for unknown grams
    scripts: dict[str, np.ndarray]  # the languages written in it


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """A model from the labelled rows. Rows without a text or a language are left out.

    Of each language, about SAMPLE_PER_LANGUAGE rows are read, of all together about SAMPLE, chosen by a
    hash of the key: bounds that do not depend on the table's size. Their n-grams are counted on the
    executors; the driver gets the counts of GRAMS n-grams, a number for each and language.
    """
    rows = labelled.select(
        F.col(text).cast("string").alias("text"),
        F.col(lang).cast("string").alias("lang"),
        (F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 40)) / (1 << 40)).alias("draw"),
    ).filter("text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().collect()
    if not sizes:
        return Model([], {}, np.zeros((1, 0)), {})
    languages = sorted(r["lang"] for r in sizes)
    wanted = min(SAMPLE_PER_LANGUAGE, SAMPLE / len(languages))
    share = F.create_map([F.lit(x) for r in sizes for x in (r["lang"], wanted / r["count"])])
    number = F.create_map([F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
    sample = rows.filter(F.col("draw") < share[F.col("lang")]).select(number[F.col("lang")].alias("key"), "text")
    found = map_texts(text_rows(sample, "key", "text"), "kind string, gram string, lang long, n long", lambda: _count)
    found = stored(found.groupBy("kind", "gram", "lang").agg(F.sum("n").alias("n")), "grams")
    scripts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    for row in found.filter("kind = 'script'").collect():  # scripts x languages
        scripts[row.gram][row.lang] += row.n
    letters = np.maximum(sum(scripts.values(), np.zeros(len(languages))), 1)
    wide = found.filter("kind = 'gram'").groupBy("gram").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
    )
    top = wide.orderBy(F.desc("n"), "gram").limit(GRAMS).collect()
    counts = np.zeros((len(top) + 1, len(languages)))
    for i, row in enumerate(top):
        for at, n in row.by.items():
            counts[i, at] = n
    counts += 0.5
    scores = np.log(counts / counts.sum(axis=0))
    scores[-1] = scores[-1].mean()  # an unknown gram says nothing
    return Model(
        languages,
        {row.gram: i for i, row in enumerate(top)},
        scores - scores.max(axis=1, keepdims=True),
        {name: n / letters >= SCRIPT_SHARE for name, n in scripts.items()},
    )


def _count(keys: list[int], texts: list[str]) -> dict[str, list]:
    words: dict[int, Counter] = defaultdict(Counter)
    for key, text in zip(keys, texts):
        words[key].update(words_of(text))
    out: dict[tuple[str, str, int], int] = Counter()
    for key, counted in words.items():
        for word, n in counted.items():
            out["script", script(word), key] += n * len(word)
            for gram in grams_of(word):
                out["gram", gram, key] += n
    return {
        "kind": [k[0] for k in out],
        "gram": [k[1] for k in out],
        "lang": [k[2] for k in out],
        "n": list(out.values()),
    }


class Labeller:
    """Labels the words of texts by a model."""

    def __init__(self, model: Model, penalty: float = SWITCH_PENALTY):
        self.model, self.penalty = model, penalty
        self.any = np.ones(len(model.languages), bool)
        self.number: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)))
        # Grams of up to three characters as numbers, in order, and the rows of their scores.
        short = sorted((_number(g), i) for g, i in model.grams.items() if len(g) <= 3)
        self.codes = np.array([c for c, _ in short], np.uint64)
        self.rows = np.array([i for _, i in short] + [len(model.scores) - 1], np.int64)
        self.whole = {g: i for g, i in model.grams.items() if len(g) > 3}

    def _learn(self, every: set[str]) -> None:
        """Scores of the words not seen yet. Past a size it starts anew with the words at hand."""
        new = list(every.difference(self.number))
        if len(self.number) + len(new) > CACHED_WORDS:
            self.number, self.table, new = {}, self.table[:0], list(every)
        if not new:
            return
        step = max(1000, LEARNED // max(len(self.any), 1))
        scores = np.concatenate([self._scores(new[at : at + step]) for at in range(0, len(new), step)])
        scores = np.maximum(scores - scores.max(axis=1, keepdims=True), -WORD_LIMIT)
        nobody = np.zeros(len(self.any), bool)
        allowed = np.array([self.model.scripts.get(script(w), nobody) for w in new])
        # A script that no known language is written in says nothing.
        scores = np.where(allowed, scores, np.where(allowed.any(axis=1, keepdims=True), -4 * WORD_LIMIT, 0))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.table = np.concatenate([self.table, scores])

    def _scores(self, words: list[str]) -> np.ndarray:
        """By word and language, the scores of all grams of each word added up."""
        marked = "".join([f"^{w}$" for w in words])
        chars = np.frombuffer(marked.encode("utf-32-le"), "<u4").astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + 2) - sizes - 2
        place = np.arange(len(chars)) - np.repeat(starts, sizes + 2)
        left = np.repeat(sizes + 2, sizes + 2) - place  # characters from here to the word's end
        two = chars[:-1] << np.uint64(21) | chars[1:]
        three = two[:-1] << np.uint64(21) | chars[2:]
        out = np.zeros((len(words), len(self.any)))
        for codes, here, number in (
            (chars, (place > 0) & (left > 1), sizes),
            (two, left[:-1] > 1, sizes + 1),
            (three, left[:-2] > 2, sizes),
        ):
            wanted = codes[here]
            at = np.searchsorted(self.codes, wanted)
            if len(self.codes):
                at[self.codes[np.minimum(at, len(self.codes) - 1)] != wanted] = len(self.codes)
            out += np.add.reduceat(self.model.scores[self.rows[at]], np.cumsum(number) - number, axis=0)
        short = np.flatnonzero((sizes >= 2) & (sizes <= 5)).tolist()
        unknown = len(self.model.scores) - 1
        out[short] += self.model.scores[[self.whole.get(f"^{words[i]}$", unknown) for i in short]]
        return out

    def labels(self, texts: list[list[str]]) -> list[np.ndarray]:
        """For each list of words, the number of the language of each word.

        All texts advance together, word by word, the longest first; of equal paths the one that
        stays, then the first language, is taken."""
        sizes = np.array([len(t) for t in texts])
        order = np.argsort(-sizes, kind="stable")
        lengths = sizes[order]
        n_steps = int(lengths[0]) if len(lengths) else 0
        if not n_steps:
            return [np.zeros(0, np.int16) for _ in texts]
        self._learn(set().union(*texts))
        ids = [np.fromiter(map(self.number.__getitem__, texts[i]), np.int64, len(texts[i])) for i in order]
        active = np.searchsorted(-lengths, -np.arange(n_steps), side="left")  # texts with more words than the step
        offsets = np.concatenate([[0], np.cumsum(active)])
        step = np.concatenate([np.arange(n) for n in lengths])
        place = offsets[step] + np.repeat(np.arange(len(lengths)), lengths)
        words = np.empty(offsets[-1], np.int64)
        words[place] = np.concatenate(ids)
        best = np.empty(offsets[-1], np.int16)
        stay = np.empty((offsets[-1], len(self.any)), bool)
        value = np.zeros((len(texts), len(self.any)))
        for t in range(n_steps):
            n, here = active[t], slice(offsets[t], offsets[t + 1])
            old = value[:n]
            best[here] = top = old.argmax(axis=1)
            switched = (old[np.arange(n), top] - self.penalty)[:, None]
            stay[here] = keep = old >= switched
            value[:n] = np.where(keep, old, switched) + self.table[words[here]]
        out = np.empty(offsets[-1], np.int16)
        state = value.argmax(axis=1)
        for t in range(n_steps - 1, -1, -1):
            n, here = active[t], slice(offsets[t], offsets[t + 1])
            out[here] = now = state[:n]
            state[:n] = np.where(stay[here][np.arange(n), now], now, best[here])
        labelled = np.split(out[place], np.cumsum(lengths)[:-1])
        back = np.argsort(order)
        return [labelled[i] for i in back]

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str, int]]]:
        """Of each text the spans of one language: start and end in the text, language, letters."""
        same: dict[str, str] = {}  # equal words are one string in memory
        words = [[same.setdefault(w, w) for w in words_of(t)] for t in texts]
        if not self.model.languages:
            return [[] for _ in texts]
        out = []
        for text, some, labels in zip(texts, words, self.labels(words)):
            letters = np.fromiter(map(len, some), np.int64, len(some))
            firsts = np.flatnonzero(np.diff(labels, prepend=-1)).tolist()
            places = _places(text, some, firsts)
            sums = np.add.reduceat(letters, firsts).tolist() if firsts else []
            out.append([(*p, self.model.languages[labels[i]], n) for p, i, n in zip(places, firsts, sums)])
        return out


def _places(text: str, words: list[str], firsts: list[int]) -> list[tuple[int, int]]:
    """Where the spans lie that begin with these words: each reaches up to the end of its last word."""
    if not firsts:
        return []
    lower = text.lower()
    if len(lower) != len(text):  # a letter whose lower case is longer
        lower = "".join([c.lower() if len(c.lower()) == 1 else c for c in text])
    wanted = {*firsts, *(i - 1 for i in firsts[1:]), len(words) - 1}
    found, at = {}, 0
    if len(wanted) <= 2:
        start = lower.find(words[0])
        return [(start, lower.rfind(words[-1]) + len(words[-1]))]
    for i, word in enumerate(words):
        start = lower.find(word, at)
        at = at if start < 0 else start + len(word)
        if i in wanted:
            found[i] = (at - len(word), at)
    return [(found[i][0], found[j - 1][1]) for i, j in zip(firsts, [*firsts[1:], len(words)])]


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, spans (start, end, lang, letters) of every whole text.

    lang_pred is the language with most letters, of equal ones the first by name; score its share of
    all letters. A text that is null or has no letter is `und` with score 0 and no spans, and so is
    every text if nothing was learned. Equal rows give equal rows, an empty table none; other columns
    are ignored."""
    schema = (
        "doc_id long, lang_pred string, score double, "
        "spans array<struct<start: long, end: long, lang: string, letters: long>>"
    )

    def start():
        labeller = Labeller(model)

        def work(keys, texts):
            spans = labeller.spans(texts)
            best = [_best(s) for s in spans]
            return {
                "doc_id": keys,
                "lang_pred": [b[0] for b in best],
                "score": [b[1] for b in best],
                "spans": [[dict(zip(("start", "end", "lang", "letters"), s)) for s in some] for some in spans],
            }

        return work

    return map_texts(text_rows(docs, key, text), schema, start, BATCH_CHARS)


def keep_identified(docs: DataFrame, model: Model, least: float, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of a table whose text has at least this share of its letters in its main language and in
    long spans of any. Rows without a value in `lang` get the main language. If nothing was learned,
    every text with letters stays, and its language as it is."""

    def start():
        labeller = Labeller(model)

        def work(texts):
            if not model.languages:
                return [bool(words_of(t)) for t in texts], {FOUND: [None] * len(texts)}
            spans = labeller.spans(texts)
            best = [_best(s)[0] for s in spans]
            return [b != UNDETERMINED and _whole(s, b) >= least for s, b in zip(spans, best)], {FOUND: best}

        return work

    found = rewrite(docs.withColumn(FOUND, F.lit(None).cast("string")), start, text, chars=BATCH_CHARS)
    return found.withColumn(lang, F.coalesce(lang, FOUND)).drop(FOUND)


def _whole(spans: list[tuple[int, int, str, int]], main: str) -> float:
    """The share of letters in the main language or in long spans."""
    return sum(n for _, _, lang, n in spans if lang == main or n >= LONG_SPAN) / sum(n for _, _, _, n in spans)


def _best(spans: list[tuple[int, int, str, int]]) -> tuple[str, float]:
    letters: dict[str, int] = Counter()
    for _, _, lang, n in spans:
        letters[lang] += n
    if not letters:
        return UNDETERMINED, 0.0
    lang = min(letters, key=lambda x: (-letters[x], x))
    return lang, letters[lang] / sum(letters.values())
