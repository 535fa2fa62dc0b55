"""Byte pair encoding with forced boundaries, and decoding.

A merge can only make tokens of the vocabulary. Two neighbouring symbols that stand next to each
other in no token are therefore never joined, nor anything left of them with anything right of them:
the word falls apart there, whatever the merges are. `WordBpe` collects the neighbours that do occur,
cuts words at all others, encodes the fragments independently and concatenates their tokens. All
fragments of a batch are merged together, one column of a matrix per symbol.

Letters and lower case are those of this Python's Unicode version; code points it does not know are
left as they are.
"""

from __future__ import annotations

import copy
import gc
import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from filingmill.llm.common import map_texts, parts, sha256_hex, text_rows

WORD_END = "</w>"
CACHED_CHUNKS = 100_000
BATCH_CHARS = 1_000_000
NEVER = np.iinfo(np.int32).max  # the rank of a pair that is never joined
LONG = 64  # symbols; longer fragments are merged one at a time, by a heap


def byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable Latin-1 bytes stand
    for themselves, the others for the characters from 256 on, in order."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """The tokenizer of a vocabulary file whose words end in `</w>`: lower case, white space dropped."""

    # Fixed: the words of this kind of vocabulary, as its file states them, for ASCII. What is a letter, a
    # number or lower case elsewhere depends on the version of Unicode, so the library says so.
    ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
    # White space to str.split, and to nothing else.
    SEPARATORS = re.compile("[\x1c-\x1f]")
    CHUNKS = regex.compile(r"\P{White_Space}+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        library = Tokenizer.from_file(path)
        self.normalized, self.cut_words = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        vocab: dict[str, int] = content["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        chars = byte_chars()
        self.first_ids = np.array([vocab[c] for c in chars] + [vocab[c + WORD_END] for c in chars], np.int32)
        self._learn_neighbours(vocab, {c: b for b, c in enumerate(chars)})
        self._learn_merges(vocab, content["model"]["merges"])
        self.names = {i: str(i) for i in self.tokens}
        self.ids_of: dict[str, str] = {}
        self.tokens_of: dict[str, str] = {}

    def _learn_neighbours(self, vocab: dict[str, int], byte_of: dict[str, int]) -> None:
        """inside[a, b]: symbol b stands right of symbol a in some token. Symbols: the 256 bytes,
        then the 256 bytes at a word's end."""
        self.inside = np.zeros((512, 512), bool)
        for token in vocab:
            body = token.removesuffix(WORD_END) or token
            symbols = [byte_of[c] for c in body]
            if body != token:
                symbols[-1] += 256
            self.inside[symbols[:-1], symbols[1:]] = True

    def _learn_merges(self, vocab: dict[str, int], merges: list[list[str]]) -> None:
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)  # by rank
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], order.astype(np.int32)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.key_ranks[at], NEVER)

    def fragments(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First ids of all symbols of the words, where fragments start, and where words start."""
        encoded = [w.encode() for w in words]
        symbols = np.frombuffer(b"".join(encoded), np.uint8).astype(np.int64)
        ends = np.cumsum([len(e) for e in encoded])
        symbols[ends - 1] += 256
        cut = np.ones(len(symbols), bool)
        cut[1:] = ~self.inside[symbols[:-1], symbols[1:]]
        starts = np.concatenate([[0], ends[:-1]])
        cut[starts] = True
        return self.first_ids[symbols], np.flatnonzero(cut), starts

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; no word may be empty."""
        if not words:
            return []
        ids, cuts, starts = self.fragments(words)
        lengths = np.diff(np.append(cuts, len(ids)))
        out = np.where(np.repeat(lengths, lengths) == 1, ids, -1)
        low = 1
        for high in (4, 8, 12, 20, LONG):
            group = np.flatnonzero((lengths > low) & (lengths <= high))
            for some in np.array_split(group, len(group) // 50_000 + 1):
                self._merge_many(ids, out, cuts[some], lengths[some])
            low = high
        for at, n in zip(cuts[lengths > LONG].tolist(), lengths[lengths > LONG].tolist()):
            merged = self._merge_long(ids[at : at + n].tolist())
            out[at : at + len(merged)] = merged
        kept = np.flatnonzero(out >= 0)
        tokens = out[kept].tolist()
        bounds = [*np.searchsorted(kept, starts).tolist(), len(tokens)]
        return [tokens[i:j] for i, j in zip(bounds, bounds[1:])]

    def _merge_many(self, ids: np.ndarray, out: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> None:
        """Joins the lowest ranked pair of every fragment, the leftmost first, until none has a rank."""
        if not len(at):
            return
        width = int(lengths.max())
        column = np.arange(width)
        place = at[:, None] + column
        table = np.where(column < lengths[:, None], ids[np.minimum(place, len(ids) - 1)], -1)
        ranks = self._ranks(table[:, :-1], table[:, 1:])
        ranks = np.concatenate([ranks, np.full((len(at), 1), NEVER, np.int32)], axis=1)
        while True:
            where = ranks.argmin(axis=1)
            rows = np.arange(len(where))
            best = ranks[rows, where]
            over = best == NEVER
            if over.any():
                done, n = table[over], at[over]
                kept = done >= 0
                out[(n[:, None] + np.arange(done.shape[1]))[kept]] = done[kept]
                go = ~over
                table, ranks, at, where, best = table[go], ranks[go], at[go], where[go], best[go]
                if not len(at):
                    return
                rows = np.arange(len(at))
            width = table.shape[1]
            source = column[:width] + (column[:width] > where[:, None])  # what is right of the pair moves left
            source = np.minimum(source, width - 1)
            table[rows, where] = self.merged[best]
            ranks = np.take_along_axis(ranks, source, 1)
            table = np.take_along_axis(table, source, 1)
            table[:, -1] = -1
            ranks[:, -1] = NEVER
            left, right = np.maximum(where - 1, 0), np.minimum(where + 1, width - 1)
            here = table[rows, where]
            ranks[rows, where] = np.where(right > where, self._ranks(here, table[rows, right]), NEVER)
            before = np.flatnonzero(where > 0)
            ranks[before, left[before]] = self._ranks(table[before, left[before]], here[before])

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same for one long fragment in n log n steps."""
        n = len(symbols)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            rank = self.rank_of.get(symbols[i] * self.width + symbols[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = int(self.merged[rank]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return [s for s in symbols if s >= 0]

    # Texts. A chunk is what stands between white space; no word reaches over white space, so a
    # chunk's tokens do not depend on its neighbours.

    def _chunks(self, text: str) -> list[str]:
        if text.isascii():
            text = text.lower()
        else:
            # Lower case character by character: the last sigma of a word is no special case.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if self.SEPARATORS.search(text):
            return self.CHUNKS.findall(text)
        return text.split()

    def chunks(self, text: str) -> list[str]:
        """The text's chunks; special tokens are chunks of their own, written as in the file."""
        if not any(s in text for s in self.special):
            return self._chunks(text)
        out: list[str] = []
        for i, piece in enumerate(self.cut_special.split(text)):
            out += [piece] if i % 2 else self._chunks(piece)
        return out

    def _words(self, chunk: str) -> list[str]:
        if chunk.isascii():
            return self.ASCII_WORDS.findall(chunk)
        chunk = self.normalized(chunk)
        return [chunk[i:j] for _, (i, j) in self.cut_words(chunk)]

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        cut = self.ASCII_WORDS.findall
        words = [[] if c in self.special else cut(c) if c.isascii() else self._words(c) for c in chunks]
        every = list({w for ws in words for w in ws})
        known = dict(zip(every, self.encode_words(every)))
        return [
            known[ws[0]] if len(ws) == 1 else [self.special[c]] if c in self.special else [i for w in ws for i in known[w]]
            for c, ws in zip(chunks, words)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        chunked = [self.chunks(t) for t in texts]
        every = list({c for chunks in chunked for c in chunks})
        known = dict(zip(every, self.encode_chunks(every)))
        return [[i for c in chunks for i in known[c]] for chunks in chunked]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space, as files without a decoder have it; unknown ids are left out."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])

    def both(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text the number of tokens, the ids joined by a space, and what these ids decode to.

        The collector of cycles waits meanwhile: there are none in so many short lists."""
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._both(texts)
        finally:
            if collects:
                gc.enable()

    def _both(self, texts: list[str]) -> list[tuple[int, str, str]]:
        every: dict[str, str] = {}  # equal chunks are one string in memory
        chunked = [[every.setdefault(c, c) for c in self.chunks(t)] for t in texts]
        new = [c for c in every if c not in self.ids_of]
        if len(self.ids_of) + len(new) > CACHED_CHUNKS:
            # Only speed depends on what is kept: what these texts have again, as most that is common.
            again = [c for c in every if c in self.ids_of]
            self.ids_of = {c: self.ids_of[c] for c in again}
            self.tokens_of = {c: self.tokens_of[c] for c in again}
        for chunk, ids in zip(new, self.encode_chunks(new)):
            self.ids_of[chunk] = " ".join([self.names[i] for i in ids])
            self.tokens_of[chunk] = " ".join([self.tokens[i] for i in ids])
        out = []
        for chunks in chunked:
            ids = " ".join(map(self.ids_of.__getitem__, chunks))
            out.append((ids.count(" ") + 1 if ids else 0, ids, " ".join(map(self.tokens_of.__getitem__, chunks))))
        return out


    def for_task(self) -> WordBpe:
        """The same tables with a cache of its own, which goes with the task: the worker lives on beside others."""
        out = copy.copy(self)
        out.ids_of, out.tokens_of = {}, {}
        return out


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """Once per Python process: workers are used for many tasks."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int). Null and empty texts have no ids. Equal rows give equal rows; an
    empty table gives none; other columns of the input are ignored, whatever their names. A whole text
    is encoded however long it is."""

    def start():
        bpe = load(path)
        return lambda keys, texts: {"doc_id": keys, "ids": bpe.encode(texts)}

    return map_texts(text_rows(docs, key, text), "doc_id long, ids array<int>", start)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text: what the ids decode to. Null or empty ids give the empty text."""
    joined = F.array_join(F.col(ids).cast("array<string>"), " ")
    rows = encoded.select(F.col(key).cast("long").alias("key"), F.coalesce(joined, F.lit("")).alias("text"))

    def start():
        bpe = load(path)
        return lambda keys, texts: {"doc_id": keys, "text": [bpe.decode([int(i) for i in t.split()]) for t in texts]}

    return map_texts(rows, "doc_id long, text string", start)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded in one pass.

    Null and empty texts have no token and the digests of the empty text. Equal rows give equal rows, an
    empty table gives none; other columns are not read. A text is encoded whole, however long."""

    def start():
        bpe = load(path).for_task()

        def work(keys, texts):
            found = []
            for _, some in parts(keys, texts, BATCH_CHARS):
                found += [(n, sha256_hex(ids), sha256_hex(decoded)) for n, ids, decoded in bpe.both(some)]
            return {
                "doc_id": keys,
                "n_tokens": [f[0] for f in found],
                "ids_sha256": [f[1] for f in found],
                "decoded_sha256": [f[2] for f in found],
            }

        return work

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(text_rows(docs, key, text), schema, start)
