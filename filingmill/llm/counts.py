"""Token counts by prefix dynamic programming.

For a byte-level BPE, the encoding of a word's prefix of i bytes ends in exactly one token. If that
token starts at j, what stands before it is the encoding of the prefix of j bytes, so

    count[i] = count[j] + 1,   last[i] = the token from j to i,

where the token follows last[j] in the encoding of the two together. One pass over a word thus
stores the exact count of every prefix. `prefix_counts` puts the words of a text together; a budget
or truncation question is a search in what it returns.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import regex
from pyspark.sql import DataFrame

from filingmill.llm.bpe import byte_chars
from filingmill.llm.common import Memo, map_texts, parts, text_rows

CACHED = 100_000
CACHED_PAIRS = 600_000
SHIFT = 1 << 20  # more than there are tokens
CACHED_CHUNKS = 600_000
BATCH_CHARS = 4_000_000
NEVER = 1 << 60
LIMIT = 1024


class PrefixCounts:
    """Counts tokens as a byte-level BPE vocabulary file with the usual word pattern has them."""

    # Fixed: the words of this kind of vocabulary.
    WORDS = regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
        r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
    )
    # Where no white space stands next to other white space or at the end, each space belongs to
    # the word right of it.
    SPACE = regex.compile(r"\p{White_Space}+")
    UNUSUAL_SPACE = re.compile(r"\s\s|\s\Z")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.chars = dict(enumerate(byte_chars()))
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(content["model"]["merges"])}
        self.special = [t["content"] for t in content["added_tokens"]]
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self._learn_spines(content["model"]["merges"])
        self.names = list(self.tokens)
        longest = max(map(len, self.tokens))
        self.sizes = (3, 2, 4, 5, 1, *range(6, longest + 1))  # common ones first
        self.follows = Memo(self._follows, CACHED_PAIRS)
        self.counts = Memo(self._counts, CACHED)
        self.chunk_counts: dict[str, int] = {}  # of chunks after a space

    def _learn_spines(self, merges: list[list[str]]) -> None:
        """Of each token, the pieces that ever stand at its left and right end while it is merged, each
        with the rank of the merge that takes it up."""
        self.left = {c: ((c, NEVER),) for c in self.chars.values()}
        self.right = dict(self.left)
        self.tokens = {c: i for i, c in enumerate(self.chars.values())}
        for rank, (a, b) in enumerate(merges):
            if a in self.tokens and b in self.tokens and self._crossing(a, b) in (None, (a, b)):
                self.tokens.setdefault(a + b, len(self.tokens))  # else its own bytes are encoded to something else
                self.left[a + b] = ((a + b, NEVER), (a, rank), *self.left[a][1:])
                self.right[a + b] = ((a + b, NEVER), (b, rank), *self.right[b][1:])

    def _crossing(self, a: str, b: str) -> tuple[str, str] | None:
        """The first merge over the border of two tokens that comes before both pieces are taken up;
        of equal ranks the left one comes first."""
        found = [
            (rank, (x, y))
            for x, x_until in self.right[a]
            for y, y_until in self.left[b]
            if (rank := self.ranks.get((x, y))) is not None and rank < x_until and rank <= y_until
        ]
        return min(found)[1] if found else None

    def _follows(self, pair: int) -> bool:
        left, right = divmod(pair, SHIFT)
        return self._crossing(self.names[left], self.names[right]) is None

    def _symbols(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.chars)

    def _extend(self, symbols: str, last: list[int], counts: list[int]) -> None:
        """Goes on with the prefixes of the symbols that are longer than those stored."""
        get, follows, sizes = self.tokens.get, self.follows, self.sizes
        for i in range(len(counts), len(symbols) + 1):
            for size in sizes:  # one token fits only, so any order finds it
                j = i - size
                if j < 0:
                    continue
                token = get(symbols[j:i])
                if token is not None and (not j or follows[last[j] * SHIFT + token]):
                    last.append(token)
                    counts.append(counts[j] + 1)
                    break

    def _counts(self, word: str) -> list[int]:
        """The count of every prefix of the word in bytes, from the empty one to the whole."""
        last, counts = [0], [0]
        self._extend(self._symbols(word), last, counts)
        return counts

    def word_counts(self, words: set[str]) -> dict[str, int]:
        """The count of each word. In order, neighbours share the prefixes they have in common."""
        last, counts, before, out = [0], [0], "", {}
        for symbols, word in sorted([(self._symbols(w), w) for w in words]):
            shared = 0
            for a, b in zip(symbols, before):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], counts[shared + 1 :]
            self._extend(symbols, last, counts)
            out[word], before = counts[-1], symbols
        return out

    def _parts(self, text: str) -> tuple[list[str], list[str]]:
        """Words, and chunks before each of which stands a space, that together are the text."""
        if self.UNUSUAL_SPACE.search(text):
            return self.WORDS.findall(text), []
        first, *rest = text.split(" ")
        return self.WORDS.findall(first), rest

    def count(self, texts: list[str]) -> list[int]:
        """The tokens of each text. Words that were not met lately are counted together."""
        cut: list[tuple[int, list[str], list[str]]] = []
        for text in texts:
            pieces = self.cut_special.split(text) if any(s in text for s in self.special) else [text]
            found = [self._parts(p) for p in pieces[::2]]
            cut.append((len(pieces) // 2, [w for f in found for w in f[0]], [c for f in found for c in f[1]]))
        words = {w for _, some, _ in cut for w in some}
        chunks: set[str] = set()
        for _, _, some in cut:
            chunks.update(some)
        new = chunks.difference(self.chunk_counts)
        if len(self.chunk_counts) + len(new) > CACHED_CHUNKS:  # only speed depends on what is kept
            self.chunk_counts, new = {}, chunks
        split = {c: self.WORDS.findall(" " + c) for c in new}
        known = self.word_counts(words.union(*split.values()))
        for chunk, some in split.items():
            self.chunk_counts[chunk] = sum(map(known.__getitem__, some))
        get = self.chunk_counts.__getitem__
        return [n + sum(map(known.__getitem__, some)) + sum(map(get, rest)) for n, some, rest in cut]

    def _total(self, text: str) -> int:
        return sum([self.counts[w][-1] for w in self.WORDS.findall(text)])

    def prefix_counts(self, text: str) -> list[int]:
        """The exact token count of text[:i] for every i from 0 to the text's length."""
        out = [0]
        for i, piece in enumerate(self.cut_special.split(text)):
            if i % 2:
                # Unfinished, a special token's characters are ordinary text after what stands before.
                start = len(out) - 1
                out += [self._count_from(text, start + k, out) for k in range(1, len(piece))]
                out.append(out[start] + 1)
            else:
                self._plain_prefixes(piece, out)
        return out

    def _count_from(self, text: str, end: int, known: list[int]) -> int:
        """The count of text[:end], cutting at the last special token before it."""
        found = self.cut_special.split(text[:end])
        tail = found[-1]
        return known[end - len(tail)] + self._total(tail)

    def _plain_prefixes(self, text: str, out: list[int]) -> None:
        whole = out[-1]  # tokens of the words so far, as the text goes on
        space_end = 0
        for match in self.WORDS.finditer(text):
            word, start = match.group(), match.start()
            if start >= space_end and (space := self.SPACE.match(text, start)):
                space_end = space.end()
                space_counts, space_base, space_byte = self.counts[space.group()], whole, 0
            counts = self.counts[word]
            unfinished = len(word) - 1 if word[0] == "'" and len(word) > 1 and word[1].isalpha() else 0
            byte = 0
            for k, char in enumerate(word, 1):
                byte += len(char.encode())
                if start + k <= space_end:
                    space_byte += len(char.encode())
                    out.append(space_base + space_counts[space_byte])  # at the end, it is one word
                elif k <= unfinished:
                    out.append(whole + self._total(word[:k]))  # 'l of 'll is two words
                else:
                    out.append(whole + counts[byte])
            whole += counts[-1]


@lru_cache(maxsize=2)
def load(path: str) -> PrefixCounts:
    """Once per Python process: workers are used for many tasks."""
    return PrefixCounts(path)


def fits(counts: list[int], budget: int) -> int:
    """The most characters whose tokens are at most `budget`, and so are those of all shorter prefixes."""
    return bisect_right([*accumulate(counts, max)], budget) - 1


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text.

    Null counts as the empty text: no bytes, no tokens, not over the limit. Strings of special tokens
    inside a text count as these tokens. Equal rows give equal rows, an empty table none; other
    columns are ignored."""

    def start():
        model = load(path)

        def work(keys, texts):
            tokens = [n for _, some in parts(keys, texts, BATCH_CHARS) for n in model.count(some)]
            return {
                "doc_id": keys,
                "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": tokens,
                "over_limit": [n > limit for n in tokens],
            }

        return work

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_texts(text_rows(docs, key, text), schema, start)


def budget_cuts(docs: DataFrame, path: str, budget: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, text: the longest start of every text that, with all shorter ones, encodes to
    at most `budget` tokens. Null is the empty text."""

    def start():
        model = load(path)

        def work(keys, texts):
            sizes = [fits(model.prefix_counts(t), budget) for t in texts]
            return {"doc_id": keys, "n_chars": sizes, "text": [t[:n] for t, n in zip(texts, sizes)]}

        return work

    return map_texts(text_rows(docs, key, text), "doc_id long, n_chars long, text string", start)
