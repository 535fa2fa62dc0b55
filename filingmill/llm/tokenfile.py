"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits. Level 0 holds the lowest chunk of every id, and level k the next
chunk of those ids that go on after level k - 1. A bitmap per level says which go on, and a directory
holds the number of set bits before every block of 512. The chunk of an id at the next level stands at
the number of set bits before its place, so any id is read with one look at the directory and at most
eight words for each of its levels; nothing before it is decoded.

A file is a Parquet file of segments, rows that hold about SEGMENT ids, of whole documents in ascending
order of key: the codes as bytes, uncompressed, and a directory of the documents with their starts.

    codes:  "DAC1", u32 levels, then for each level:
            u64 chunks, u64 set bits, chunks (u8, padded to eight bytes),
            bitmap (u64 words), directory (u64 for each eight words) - these two only if a bit is set
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingmill.llm.bpe import byte_chars
from filingmill.llm.common import give_back, parts, ship

MAGIC = b"DAC1"
SEGMENT = 500_000  # ids after which a segment ends with the document
CHUNK = 8
WORDS = 8  # of 64 bits in a block of the directory
CACHED = 800_000  # pieces of text whose ids are kept per Python process
TOGETHER = 5_000  # pieces encoded at a time
BATCH_CHARS = 12_000_000
LIST = 50_000  # positions looked up in a segment at a time
SEGMENT_SCHEMA = "part int, number int, before long, n_tokens long, keys array<long>, starts array<long>, codes binary"


def encode(ids: np.ndarray) -> bytes:
    """The codes of ids that are not negative."""
    rest = np.asarray(ids).astype(np.uint64)
    levels = []
    while True:
        more = rest >> np.uint64(CHUNK)
        goes_on = more > 0
        levels.append(_level((rest & np.uint64((1 << CHUNK) - 1)).astype(np.uint8), goes_on))
        rest = more[goes_on]
        if not len(rest):
            return MAGIC + np.uint32(len(levels)).tobytes() + b"".join(levels)


def _level(chunks: np.ndarray, goes_on: np.ndarray) -> bytes:
    ones = int(goes_on.sum())
    out = np.array([len(chunks), ones], "<u8").tobytes() + chunks.tobytes() + bytes(-len(chunks) % 8)
    if not ones:
        return out
    packed = np.packbits(goes_on, bitorder="little")
    words = np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view("<u8")
    blocks = np.add.reduceat(np.bitwise_count(words).astype("<u8"), np.arange(0, len(words), WORDS))
    return out + words.tobytes() + (np.cumsum(blocks) - blocks).astype("<u8").tobytes()


class Codes:
    """Reads ids out of codes. Nothing is decoded but what is asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.levels, at = [], 8
        for _ in range(int(np.frombuffer(data, "<u4", 1, 4)[0])):
            n, ones = map(int, np.frombuffer(data, "<u8", 2, at))
            chunks = np.frombuffer(data, np.uint8, n, at + 16)
            at += 16 + n + -n % 8
            words = -(-n // 64) if ones else 0
            bitmap = np.frombuffer(data, "<u8", words, at)
            directory = np.frombuffer(data, "<u8", -(-words // WORDS), at + 8 * words)
            at += 8 * (words + len(directory))
            self.levels.append((chunks, bitmap, directory))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, at: int) -> int:
        """The set bits before a place."""
        word = at // 64
        block = word // WORDS
        if block == len(directory):  # behind the last bit of a bitmap of whole blocks
            block -= 1
        below = int(np.bitwise_count(bitmap[block * WORDS : word]).sum(dtype=np.int64))
        inside = int(bitmap[word]) & ((1 << at % 64) - 1) if at % 64 else 0
        return int(directory[block]) + below + inside.bit_count()

    def get(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < len(self):
            raise IndexError(at)
        at, value = int(at), 0
        for k, (chunks, bitmap, directory) in enumerate(self.levels):
            value |= int(chunks[at]) << CHUNK * k
            if not len(bitmap) or not int(bitmap[at // 64]) >> at % 64 & 1:
                return value
            at = self._rank(bitmap, directory, at)
        raise ValueError("the codes end within an id")

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from start to stop: each level is read from its own place on, found by rank."""
        start, stop = int(start), int(stop)
        out = np.zeros(max(stop - start, 0), np.int64)
        where = np.arange(len(out))
        for k, (chunks, bitmap, directory) in enumerate(self.levels):
            out[where] |= chunks[start:stop].astype(np.int64) << CHUNK * k
            if not len(bitmap) or start >= stop:
                break
            first, last = start // 64, -(-stop // 64)
            bits = np.unpackbits(bitmap[first:last].view(np.uint8), bitorder="little")
            where = where[bits[start - 64 * first : stop - 64 * first].astype(bool)]
            start = self._rank(bitmap, directory, start)
            stop = start + len(where)
        return out


class Encoder:
    """Ids as the library gives them, each piece of a text once while it is remembered.

    A word of the byte-level pattern never goes on from a character that is no white space to one that
    is, and looks no further than to the character after white space. So a text may be cut before white
    space that follows another character, and pieces with one space in front may be encoded in one go
    with line ends between them, which are words of their own there."""

    UNUSUAL = re.compile(r"\s\s")
    PIECES = re.compile(r"\s*\S+|\s+")
    SPACE = re.compile(r"\s")
    SPACE_BYTE, LINE_END = byte_chars()[0x20], byte_chars()[0x0A]
    TAIL = ".,;:!?"  # begins a new word after a letter

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        (self.line_end,) = self.library.encode("\n", add_special_tokens=False).ids
        self.letters = Tokenizer(self.library.model)  # for words of ASCII letters, which are their own bytes
        self.letters.pre_tokenizer = pre_tokenizers.Split(self.LINE_END, "isolated")
        self.known: dict[str, bytes] = {}
        self.after_space: dict[str, bytes] = {}  # of pieces with a space in front, by what follows it

    def _alone(self, pieces: list[str]) -> Iterator[bytes]:
        for at in range(0, len(pieces), TOGETHER):
            for found in self.library.encode_batch_fast(pieces[at : at + TOGETHER], add_special_tokens=False):
                yield np.array(found.ids, "<u4").tobytes()

    def _plain(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces."""
        new = list(set(pieces).difference(self.known))
        if len(self.known) + len(new) > CACHED:  # only speed depends on what is kept
            self.known = {p: self.known[p] for p in set(pieces) if p in self.known}
        self.known.update(zip(new, self._alone(new)))
        return list(map(self.known.__getitem__, pieces))

    def _after_space(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces, each with a space before it if it does not begin with a line end."""
        known = self.after_space
        new = [p for p in pieces if p not in known]
        if len(known) + len(new) > CACHED:
            known = self.after_space = {p: known[p] for p in pieces if p in known}
        letters, together, tailed, alone = [], [], [], []
        for piece in new:
            if piece.isascii() and (word := piece.rstrip(self.TAIL)).isalpha():
                if word == piece:
                    letters.append(piece)
                else:
                    tailed.append((piece, word))
            elif piece and not self.SPACE.search(piece):
                together.append(piece)
            else:
                alone.append(piece)
        letters += {w for _, w in tailed}.difference(known, letters)
        for some, library, between in ((letters, self.letters, self.LINE_END + self.SPACE_BYTE), (together, self.library, "\n ")):
            for at in range(0, len(some), TOGETHER):
                block = some[at : at + TOGETHER]
                (found,) = library.encode_batch_fast([between[1] + between.join(block)], add_special_tokens=False)
                ids = np.array(found.ids, "<u4")
                data, ends = ids.tobytes(), (4 * np.append(np.flatnonzero(ids == self.line_end), len(ids))).tolist()
                start = 0
                for piece, end in zip(block, ends, strict=True):
                    known[piece] = data[start:end]
                    start = end + 4
        known.update(zip(alone, self._alone([p if p[:1] == "\n" else " " + p for p in alone])))
        tails = self._plain([p[len(w) :] for p, w in tailed])
        for (piece, word), tail in zip(tailed, tails):
            known[piece] = known[word] + tail
        return list(map(known.__getitem__, pieces))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        unusual = [self.UNUSUAL.search(t) is not None for t in texts]
        usual = iter(self._usual([t for t, odd in zip(texts, unusual) if not odd]))
        return [self._unusual(t) if odd else next(usual) for t, odd in zip(texts, unusual)]

    def _unusual(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self._plain(self.PIECES.findall(text))), "<u4")

    def _usual(self, texts: list[str]) -> list[np.ndarray]:
        """Of texts that may be cut before every space and line end: their pieces are numbered by Arrow, and
        each text's ids are gathered from those of the different pieces."""
        if not texts:
            return []
        lists = pc.split_pattern(pa.array([t.replace("\n", " \n") for t in texts], pa.string()), " ")
        bounds = lists.offsets.to_numpy()
        numbered = lists.flatten().dictionary_encode()
        words, numbers = numbered.dictionary.to_pylist(), numbered.indices.to_numpy().copy()
        first = [words[i] for i in numbers[bounds[:-1]]]  # has no space in front
        numbers[bounds[:-1]] = np.arange(len(words), len(words) + len(first))
        found = self._after_space(words) + self._plain(first)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        sizes, starts = sizes[numbers], starts[numbers]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]))]
        cuts = np.append(0, ends)[bounds]
        return [ids[i:j] for i, j in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    """Once per Python process: workers are used for many tasks."""
    return Encoder(path)


def write(docs: DataFrame, folder: str, path: str, end: int, key: str = "doc_id", text: str = "text", segment: int = SEGMENT) -> None:
    """Every whole text as the library's ids and the id `end`, in ascending order of key.

    Null is the empty text, of which only `end` is written. A null key comes first. Rows that share a key
    are all written, in order of a hash of their texts. An empty table writes no segment. Other columns
    are not read. A text is never cut, so a segment holds at least one document however long.

    The texts are dealt by ranges of the key, and of a hash and a number within it, so that no key gathers
    its rows in one task. How many ids stand before each part is written beside the segments."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"order": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(F.asc("key"), "order", "row").sortWithinPartitions(F.asc("key"), "order", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number, before = load(path), TaskContext.get().partitionId(), 0, 0
        keys, found, size = [], [], 0
        for some, texts in gathered(batches):
            for k, ids in zip(some, encoder.ids(texts)):
                keys.append(k)
                found.append(np.append(ids, np.uint32(end)))
                size += len(ids) + 1
                if size >= segment:
                    yield _segment(part, number, before, keys, found)
                    number, before, keys, found, size = number + 1, before + size, [], [], 0
        if keys:
            yield _segment(part, number, before, keys, found)
        give_back()

    segments = ordered.select("key", "text").mapInArrow(run, SEGMENT_SCHEMA)
    segments.write.option("compression", "uncompressed").option("parquet.enable.dictionary", "false").parquet(f"{folder}/segments")
    # A row for each task that wrote: their number does not grow with the ids in a task.
    sizes = _segments(docs.sparkSession, folder).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset")).write.parquet(f"{folder}/offsets")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts of about BATCH_CHARS characters, from batches of any size."""
    keys, texts, chars = [], [], 0
    for batch in batches:
        for some, found in parts(batch.column(0).to_pylist(), batch.column(1).to_pylist(), BATCH_CHARS):
            keys += some
            texts += found
            chars += sum(map(len, found))
            if chars >= BATCH_CHARS:
                yield keys, texts
                keys, texts, chars = [], [], 0
    if keys:
        yield keys, texts


def _segment(part: int, number: int, before: int, keys: list, found: list[np.ndarray]) -> pa.RecordBatch:
    starts = np.concatenate([[0], np.cumsum([len(x) for x in found])])
    values = [part, number, before, int(starts[-1]), keys, starts, encode(np.concatenate(found))]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = ["part", "number", "before", "n_tokens", "keys", "starts", "codes"]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).parquet(f"{folder}/segments")


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segments of a folder; `before` counts the ids of all earlier ones."""
    offsets = spark.read.schema("part int, offset long").parquet(f"{folder}/offsets")
    return _segments(spark, folder).join(offsets, "part").withColumn("before", F.col("before") + F.col("offset")).drop("offset")


def map_documents(spark: SparkSession, folder: str, schema: str, work: Callable[[np.ndarray], tuple]) -> DataFrame:
    """key, start, n_tokens of every document in the files, and what `work` makes of its ids."""
    ship(spark)
    out = spark.createDataFrame([], f"key long, start long, n_tokens long, {schema}").schema
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts = row["starts"]
                ids = Codes(row["codes"]).slice(0, starts[-1])
                found = [
                    (key, row["before"] + a, b - a, *work(ids[a:b]))
                    for key, a, b in zip(row["keys"], starts, starts[1:])
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), target)], schema=target)

    return segments(spark, folder).select("before", "keys", "starts", "codes").mapInArrow(run, out)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """key, start, n_tokens, ids of every document in the files."""
    return map_documents(spark, folder, "ids array<long>", lambda ids: (ids,))


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """key, start, n_tokens, ids_crc32 of every document in the files: the checksum is of its ids as
    unsigned little-endian integers of 32 bits."""
    return map_documents(spark, folder, "ids_crc32 long", lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),))


def lookup(spark: SparkSession, folder: str, wanted: DataFrame, key: str = "key", place: str = "place") -> DataFrame:
    """key, place, token: the ids that stand at places of documents, counted from 0, each read at its
    address. A document that shares its key gives a row of its own. Keys and places that the files lack
    give none; repeated ones are repeated. Other columns are ignored.

    The places wanted of a segment travel to it in lists of about LIST, so a document that everybody asks
    for is read by many tasks, and no segment is copied for each place."""
    ship(spark)
    files = segments(spark, folder)
    known = files.select("part", "number", F.posexplode("keys").alias("at", "key"), "starts").select(
        "part", "number", "key", F.element_at("starts", F.col("at") + 1).alias("from"), F.element_at("starts", F.col("at") + 2).alias("to")
    )
    asked = wanted.select(F.col(key).cast("long").alias("key"), F.col(place).cast("long").alias("place")).filter("place >= 0")
    found = known.join(asked, "key").filter("place < to - `from`").withColumn("list", F.pmod(F.xxhash64("key", "place", F.rand(0)), F.lit(1 << 20)))
    share = found.groupBy("part", "number").agg(F.count("*").alias("n"))
    lists = (
        found.join(share, ["part", "number"])
        .groupBy("part", "number", F.expr(f"list % (1 + n div {LIST})").alias("list"))
        .agg(F.collect_list(F.struct("key", "place", F.expr("`from` + place").alias("at"))).alias("asked"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["codes"])
                found = [(x["key"], x["place"], codes.get(x["at"])) for x in row["asked"]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["key", "place", "token"])

    return files.select("part", "number", "codes").join(lists, ["part", "number"]).select("codes", "asked").mapInArrow(run, "key long, place long, token long")
