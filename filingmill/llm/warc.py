"""WARC archives without repeated payloads.

Headers are shuffled by payload digest to find the first record of every payload; the others become
revisit records that refer to it and carry no payload. Archives are written by Spark's text sink: a
row is a record, and the separator of rows is the empty line that ends a WARC record. They are read
back by the text source and put together again by their lengths, so paths are whatever Spark can
reach, and a lost executor costs its tasks.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingmill.llm.common import _arrow_schema, ship

RESPONSE, REVISIT = "response", "revisit"
LINE = "\r\n"
RECORD_END = LINE + LINE
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = LINE.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "", ""])


def payload_digest(payload: Column) -> Column:
    """Base32 of the SHA-1 of the payload's UTF-8: five hexadecimal digits make four characters."""
    digits = F.sha1(payload.cast("binary"))
    chars = []
    for group in range(8):
        bits = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            chars.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*chars)


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """key, url, payload, digest, size of every page. A null payload is the empty one."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    return rows.select("*", payload_digest(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("size"))


def resolve(found: DataFrame, least: int = 0) -> DataFrame:
    """The records with `type` and `original`, the key of the response that a revisit refers to.

    Of records with equal payloads of at least `least` bytes, the one with the smallest key is the
    response; rows that share that key, and those without a key if none has one, are all responses.
    Records that came without a payload are revisits; their original is null if no payload with their
    digest is at hand."""
    with_payload = found.filter("payload is not null")
    # Sums up before the shuffle: a payload that makes up a third of all rows is a row per task here.
    originals = with_payload.filter(F.col("size") >= least).groupBy("digest", "size").agg(F.min("key").alias("original"))
    joined = found.join(originals, ["digest", "size"], "left")
    is_response = F.col("payload").isNotNull() & (
        F.col("original").isNull() | (F.col("key") == F.col("original")) | (F.col("size") < least)
    )
    kind = F.when(F.coalesce(is_response, F.lit(False)), RESPONSE).otherwise(REVISIT)
    return joined.withColumn("type", kind).withColumn("original", F.when(kind == REVISIT, F.col("original")))


def _record_id(key: Column, digest: Column) -> Column:
    """The same for the same page and payload, so that a revisit can name a record it has not met."""
    name = F.sha1(F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("")), digest).cast("binary"))
    pieces = [F.substring(name, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _record(written_at: str) -> Column:
    def line(name: str, value: Column) -> Column:
        """Left out if null."""
        return F.concat(F.lit(f"{name}: "), value, F.lit(LINE))

    revisit = F.col("type") == REVISIT
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")  # a header is one line
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, "").otherwise(F.col("payload")))
    head = F.concat_ws(
        "",
        F.lit("WARC/1.1" + LINE),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", F.concat(_record_id(F.col("key"), F.col("digest")))),
        line("WARC-Date", F.lit(written_at)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", F.when(revisit, PROFILE)),
        line("WARC-Refers-To", F.when(revisit & F.col("original").isNotNull(), _record_id(F.col("original"), F.col("digest")))),
        line("X-Record-Key", F.col("key").cast("string")),
        line("X-Payload-Length", F.col("size").cast("string")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(LINE), block)


def write(found: DataFrame, path: str, least: int = 0, written_at: str | None = None) -> None:
    """Resolved records as gzip archives in a new folder, with headers of their own."""
    date = written_at or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = resolve(found, least).select(_record(date).alias("value"))
    rows.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


class Reader:
    """Puts records together from pieces of archives that were cut at empty lines."""

    GAP = RECORD_END.encode()

    def __init__(self) -> None:
        self.head: dict[str, str] | None = None
        self.pieces: list[bytes] = []
        self.have = self.need = 0

    def take(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        """The records that end with this piece; an empty line follows each piece."""
        while True:
            if self.head is None:
                piece = piece.lstrip(b"\r\n")
                if not piece:
                    return
                head, gap, rest = piece.partition(self.GAP)
                lines = head.decode().split(LINE)
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"no WARC record begins with {lines[0][:80]!r}")
                self.head = dict(line.split(": ", 1) for line in lines[1:])
                self.need, self.pieces, self.have = int(self.head["Content-Length"]), [], 0
                if not gap:
                    if self.need:
                        return
                    rest = b""
                piece = rest
            self.pieces.append(piece)
            self.have += len(piece)
            if self.have < self.need:
                self.pieces.append(self.GAP)
                self.have += len(self.GAP)
            if self.have < self.need:
                return
            block = b"".join(self.pieces)
            head, self.head = self.head, None
            yield head, block[: self.need]
            piece = block[self.need :]


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """key, record_id, type, url, date, refers_to, digest and size as the headers state them, and of
    the payload found in the record (null for revisits) its text if wanted, its size and its digest.

    Archives are gzip files, which Spark does not split: a file's records are met in order."""
    ship(spark)
    schema = (
        "key long, record_id string, type string, url string, date string, refers_to string, digest string, size long, "
        "payload string, found_size long, found_digest string"
    )
    target = spark.createDataFrame([], schema).schema
    arrow = _arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for piece in batch.column(0):
                for head, block in reader.take(piece.as_buffer().to_pybytes()):
                    rows.append(_row(head, block, payload))
                    size += len(block)
                if size > 16_000_000:
                    yield _batch(rows, arrow)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, arrow)

    text = spark.read.option("lineSep", RECORD_END).schema("value string").text(path)
    return text.select(F.col("value").cast("binary")).mapInArrow(run, target)


def _row(head: dict[str, str], block: bytes, payload: bool) -> tuple:
    key = head.get("X-Record-Key")
    stated = (
        None if key is None else int(key), head["WARC-Record-ID"], head["WARC-Type"], head.get("WARC-Target-URI"), head["WARC-Date"],
        head.get("WARC-Refers-To"), head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"]),
    )
    if head["WARC-Type"] != RESPONSE:
        return (*stated, None, None, None)
    body = block.partition(Reader.GAP)[2]
    digest = base64.b32encode(hashlib.sha1(body, usedforsecurity=False).digest()).decode()
    return (*stated, body.decode() if payload else None, len(body), digest)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def followed(archive: DataFrame) -> DataFrame:
    """key, url, payload_bytes, payload_digest, type, refers_to (the original's key) and payload of every
    record: revisits have what their original response holds; one whose original is missing has the
    length and digest that its header states, and no payload. An empty archive gives no rows.

    Responses stand for themselves and join nothing. Revisits look for their original; one that a third of
    them refer to is split by adaptive execution. The records are read twice: store them if that is dear."""
    held = F.struct("found_size", "found_digest", "payload")
    responses = archive.filter(F.col("type") == RESPONSE)
    originals = responses.groupBy("record_id").agg(F.first(F.struct(F.col("key").alias("original"), held.alias("held"))).alias("found"))
    originals = originals.select(F.col("record_id").alias("refers_to"), "found.*")
    revisits = archive.filter(F.col("type") != RESPONSE).join(originals, "refers_to", "left")
    alone = responses.withColumns({"held": held, "original": F.lit(None).cast("long")})
    columns = ["key", "url", "type", "date", "record_id", "size", "digest", "held", "original"]
    return alone.select(columns).unionByName(revisits.select(columns)).select(
        "key", "url", "type", "date", "record_id",
        F.coalesce("held.found_size", "size").alias("payload_bytes"),
        F.coalesce("held.found_digest", "digest").alias("payload_digest"),
        F.col("original").alias("refers_to"),
        F.col("held.payload").alias("payload"),
    )


def rearchive(spark: SparkSession, sources: list[str], target: str, least: int = 0, written_at: str | None = None) -> None:
    """Archives made one: payloads that repeat across them are kept once, revisits follow their
    digest to the response kept, and every record gets fresh headers."""
    found = None
    for source in sources:
        rows = read(spark, source).select("key", "url", "payload", "digest", "size")
        found = rows if found is None else found.unionAll(rows)
    write(found, target, least, written_at)
