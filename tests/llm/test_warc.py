"""WARC: round trips, revisits, odd payloads."""

import base64
import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from filingmill.llm import queries, warc

PAYLOADS = [
    "", "a", "a\r\n", "a\r\n\r\n", "\r\n\r\na", "a\r\n\r\n\r\nb", "a\r\n\r", "a\r\r\n\r\nb", "\r\n", "\n\n", "é日😀\r\n\r\nWARC/1.1\r\n",
    "x" * 3_000_000 + "\r\n\r\n", "a", "a", None, "\r", "a\r\n\r\n\r", "\r\n\r\n" * 7,
]


def digest(payload):
    return base64.b32encode(hashlib.sha1((payload or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(100 - i, f"http://h/{i}\n x" if i % 5 else None, p, "t") for i, p in enumerate(PAYLOADS)]
    return spark.createDataFrame([*rows, (None, "u", "only", "t"), (None, "u", "only", "t"), (3, "u", "one", "t"), (3, "v", "one", "t")], "page_id long, url string, html string, type string")


@pytest.mark.parametrize("least", [0, 2])
def test_round_trip(spark, pages, tmp_path, least):
    folder = str(tmp_path / "archive")
    warc.write(warc.records(pages), folder, least)
    found = warc.followed(warc.read(spark, folder)).collect()
    assert len(found) == pages.count()
    by_key = {r.key: r for r in found if r.key not in (None, 3)}
    first = {}
    for i, payload in sorted(enumerate(PAYLOADS), reverse=True):
        first.setdefault(payload or "", 100 - i)
    for i, payload in enumerate(PAYLOADS):
        row, payload = by_key[100 - i], payload or ""
        assert row.payload == payload and row.payload_bytes == len(payload.encode()) and row.payload_digest == digest(payload)
        original = first[payload] if len(payload.encode()) >= least else 100 - i
        expected = ("response", None) if original == 100 - i else ("revisit", original)
        assert (row.type, row.refers_to) == expected
    assert [r.type for r in found if r.key in (None, 3)] == ["response"] * 4


def test_archives_made_one(spark, pages, tmp_path):
    a, b, one = (str(tmp_path / x) for x in "abc")
    warc.write(warc.records(pages), a)
    more = spark.createDataFrame([(1, "z", "a"), (200, "z", "new")], "page_id long, url string, html string")
    warc.write(warc.records(more), b)
    warc.rearchive(spark, [a, b], one, written_at="2026-01-01T00:00:00Z")
    found = {r.key: r for r in warc.followed(warc.read(spark, one)).collect()}
    assert found[1].type == "response" and found[200].payload == "new"
    again = [100 - i for i, p in enumerate(PAYLOADS) if p == "a"]
    assert all((found[k].type, found[k].refers_to, found[k].payload) == ("revisit", 1, "a") for k in again)
    assert {r.date for r in found.values()} == {"2026-01-01T00:00:00Z"}


@given(st.lists(st.text(st.sampled_from("ab\r\n"), max_size=12), max_size=5))
def test_reader_takes_any_cuts(blocks):
    archive = b"".join(
        f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {len(b)}\r\n\r\n{b}\r\n\r\n".encode() for b in blocks
    )
    reader = warc.Reader()
    pieces = archive.split(b"\r\n\r\n")
    found = [block.decode() for piece in pieces for _, block in reader.take(piece)]
    assert found == blocks


def test_query_and_empty_table(spark, pages, tmp_path):
    found = queries.op8_warc(spark, "/root/testdata/sf0.001")
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] and found.count() == 50
    warc.write(warc.records(pages.limit(0)), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0
