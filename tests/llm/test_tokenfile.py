"""Directly addressable codes: round trips, access at any place, and the files against the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from filingmill.llm import tokenfile
from filingmill.llm.queries import BYTE_VOCABULARY, END, op13_token_files

PATH = public_tokenizers.path(BYTE_VOCABULARY)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 511, 512, 513, 5000])
@pytest.mark.parametrize("top", [1, 255, 256, 257, 65_536, 65_537, 1 << 40])
def test_codes_give_back_any_id_and_any_run(n, top):
    rng = np.random.default_rng(n + top)
    for ids in (rng.integers(0, top, n), np.full(n, top - 1), np.arange(n) % top):
        codes = tokenfile.Codes(tokenfile.encode(ids))
        assert len(codes) == n
        assert (codes.slice(0, n) == ids).all()
        for i in {0, 1, 62, 63, 64, 511, 512, 513, n // 2, n - 1}:
            if 0 <= i < n:
                assert codes.get(i) == ids[i]
        for a, b in rng.integers(0, n + 1, (20, 2)):
            assert (codes.slice(a, b) == ids[a:b]).all()
    with pytest.raises(IndexError):
        tokenfile.Codes(tokenfile.encode(np.arange(n))).get(n)
    with pytest.raises(ValueError):
        tokenfile.Codes(b"DAC2" + bytes(20))


ODD = [
    "", None, " ", "  ", "a", "a ", " a", "a  b", "a \n b", "\n\nx", "x\t", "tab\t\ttab  ", "don't we'll 'tis",
    "<|endoftext|>", "a<|endoftext|>b", "a <|endoftext|> b", "<|endoftext|><|endoftext|> ", "<|endof text|>",
    "  nb ", " em  x", "\x1c\x1d a", "\x85next\x85\x85", "日本語 テキスト　全角", "é ​​ z", "😀😀 😀", "١٢٣ ²³", "x" * 3000, "ab " * 40_000,
]


def expected(rows):
    library, before, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, END]
        out.append((key, before, len(ids), ids))
        before += len(ids)
    return out


def test_files_hold_what_the_library_gives(spark, tmp_path, monkeypatch):
    rows = [(3 * i - 20, t) for i, t in enumerate(ODD)] + [(None, "of no key"), (1 << 40, "last")]
    frame = spark.createDataFrame([(t, k, 1, 2) for k, t in reversed(rows)], "text string, doc_id long, start int, key int")
    folder = str(tmp_path / "ids")
    tokenfile.write(frame, folder, PATH, END, segment=20)
    want = expected(rows)
    assert [tuple(r) for r in tokenfile.documents(spark, folder).orderBy("start").collect()] == want
    found = tokenfile.digests(spark, folder).orderBy("start").collect()
    assert [r.ids_crc32 for r in found] == [zlib.crc32(np.array(ids, "<u4").tobytes()) for *_, ids in want]
    assert tokenfile.segments(spark, folder).count() > 5

    # Each token of some documents at its address, one document by many lists, and places that are none.
    monkeypatch.setattr(tokenfile, "LIST", 100)
    asked = [(key, i) for key, _, n, _ in want for i in range(-1, min(n, 300) + 1)] + [(10**6, 0), (None, 0), (7, None)]
    tokens = {(key, i): x for key, _, _, ids in want for i, x in enumerate(ids) if key is not None}
    got = tokenfile.lookup(spark, folder, spark.createDataFrame(asked, "key long, place long")).collect()
    assert sorted(map(tuple, got)) == sorted((k, i, tokens[k, i]) for k, i in asked if (k, i) in tokens)


def test_empty_table_and_shared_keys(spark, tmp_path):
    frame = spark.createDataFrame([(5, "one"), (5, "one"), (5, "two words"), (1, None)], "doc_id long, text string")
    tokenfile.write(frame.limit(0), str(tmp_path / "none"), PATH, END)
    assert tokenfile.documents(spark, str(tmp_path / "none")).count() == 0
    tokenfile.write(frame, str(tmp_path / "some"), PATH, END)
    found = tokenfile.documents(spark, str(tmp_path / "some")).orderBy("start").collect()
    assert [r.key for r in found] == [1, 5, 5, 5] and found[0].ids == [END]
    assert [r.start for r in found] == [sum(x.n_tokens for x in found[:i]) for i in range(4)]


def test_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = op13_token_files(spark, folder).orderBy("doc_id").collect()
    want = [(k, s, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for k, s, n, ids in expected(rows)]
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found] == want
