"""Token counts of whole texts and of every prefix, against the tokenizers library."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from filingmill.llm import counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = "aab cde'sTé́ñ  \x1c\x85​12³½日ไ😀\n\n\t!?__-'l'r﻿"
texts = st.text(st.one_of(st.sampled_from(ODD), st.characters(exclude_categories=["Cs", "Cn"])), max_size=30)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def size(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(texts, st.sampled_from(["", "<|endoftext|>", " <|endoftext|>\n ", "!<|endoftext|>"]), texts)
def test_every_prefix(library, head, special, tail):
    model, text = counts.load(PATH), head + special + tail
    assert model.prefix_counts(text) == [size(library, text[:i]) for i in range(len(text) + 1)]
    assert model.count([text, head, text]) == [size(library, t) for t in (text, head, text)]


def test_budget(spark, library):
    rows = [(1, "one two  three's\n\nfour " * 50), (2, None), (3, "日本語" * 2000), (4, "short")]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_bytes int")
    for row in counts.budget_cuts(docs, PATH, 40).collect():
        text = dict(rows)[row.doc_id] or ""
        assert row.text == text[: row.n_chars]
        assert size(library, row.text) <= 40
        assert row.n_chars == len(text) or size(library, text[: row.n_chars + 1]) > 40


def test_token_counts(spark, library):
    rows = [(1, "a b"), (2, None), (3, ""), (3, ""), (4, "word " * 1024), (5, "word" + " word" * 1023), (6, "ab" * 50_000)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, over_limit int")
    found = sorted(map(tuple, counts.token_counts(docs, PATH).collect()))
    expected = []
    for i, text in rows:
        n = size(library, text or "")
        expected.append((i, len((text or "").encode()), n, n > 1024))
    assert found == sorted(expected)
    assert counts.token_counts(docs.limit(0), PATH).count() == 0
