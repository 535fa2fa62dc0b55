"""The pipeline's stages against brute force on the smallest tables, and its contract."""

import hashlib
import itertools
import re

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from filingmill.llm import langid, pii
from tests.llm import test_decontaminate, test_jaccard, test_pii

SF = "/root/testdata/sf0.001"


def first_of_groups(rows):
    """rows by doc_id; of five-word shingles, 0.8 or more."""
    sets = {i: test_jaccard.shingles(t, 5) for i, t in rows.items()}
    parent = {i: i for i in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(sets, 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: t for i, t in rows.items() if root(i) == i}


def without_passages(text, items):
    _, hit, _ = test_decontaminate.brute_force(text, items, 10)
    places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    out, at = [], 0
    for k, (start, end) in enumerate(places):
        if k in hit and k - 1 not in hit:
            out.append(text[at:start])
        if k in hit:
            at = end
    return "".join([*out, text[at:]])


def redacted(text):
    out, at = [], 0
    for kind, start, end in sorted(test_pii.brute_force(text), key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], "[" + list(test_pii.PATTERNS)[kind].upper() + "]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_stages_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pii, "train", lambda docs: pii.Model())  # the patterns alone
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out()))
    kept = langid.identify(docs, model).filter(F.col("score") >= corpus_pipeline.MIN_SHARE)
    ids = {r.doc_id for r in kept.collect()}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id in ids}
    assert len(rows) > 0.98 * docs.count()
    rows = first_of_groups(rows)
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {i: redacted(without_passages(t, items)) for i, t in rows.items()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for i, text in rows.items():
        found = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(found, skip_special_tokens=False)
        expected.append((i, len(found), sha(" ".join(map(str, found))), sha(decoded)))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(expected)


def test_all_but_the_last_stage_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.limit(40).withColumns({"found": F.lit(1), "key": F.lit("k")})
    odd = spark.createDataFrame([(None, None, None, None, None, 1, "k"), (None, "the and of", "en", "s", 3, 1, "k")], more.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (more.unionByName(odd), more.limit(0)):
            out = stage(spark, table, SF)
            assert out.columns == more.columns, name
            assert out.count() <= table.count()
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).count() == 2


def test_lengths_follow_the_texts(spark):
    docs = spark.createDataFrame([(1, "call +1 (743) 555-3824 now", 26)], "doc_id long, text string, n_chars int")
    row = pii.redacted(docs, pii.Model()).first()
    assert (row.text, row.n_chars) == ("call [PHONE] now", 16)
