"""Language identification: paths against brute force, held-out accuracy, odd rows."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from filingmill.llm import langid, queries

DOCS = "/root/testdata/sf0.01/documents.parquet"


def model_of(rng, languages=3, grams="abcde"):
    scores = np.append(rng.uniform(-3, 0, (len(grams), languages)), np.zeros((1, languages)), axis=0)
    scripts = {"Latin": np.ones(languages, bool), "Greek": np.array([True] + [False] * (languages - 1))}
    return langid.Model(["x", "y", "z"][:languages], {g: i for i, g in enumerate(grams)}, scores, scripts)


def test_paths_equal_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        labeller = langid.Labeller(model_of(rng), penalty=rng.uniform(0, 4))
        texts = [["".join(rng.choice([*"abcde"], 2)) for _ in range(rng.integers(0, 7))] for _ in range(4)]
        for words, labels in zip(texts, labeller.labels(texts)):

            def value(path):
                table = labeller.table[[labeller.number[w] for w in words]]
                switches = sum(a != b for a, b in zip(path, path[1:]))
                return table[np.arange(len(words)), list(path)].sum() - labeller.penalty * switches

            if words:
                best = max(map(value, itertools.product(range(3), repeat=len(words))))
                assert abs(value(labels.tolist()) - best) < 1e-9
            else:
                assert len(labels) == 0


def test_script_narrows_languages():
    labeller = langid.Labeller(model_of(np.random.default_rng(1)))
    assert [len(s) and s[0][2] for s in labeller.spans(["αβγ δεζ", "日本", "", "12 34"])][0] == "x"
    assert labeller.spans(["", "12 34"]) == [[], []]


def test_spans_of_mixed_text(spark):
    docs = spark.read.parquet(DOCS)
    model = langid.train(docs.filter(~langid.held_out()))
    texts = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", "n_chars").alias("text")).collect()}
    text = "1. " + texts["en"][:900] + "\n" + texts["de"][:900] + "…"
    (spans,) = langid.Labeller(model).spans([text])
    assert [s[2] for s in spans] == ["en", "de"]
    assert abs(spans[0][1] - 903) < 80 and spans[0][0] == 3 and spans[1][1] == len(text) - 1


def test_held_out_accuracy_and_what_is_learned(spark):
    docs = spark.read.parquet(DOCS)
    found = queries.op1_langid(spark, DOCS.rpartition("/")[0]).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert found.count() == docs.count() and held > 0.98
    # Labels of held-out rows change nothing.
    spoiled = docs.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang")))
    a, b = (langid.train(d.filter(~langid.held_out())) for d in (docs, spoiled))
    assert a.languages == b.languages and a.grams == b.grams and (a.scores == b.scores).all()


def test_odd_rows(spark):
    rows = [(1, "der die das und", "de"), (2, None, "de"), (3, "", None), (4, "12 !?", "en"), (5, "the the of", "en"),
            (6, "the " * 200_000, "en"), (6, "the " * 200_000, "en"), (None, "the", "en")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    model = langid.train(docs)
    found = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 4, 5, 6, None)] == ["de", "und", "und", "und", "en", "en", "en"]
    assert found[2].score == 0 and found[2].spans == [] and found[6].score == 1
    assert langid.identify(docs.limit(0), model).count() == 0
    nothing = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_clean_texts_are_kept(spark):
    """Texts in three languages, and all that have letters if there are no labels."""
    docs = spark.read.parquet(DOCS)
    model = langid.train(docs.filter(~langid.held_out()))
    texts = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", "n_chars").alias("text")).collect()}
    third = "\n".join(texts[lang][:600] for lang in sorted(texts)[:3])
    assert langid.identify(spark.createDataFrame([(1, third)], "doc_id long, text string"), model).first().score < 0.4
    rows = spark.createDataFrame([(1, third, None), (2, "12 !?", None), (3, None, None)], "doc_id long, text string, lang string")
    for known in (model, langid.train(rows)):
        assert [r.doc_id for r in langid.keep_identified(rows, known, 0.4).collect()] == [1]


def test_words_end_at_signs_that_are_no_letters():
    assert langid.words_of("m² xⅧ ½a H₂O a1b c_d É²é ١٢") == ["m", "x", "a", "h", "o", "a", "b", "c", "d", "é", "é"]
    assert langid.words_of("² ½ Ⅷ 12") == []
    labeller = langid.Labeller(model_of(np.random.default_rng(1)))
    assert [[s[3] for s in found] for found in labeller.spans(["m²", "½ ²", "H₂O"])] == [[1], [], [2]]


def test_bulk_scores_equal_sums_over_grams():
    words = ["a", "ab", "abcde", "abcdefgh", "é", "日本語", "z" * 32, "𐐷x"]
    grams = sorted({g for w in words[:-1] for g in langid.grams_of(w)})[::2]
    rng = np.random.default_rng(0)
    scores = rng.uniform(-3, 0, (len(grams) + 1, 2))
    model = langid.Model(["x", "y"], {g: i for i, g in enumerate(grams)}, scores, {})
    expected = [sum(scores[model.grams.get(g, len(grams))] for g in langid.grams_of(w)) for w in words]
    assert np.allclose(langid.Labeller(model)._scores(words), expected)
    empty = langid.Model(["x"], {}, np.array([[-1.0]]), {})
    assert langid.Labeller(empty)._scores(["ab"]).tolist() == [[-1.0 * len(langid.grams_of("ab"))]]


def test_no_language_is_left_out(spark):
    rows = [(i, chr(0x4E00 + i % 300) * 3, f"l{i % 300}") for i in range(600)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 300
