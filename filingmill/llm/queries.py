"""The operators of this subpackage as queries over the supplied tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingmill.llm import bpe, counts, decontaminate, jaccard, langid, nearest, oracle, pages, pii, tokenfile, trie, urls, warc, whitening
from filingmill.llm.common import stored, table
from filingmill.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
END = 2  # stands after each document in files of ids
URL_RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    # The row's key is all that a prediction's fold depends on, so no join brings it back.
    found = langid.identify(docs, model).withColumn("held_out", langid.held_out())
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))

    def text(spans: str):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, pii.KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("all_spans").alias("spans")
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_join(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(warc.records(table(spark, sf_dir, "pages")), folder)
    found = warc.followed(stored(warc.read(spark, folder, payload=False), "records"))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label with its id."""
    judged = urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    tokenfile.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(BYTE_VOCABULARY), END)
    return tokenfile.digests(spark, folder).withColumnRenamed("key", "doc_id")


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (op1_langid, op2_page_text, op3_pii, op4_bpe, op5_token_counts, op6_jaccard_join, op7_decontaminate, op8_warc, op9_nearest, op10_url_filter, op11_prefix_trie, op12_whitening, op13_token_files)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
