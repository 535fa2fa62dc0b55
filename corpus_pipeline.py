"""Documents to training tokens: each stage is written as Parquet and read back as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from filingmill.llm import bpe, decontaminate, jaccard, langid, pii
from filingmill.llm.common import stored, table
from filingmill.llm.queries import WORD_VOCABULARY


MIN_SHARE = 0.4  # of a text's letters in its main language or in long spans; below, it is a jumble


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without letters, and jumbles of short spans without a main language, go; the
    others get the language found where they had none. Without any label to learn from, none is found."""
    model = langid.train(docs.filter(~langid.held_out()))
    return langid.keep_identified(docs, model, MIN_SHARE)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of documents linked by five-word shingles and a similarity of 0.8 or more,
    directly or through others, the one with the smallest doc_id stays."""
    return jaccard.first_of_groups(docs, words=5, percent=80)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: passages of the benchmark are cut out of the texts."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: personal data is replaced by its kind."""
    return pii.redacted(docs, pii.train(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding: every document's number of tokens and the digests of both."""
    return bpe.digests(docs, public_tokenizers.path(WORD_VOCABULARY))


STAGES = [
    ("language", language),
    ("deduplicated", deduplicated),
    ("benchmark_free", benchmark_free),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
