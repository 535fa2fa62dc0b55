"""Staging views and curated models over the loaded tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingmill.functions.columns import surrogate_key, year_quarter
from filingmill.operators.asof import join_as_of
from filingmill.schemas import (
    BRANCHES,
    FINANCIALS,
    LOW_WATER_MARK,
    OPEN_END,
    PROVENANCE,
    UNKNOWN_NAME,
    UNKNOWN_SK,
)

AsOf = Callable[[DataFrame, DataFrame, str, str, dict[str, str]], DataFrame]


def _staged(df: DataFrame, columns: list[str]) -> DataFrame:
    """A message may bring any text as its provenance; text that is no time is null here."""
    return df.select(
        *columns,
        F.try_to_timestamp(F.col("_ingested_at")).alias("ingested_at"),
        F.col("_batch_id").alias("batch_id"),
    )


def stage_financials(loaded: DataFrame) -> DataFrame:
    return _staged(loaded, [c for c in FINANCIALS.names if c not in PROVENANCE])


def stage_branches(loaded: DataFrame) -> DataFrame:
    return _staged(loaded, [c for c in BRANCHES.names if c not in PROVENANCE])


def stage_history(loaded: DataFrame) -> DataFrame:
    return loaded.select(
        "cert", "name", "city", "state", "bkclass", "regagnt", "holding_company",
        "valid_from", "valid_to", "is_current", "_hash",
    )


def unknown_member(spark: SparkSession) -> DataFrame:
    """The row that facts without a known institution refer to."""
    text = F.lit(None).cast("string")
    return spark.range(1).select(
        F.lit(UNKNOWN_SK).alias("institution_sk"),
        F.lit(None).cast("bigint").alias("cert"),
        F.lit(UNKNOWN_NAME).alias("name"),
        *(text.alias(c) for c in ("city", "state", "bkclass", "regagnt", "holding_company")),
        F.lit(LOW_WATER_MARK).cast("date").alias("valid_from"),
        F.lit(OPEN_END).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_institution(history: DataFrame) -> DataFrame:
    known = history.select(
        surrogate_key(F.col("cert"), F.col("valid_from")).alias("institution_sk"),
        *(c for c in history.columns if c != "_hash"),
    )
    return known.unionByName(unknown_member(history.sparkSession))


def dim_date(financials: DataFrame) -> DataFrame:
    day = F.col("date_day")
    return (
        financials.select(F.col("repdte").alias("date_day"))
        .distinct()
        .select(
            day,
            F.year(day).cast("bigint").alias("year"),
            F.quarter(day).cast("bigint").alias("quarter"),
            year_quarter(day).alias("year_quarter"),
        )
    )


def fct_financials(financials: DataFrame, institutions: DataFrame, as_of: AsOf = join_as_of) -> DataFrame:
    """Each filing with the key of the institution version valid on its report date. `sweep_as_of` is for
    institutions with very many versions."""
    filed = financials.drop("name")
    joined = as_of(filed, institutions, "cert", "repdte", {"institution_sk": "_sk"})
    return joined.select(
        F.coalesce("_sk", F.lit(UNKNOWN_SK)).alias("institution_sk"), *filed.columns
    )
