"""Measures over the fact tables: period-over-period change, concentration, latest report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from filingmill.functions.columns import growth
from filingmill.operators.ranking import rank_descending


def _by_report() -> WindowSpec:
    """Facts hold one row per institution and report date, so the number of report dates bounds
    the rows this window gathers."""
    return Window.partitionBy("cert").orderBy("repdte")


def profitability_trends(fact: DataFrame) -> DataFrame:
    """Change of the return ratios since the institution's previous report."""
    return fact.select(
        "cert",
        "repdte",
        F.col("stalp").alias("state"),
        "bkclass",
        "roa",
        "roe",
        (F.col("roa") - F.lag("roa").over(_by_report())).alias("roa_qoq_change"),
        (F.col("roe") - F.lag("roe").over(_by_report())).alias("roe_qoq_change"),
    )


def asset_growth_unranked(fact: DataFrame) -> DataFrame:
    """Growth since the previous and the fourth-previous report."""
    return fact.select(
        "cert",
        "repdte",
        F.col("stalp").alias("state"),
        "bkclass",
        "asset",
        growth(F.col("asset"), F.lag("asset").over(_by_report())).alias("asset_growth_qoq"),
        growth(F.col("asset"), F.lag("asset", 4).over(_by_report())).alias("asset_growth_yoy"),
    )


def asset_growth(fact: DataFrame) -> DataFrame:
    """Asset growth with the rank of its quarterly growth among all reports of the date."""
    return rank_descending(
        asset_growth_unranked(fact), ["repdte"], "asset_growth_qoq", "qoq_growth_rank"
    )


def latest_financials(fact: DataFrame) -> DataFrame:
    """The most recent report of each institution, which may be older than the newest date.

    A two-column maximum, combined before the shuffle, in place of sorting each history.
    """
    return fact.groupBy("cert").agg(
        F.max("repdte").alias("latest_repdte"), F.max_by("asset", "repdte").alias("latest_asset")
    )


def bank_state_deposits(branches: DataFrame) -> DataFrame:
    return branches.groupBy("cert", F.col("stalpbr").alias("state"), "repdte").agg(
        F.sum("depsumbr").alias("total_deposits")
    )


def state_totals(bank_states: DataFrame) -> DataFrame:
    return bank_states.groupBy("state", "repdte").agg(
        F.sum("total_deposits").alias("state_total_deposits"),
    )


def deposit_concentration(branches: DataFrame) -> DataFrame:
    """Each bank's share of a state's deposits and the state's Herfindahl index.

    The index is the sum of squared shares, that is the sum of squared deposits over the squared
    total, so both state figures come from one pre-combined aggregation and no window gathers a
    state. Deposits without a state have no share and drop out at the join.
    """
    banks = bank_state_deposits(branches)
    states = banks.groupBy("state", "repdte").agg(
        F.sum("total_deposits").alias("_total"),
        F.sum(F.pow("total_deposits", F.lit(2))).alias("_squares"),
    )
    share = F.try_divide(F.col("total_deposits"), F.col("_total"))
    index = F.try_divide(F.col("_squares"), F.pow("_total", F.lit(2))) * 10000
    return banks.join(states, ["state", "repdte"]).select(
        "cert",
        "state",
        "repdte",
        "total_deposits",
        share.alias("deposit_share"),
        index.alias("state_hhi"),
    )
