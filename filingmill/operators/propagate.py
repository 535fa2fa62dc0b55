"""Marts after a delivery of some report dates: only what the changed reports reach is computed again.

A changed report reaches the next reports of its institution through lags, all reports of these dates
through ranks, and all banks of its state and date through shares. Each function takes the mart as it
was, the facts before and after, and the dates that were delivered; outside these dates both facts are
the same. What it returns equals the mart built anew.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingmill.operators import marts
from filingmill.operators.ranking import rank_descending
from filingmill.session import stored

_REPORT = ["cert", "repdte"]
_LABELS = ["stalp", "bkclass"]


def changed_keys(before: DataFrame, after: DataFrame, dates: Iterable[date], keys: list[str]) -> DataFrame:
    """Keys of the rows of these dates that were added, removed or changed. Only these dates are read."""
    wanted = F.col("repdte").isin(*dates)
    sides = [df.filter(wanted).withColumn("_sign", F.lit(sign)) for df, sign in ((before, -1), (after, 1))]
    net = sides[0].unionByName(sides[1]).groupBy(*before.columns).agg(F.sum("_sign").alias("_net"))
    return net.filter("_net <> 0").select(*keys).distinct()


def reached_reports(after: DataFrame, changed: DataFrame, following: int) -> DataFrame:
    """`cert`, `repdte` of the changed reports and of the next `following` ones of their institutions.

    Reports that were removed reach those behind them too. One window over the dates of the institutions
    concerned; the number of report dates bounds what one of them brings."""
    present = after.select(*_REPORT).join(changed.select("cert").distinct(), "cert", "left_semi")
    marked = present.withColumn("_here", F.lit(1)).join(changed.withColumn("_changed", F.lit(True)), _REPORT, "full")
    so_far = Window.partitionBy("cert").orderBy("repdte").rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.withColumn("_number", F.count("_here").over(so_far))
    last = F.last(F.when(F.col("_changed"), F.col("_number")), ignorenulls=True).over(so_far)
    return numbered.withColumn("_last", last).filter(F.col("_number") - F.col("_last") <= following).select(*_REPORT)


def _reached(
    before: DataFrame, after: DataFrame, dates: Iterable[date], measures: list[str], following: int
) -> DataFrame:
    """The reports to compute again in a mart of these measures.

    Facts are compared by the columns that the mart is made of: a report of which others changed stays as it
    was there. Changed and reached reports are read several times, and finding them compares all
    facts of the dates, so both are stored."""
    columns = [*_REPORT, *_LABELS, *measures]
    changed = changed_keys(before.select(columns), after.select(columns), dates, _REPORT)
    return stored(reached_reports(after, stored(changed, "changed"), following), "reached")


def _of_institutions(fact: DataFrame, reports: DataFrame) -> DataFrame:
    return fact.join(reports.select("cert").distinct(), "cert", "left_semi")


def latest_financials(mart: DataFrame, before: DataFrame, after: DataFrame, dates: Iterable[date]) -> DataFrame:
    """The latest report of institutions with a changed one is looked up again."""
    certs = changed_keys(before, after, dates, ["cert"])
    fresh = marts.latest_financials(_of_institutions(after, certs))
    return mart.join(certs, "cert", "left_anti").unionByName(fresh)


def profitability_trends(mart: DataFrame, before: DataFrame, after: DataFrame, dates: Iterable[date]) -> DataFrame:
    """Changed reports and the next ones of the same institutions."""
    reached = _reached(before, after, dates, ["roa", "roe"], 1)
    fresh = marts.profitability_trends(_of_institutions(after, reached)).join(reached, _REPORT, "left_semi")
    return mart.join(reached, _REPORT, "left_anti").unionByName(fresh)


def asset_growth(mart: DataFrame, before: DataFrame, after: DataFrame, dates: Iterable[date]) -> DataFrame:
    """Changed reports and the next four of the same institutions, and the ranks of the dates of all these.

    The driver gets the dates that are ranked again, a value for each report date at most, so that the
    other dates are neither read for the ranks nor joined. Rows to rank are stored, as the ranks read them
    twice."""
    reached = _reached(before, after, dates, ["asset"], 4)
    days = [r[0] for r in reached.select("repdte").distinct().collect()]
    on_day = F.col("repdte").isin(*days) if days else F.lit(False)
    growth = marts.asset_growth_unranked(_of_institutions(after, reached)).join(reached, _REPORT, "left_semi")
    others = mart.filter(on_day).drop("qoq_growth_rank").join(reached, _REPORT, "left_anti")
    rows = stored(others.unionByName(growth), "unranked")
    ranked = rank_descending(rows, ["repdte"], "asset_growth_qoq", "qoq_growth_rank")
    return mart.filter(~on_day).unionByName(ranked.select(mart.columns))


def deposit_concentration(mart: DataFrame, before: DataFrame, after: DataFrame, dates: Iterable[date]) -> DataFrame:
    """All banks of the states and dates in which a branch changed; `before` and `after` are branches."""
    dates = list(dates)
    changed = changed_keys(before, after, dates, ["stalpbr", "repdte"]).withColumnRenamed("stalpbr", "state")
    rows = after.filter(F.col("repdte").isin(*dates))
    rows = rows.join(changed.withColumnRenamed("state", "stalpbr"), ["stalpbr", "repdte"], "left_semi")
    return mart.join(changed, ["state", "repdte"], "left_anti").unionByName(
        marts.deposit_concentration(rows).select(mart.columns)
    )
