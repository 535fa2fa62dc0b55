"""Parameterised reads over the curated tables, as pages of typed records."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingmill.operators.asof import join_as_of
from filingmill.operators.ranking import ranked_page
from filingmill.schemas import (
    FINANCIAL_PERIOD,
    HEALTH,
    INSTITUTION,
    METRICS,
    RANKING_ENTRY,
    UNKNOWN_SK,
)
from filingmill.sources.warehouse import FRESHNESS_TABLE, Warehouse

logger = logging.getLogger(__name__)

# Why a warehouse is degraded.
NO_TABLE = "Nothing was ever published: there is no freshness table."
NOT_PUBLISHED = "The freshness table is empty."
UNREADABLE = "The freshness table cannot be read."

# Fixed values of the paging contract.
DEFAULT_LIMIT = 50
MAX_LIMIT = 500


@dataclass(frozen=True)
class Page:
    """Rows of one page and whether another follows, known from one extra row instead of a count.

    `after` is the key of the last row if another page follows, to ask for it by."""

    items: list[Row]
    limit: int
    offset: int
    has_more: bool
    after: int | date | None = None


class NotFoundError(LookupError):
    """No current institution has the requested key."""


def fetch_page(lookahead: DataFrame, limit: int, offset: int, key: str | None = None) -> Page:
    rows = lookahead.collect()  # at most limit + 1 rows
    more = len(rows) > limit
    return Page(rows[:limit], limit, offset, more, rows[limit - 1][key] if more and key else None)


def contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns and types of a response; a missing or differently typed one raises."""
    for field in schema.fields:
        if field.name not in df.columns:
            raise ValueError(f"response column {field.name} is missing")
        if df.schema[field.name].dataType != field.dataType:
            raise ValueError(f"response column {field.name} is {df.schema[field.name].dataType}")
    return df.select(*schema.names)


def _check_page(limit: int, offset: int) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")


def _check_state(state: str | None) -> str | None:
    if state is None:
        return None
    if not re.fullmatch("[A-Za-z]{2}", state):
        raise ValueError("state must be two letters")
    return state.upper()


def _check_class(bkclass: str | None) -> str | None:
    if bkclass is not None and len(bkclass) > 4:
        raise ValueError("bkclass has at most four characters")
    return bkclass.upper() if bkclass else None


def _check_cert(cert: int) -> None:
    if cert < 1:
        raise ValueError("cert must be positive")


def _check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}; one of {', '.join(METRICS)}")


def _page(rows: DataFrame, order: list[str], limit: int, offset: int) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(limit + 1)


def _after(rows: DataFrame, key: str, after: int | date | None) -> DataFrame:
    """Rows behind the last one of the page before. The bound reaches the scan, whose files are in
    ranges of the key, so a page deep in the list reads and keeps no row of those before it."""
    return rows if after is None else rows.filter(F.col(key) > F.lit(after))


def list_institutions(
    institutions: DataFrame,
    latest: DataFrame,
    *,
    state: str | None = None,
    bkclass: str | None = None,
    min_asset: float | None = None,
    max_asset: float | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    after: int | None = None,
) -> DataFrame:
    """One page of current, known institutions in key order, plus the look-ahead row.

    Pages are asked for by the last key of the page before, `after`, or by `offset`, which keeps all
    rows before it and is for the first pages. An absent bound filters nothing; an institution without figures is outside any asset bound.
    Without a bound the page is cut first, so that few rows meet the figures.
    """
    _check_page(limit, offset)
    rows = institutions.filter(F.col("is_current") & (F.col("institution_sk") != UNKNOWN_SK))
    rows, latest = _after(rows, "cert", after), _after(latest, "cert", after)
    if state is not None:
        rows = rows.filter(F.col("state") == state)
    if bkclass is not None:
        rows = rows.filter(F.col("bkclass") == bkclass)
    if min_asset is None and max_asset is None:
        page = _page(rows, ["cert"], limit, offset)
        return contract(page.join(latest, "cert", "left"), INSTITUTION).orderBy("cert")
    figures = latest
    if min_asset is not None:
        figures = figures.filter(F.col("latest_asset") >= min_asset)
    if max_asset is not None:
        figures = figures.filter(F.col("latest_asset") <= max_asset)
    return _page(contract(rows.join(figures, "cert"), INSTITUTION), ["cert"], limit, offset)


def get_institution(institutions: DataFrame, fact: DataFrame, cert: int) -> DataFrame:
    """The current version of one institution with its latest figures, or no row."""
    latest = (
        fact.filter(F.col("cert") == cert)
        .orderBy(F.col("repdte").desc_nulls_last())
        .limit(1)
        .select("cert", F.col("asset").alias("latest_asset"), F.col("repdte").alias("latest_repdte"))
    )
    current = institutions.filter((F.col("cert") == cert) & F.col("is_current"))
    return contract(current.join(latest, "cert", "left").limit(1), INSTITUTION)


def institution_financials(
    fact: DataFrame,
    cert: int,
    *,
    date_from: date | None = None,
    date_to: date | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    after: date | None = None,
) -> DataFrame:
    """One page of an institution's reports, oldest first, plus the look-ahead row; `after` is the date of
    the last report of the page before."""
    _check_page(limit, offset)
    rows = _after(fact.filter(F.col("cert") == cert), "repdte", after)
    if date_from is not None:
        rows = rows.filter(F.col("repdte") >= F.lit(date_from))
    if date_to is not None:
        rows = rows.filter(F.col("repdte") <= F.lit(date_to))
    periods = contract(rows.withColumnRenamed("stalp", "state"), FINANCIAL_PERIOD)
    return _page(periods, ["repdte"], limit, offset)


def rankings(
    mart: DataFrame,
    institutions: DataFrame,
    metric: str,
    *,
    state: str | None = None,
    period: date | None = None,
    latest: DataFrame | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> DataFrame:
    """One page of the ranking by a metric on one report date, plus the look-ahead row.

    Without a period it is the latest: the one value of `latest`, such as that of the published
    freshness, or else the mart's last date, which costs a scan. Names are joined to the page only.
    """
    _check_metric(metric)
    _check_page(limit, offset)
    column = METRICS[metric][1]
    if period is not None:
        day = F.lit(period)
    else:
        day = (mart.select(F.max("repdte")) if latest is None else latest).scalar()
    rows = mart.filter(F.col("repdte") == day)
    if state is not None:
        rows = rows.filter(F.col("state") == state)
    rows = rows.filter(F.col(column).isNotNull()).select(
        "cert", "state", "repdte", F.col(column).alias("value")
    )
    page = ranked_page(rows, "value", "cert", limit + 1, offset)
    named = join_as_of(page, institutions, "cert", "repdte", {"name": "name"})
    entries = named.withColumn("metric", F.lit(metric))
    return contract(entries, RANKING_ENTRY).orderBy("rank", "cert")


def health(freshness: DataFrame) -> DataFrame:
    """One row: ok with the published freshness, degraded when nothing was published."""
    fields = ("published_at", "max_repdte", "financials_row_count")
    row = freshness.limit(1).agg(
        F.count("*").alias("_rows"), *(F.first(name).alias(name) for name in fields)
    )
    found = F.col("_rows") > 0
    return row.select(
        F.when(found, "ok").otherwise("degraded").alias("status"),
        *fields,
        F.when(~found, NOT_PUBLISHED).alias("detail"),
    ).to(HEALTH)


def degraded(spark: SparkSession, detail: str) -> Row:
    return spark.createDataFrame([("degraded", None, None, None, detail)], HEALTH).first()


@dataclass(frozen=True)
class Reads:
    """The five reads over a published warehouse, with checked arguments."""

    warehouse: Warehouse

    def _table(self, name: str) -> DataFrame:
        return self.warehouse.table(name)

    def institutions(
        self,
        *,
        state: str | None = None,
        bkclass: str | None = None,
        min_asset: float | None = None,
        max_asset: float | None = None,
        limit: int = DEFAULT_LIMIT,
        offset: int = 0,
        after: int | None = None,
    ) -> Page:
        _check_page(limit, offset)
        if any(bound is not None and bound < 0 for bound in (min_asset, max_asset)):
            raise ValueError("asset bounds must not be negative")
        rows = list_institutions(
            self._table("dim_institution"),
            self._table("mart_latest_financials"),
            state=_check_state(state),
            bkclass=_check_class(bkclass),
            min_asset=min_asset,
            max_asset=max_asset,
            limit=limit,
            offset=offset,
            after=after,
        )
        return fetch_page(rows, limit, offset, "cert")

    def institution(self, cert: int) -> Row:
        _check_cert(cert)
        row = get_institution(
            self._table("dim_institution"), self._table("fct_bank_quarterly_financials"), cert
        ).first()
        if row is None:
            raise NotFoundError(f"no current institution with cert {cert}")
        return row

    def financials(
        self,
        cert: int,
        *,
        date_from: date | None = None,
        date_to: date | None = None,
        limit: int = DEFAULT_LIMIT,
        offset: int = 0,
        after: date | None = None,
    ) -> Page:
        _check_cert(cert)
        _check_page(limit, offset)
        if date_from and date_to and date_from > date_to:
            raise ValueError("date_from must not be later than date_to")
        fact = self._table("fct_bank_quarterly_financials")
        rows = institution_financials(
            fact, cert, date_from=date_from, date_to=date_to, limit=limit, offset=offset, after=after
        )
        return fetch_page(rows, limit, offset, "repdte")

    def rankings(
        self,
        metric: str = "roa",
        *,
        state: str | None = None,
        period: date | None = None,
        limit: int = DEFAULT_LIMIT,
        offset: int = 0,
    ) -> Page:
        _check_metric(metric)
        _check_page(limit, offset)
        rows = rankings(
            self._table(METRICS[metric][0]),
            self._table("dim_institution"),
            metric,
            state=_check_state(state),
            period=period,
            latest=self._table(FRESHNESS_TABLE).select(F.max("max_repdte")),
            limit=limit,
            offset=offset,
        )
        return fetch_page(rows, limit, offset)

    def health(self) -> Row:
        """Never raises for the state of the warehouse; the row says what is wrong."""
        spark = self.warehouse.spark
        try:
            if not self.warehouse.exists(FRESHNESS_TABLE):
                return degraded(spark, NO_TABLE)
            return health(self._table(FRESHNESS_TABLE)).first()
        except (PySparkException, Py4JJavaError) as error:
            logger.warning("health: %s", error)
            return degraded(spark, UNREADABLE)
