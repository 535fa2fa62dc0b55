"""Every operator as a query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingmill.functions.columns import quarter_end
from filingmill.operators import marts, projection, propagate, ranking, splice
from filingmill.operators.asof import sweep_as_of
from filingmill.operators.dedupe import latest_per_key
from filingmill.operators.projection import (
    BAD_CAST,
    BAD_VALUES,
    project_branches,
    project_financials,
)
from filingmill.operators.quarantine import clean_branches, clean_financials, quarantine_split
from filingmill.operators.scd2 import build_history, rejected_snapshots
from filingmill.plans import models, quality, serving
from filingmill.plans.inputs import Inputs
from filingmill.plans.refresh import BAD, FINANCIALS_CLEANING, Lake, clean_dates
from filingmill.plans.refresh import clean as clean_all
from filingmill.schemas import (
    BANK_CLASSES,
    BRANCHES,
    BRANCH_DICTIONARY,
    BRANCH_KEY,
    DT_MARKER,
    FINANCIALS,
    FINANCIALS_FIELDS,
    FINANCIALS_KEY,
    HISTORY,
    METRICS,
    UNKNOWN_SK,
    columns_of,
)
from filingmill.sources import drift, landing, messages
from filingmill.sources.warehouse import (
    FRESHNESS_TABLE,
    Warehouse,
    freshness,
    load_table,
    publish_freshness,
)
from filingmill.streaming import counts
from filingmill.streaming import landing as stream

Query = Callable[[SparkSession, str], DataFrame]

PUBLISHED_AT = datetime(2026, 1, 1, tzinfo=UTC)
DEEP_OFFSET = 900
PAGE_SIZE = 10_000  # records per page, the interface's cap

_QUERIES: dict[str, Query] = {}


def _add(name: str, build: Callable[[Inputs], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))


def _query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query under its function's name; a trailing underscore avoids an import's name."""
    _add(build.__name__.rstrip("_"), build)
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- sources, sinks, table input and output ------------------------------------------------------


def _pages(i: Inputs, delivered: str) -> DataFrame:
    """Orders as landed pages per quarter: every order is announced, the `delivered` ones arrive."""
    record = F.struct(
        F.col("o_orderkey").alias("ID"),
        F.col("o_custkey").alias("CERT"),
        F.col("o_totalprice").alias("ASSET"),
        F.col("o_orderpriority").alias("NAME"),
    )
    item = F.struct(record.alias("data"), F.lit(0.0).alias("score"))
    orders = i.table("orders").withColumn(
        "source", F.date_format(quarter_end(F.col("o_orderdate").cast("date")), "yyyyMMdd")
    )
    announced = orders.groupBy("source").agg(F.count("*").alias("total"))
    pages = (
        orders.filter(delivered)
        .groupBy("source", F.floor(F.col("o_orderkey") / PAGE_SIZE).alias("page"))
        .agg(F.collect_list(item).alias("data"))  # at most one page size of order keys
        .join(announced, "source")
    )
    folder = i.folder("pages")
    body = F.to_json(F.struct(F.struct("total").alias("meta"), "data")).alias("value")
    pages.select("source", body).write.partitionBy("source").text(folder)
    schema = columns_of("ID bigint, CERT bigint, ASSET double, NAME string")
    return landing.read_pages(i.spark, folder, schema, page_per_file=False)


@_query
def pages_unwrap(i: Inputs) -> DataFrame:
    return landing.unwrap_pages(_pages(i, "true"))


@_query
def pages_complete(i: Inputs) -> DataFrame:
    pages = _pages(i, "o_orderstatus <> 'P'")
    return landing.incomplete_pages(pages, ["source"]).withColumn(
        "source", F.col("source").cast("string")
    )


@_query
def raw_stamp(i: Inputs) -> DataFrame:
    replayed = F.col("BKCLASS") == "BUILDING"
    records = i.raw_financials.withColumns(
        {c: F.when(replayed, F.col(c)) for c in ("_ingested_at", "_batch_id")}
    )
    return landing.stamp_raw(
        records,
        source_url=F.concat(F.lit("file:/landed/"), "REPDTE"),
        batch_id="batch-1",
        ingested_at=PUBLISHED_AT,
        extra={"_consumed_at": F.lit(PUBLISHED_AT.isoformat())},
    )


@_query
def raw_union_keys(i: Inputs) -> DataFrame:
    old = i.raw_financials.filter("REPDTE < '19980101'").select("CERT", "_batch_id", "NAME")
    new = i.raw_financials.filter("REPDTE >= '19980101'").select("CERT", "_batch_id", "STALP")
    return landing.union_of_fields([old, new])


def _land_financials(i: Inputs, root: str, records: DataFrame) -> str:
    landing.land(
        records, root, "financials", F.col("REPDTE"), source_url="file:/landed", batch_id="batch-1"
    )
    return landing.dataset_path(root, "financials")


@_query
def raw_overwrite(i: Inputs) -> DataFrame:
    """Two deliveries; the second replaces only the partitions it has rows for."""
    root = i.folder("raw")
    _land_financials(i, root, i.raw_financials)
    restated = i.raw_financials.filter("REPDTE >= '19980101'").withColumn("ASSET", F.col("ASSET") + 1)
    path = _land_financials(i, root, restated)
    return i.spark.read.parquet(path).select(*i.raw_financials.columns)


@_query
def partitions(i: Inputs) -> DataFrame:
    path = _land_financials(i, i.folder("raw"), i.raw_financials)
    found = [(value,) for value in landing.partition_values(i.spark, path)]
    return i.spark.createDataFrame(found, "dt string")


@_query
def missing_periods(i: Inputs) -> DataFrame:
    """Quarters and survey years from 1990 on of which nothing was landed; all first quarters are withheld."""
    root = i.folder("raw")
    _land_financials(i, root, i.raw_financials.filter("REPDTE not like '%0331'"))
    found = landing.missing_periods(i.spark, root, "19900101", "19991231")
    return i.spark.createDataFrame(found, "dataset string, period string")


@_query
def missing_datasets(i: Inputs) -> DataFrame:
    root = i.folder("raw")
    _land_financials(i, root, i.raw_financials)
    missing = [(name,) for name in landing.missing_datasets(i.spark, root)]
    return i.spark.createDataFrame(missing, "dataset string")


@_query
def drift_read(i: Inputs) -> DataFrame:
    """Three spans of partitions whose key is a small whole number, a large one and text."""
    path = i.folder("raw")
    rows = i.raw_financials.withColumn("dt", F.col("REPDTE"))
    spans = [("dt < '19970101'", "int"), ("dt between '19970101' and '19991231'", "bigint")]
    for span, kind in [*spans, ("dt > '19991231'", "string")]:
        typed = rows.filter(span).withColumn("CERT", F.col("CERT").cast(kind))
        landing.write_recorded(typed, path)
    return drift.read_projected(i.spark, path, project_financials, fields=FINANCIALS_FIELDS).drop(BAD_CAST, BAD_VALUES)


@_query
def schema_drift(i: Inputs) -> DataFrame:
    """Branch records with one field nobody announced and one that turned into text."""
    drifted = i.raw_branches.withColumns(
        {"UNINUMBR": F.col("UNINUMBR").cast("string"), "BRAND_NEW": F.col("STALPBR")}
    )
    return drift.schema_drift(drifted, BRANCH_DICTIONARY)


@_query
def refresh_dates(i: Inputs) -> DataFrame:
    """Cleaned filings and rejects after a delivery of some dates: cleaning these again equals cleaning all.

    The delivery turns a fifth of these dates' good filings into rejects and the other way round, and
    leaves one date without any good filing."""
    folder = i.folder("lake")
    lake = Lake(i.spark, folder, Warehouse(i.spark, "unused", folder))
    _land_financials(i, folder, i.raw_financials)
    clean_all(lake, FINANCIALS_CLEANING)
    asset = F.col("ASSET")
    turned = F.when(F.col("_batch_id").cast("bigint") % 5 == 0, -asset).otherwise(asset + 1000)
    restated = i.raw_financials.filter("REPDTE between '19960331' and '19971231'").withColumn(
        "ASSET", F.when(F.col("REPDTE") == "19970630", -1 - F.abs(asset)).otherwise(turned)
    )
    _land_financials(i, folder, restated)
    clean_dates(lake, FINANCIALS_CLEANING, "19960331", "19971231")
    none = F.lit(None).cast("string").alias("_reject_reason")
    good, bad = lake.read("financials"), lake.read("financials", BAD)
    return good.select("*", none).unionByName(bad.select(*good.columns, "_reject_reason"))


@_query
def period_range(i: Inputs) -> DataFrame:
    path = _land_financials(i, i.folder("raw"), i.raw_financials)
    rows = landing.within_periods(i.spark.read.parquet(path), "19960331", "19971231")
    return rows.select("CERT", "REPDTE", "_batch_id")


def _loaded(i: Inputs, cleaned: DataFrame, schema: T.StructType, **options) -> DataFrame:
    """Loaded twice into a table and read back: the second load changes nothing. As in the refresh, what is
    loaded is a stored cleaned dataset, so that a load does not clean again."""
    folder = i.folder("warehouse")
    cleaned = _store(i, i.folder("cleaned"), "cleaned", cleaned)
    warehouse = Warehouse(i.spark, "loads_" + folder.rpartition("-")[2], folder)
    for _ in range(2):
        load_table(warehouse, "loaded", cleaned, schema, **options)
    return warehouse.table("loaded")


@_query
def load_financials(i: Inputs) -> DataFrame:
    cleaned = clean_financials(i.raw_financials)[0]
    return _loaded(i, cleaned, FINANCIALS, bucket_by="cert", sort_by=["repdte"])


@_query
def load_branches(i: Inputs) -> DataFrame:
    return _loaded(i, clean_branches(i.raw_branches)[0], BRANCHES)


@_query
def load_history(i: Inputs) -> DataFrame:
    return _loaded(i, i.history_text, HISTORY, day_format="yyyy-MM-dd")


@_query
def replay_messages(i: Inputs) -> DataFrame:
    """Filings as keyed JSON messages, decoded again."""
    raw = i.raw_financials
    sent = messages.filing_messages(raw, F.col("REPDTE"))
    fields = stream.payload_schema()
    decoded = sent.select("key", F.from_json("value", fields).alias("v"))
    return decoded.select("key", *(f"v.{f.name}" for f in fields.fields if f.name != "_corrupt"))


def _mixed_keys(i: Inputs) -> str:
    """A raw dataset whose key is a whole number before 1998 and text from then on."""
    path = i.folder("raw")
    rows = i.raw_financials.withColumn("dt", F.col("REPDTE"))
    landing.write_recorded(rows.filter("dt < '19980101'"), path)
    text = rows.filter("dt >= '19980101'").withColumn("CERT", F.col("CERT").cast("string"))
    landing.write_recorded(text, path)
    return path


@_query
def replay_partition(i: Inputs) -> DataFrame:
    """Every partition replayed and landed again: whole and text keys come out the same."""
    path = _mixed_keys(i)
    sent = messages.replay_partitions(i.spark, path)
    received = sent.withColumns({"partition": F.lit(0), "offset": F.lit(0).cast("bigint")})
    landed = stream.parse_messages(received).filter("_reject_reason is null")
    return landed.select(F.col("_kafka_key").alias("key"), "CERT", "REPDTE", "ASSET", "ROA", "_batch_id", DT_MARKER)


@_query
def replay_quarantine(i: Inputs) -> DataFrame:
    """The filings of all partitions that have no key to be sent by."""
    path, root = _mixed_keys(i), i.folder("replay")
    messages.quarantine_keyless_partitions(i.spark, path, root)
    rows = i.spark.read.parquet(messages.keyless_path(root))
    return rows.select("REPDTE", "_batch_id", "_reject_reason", F.col("dt").cast("string").alias("dt"))


# ---- projection, dedupe, quarantine --------------------------------------------------------------


@_query
def project_financials_(i: Inputs) -> DataFrame:
    return project_financials(i.raw_financials).drop(BAD_CAST, BAD_VALUES)


@_query
def project_branches_(i: Inputs) -> DataFrame:
    return project_branches(i.raw_branches).drop(BAD_CAST, BAD_VALUES)


@_query
def project_snapshots(i: Inputs) -> DataFrame:
    return i.snapshots


@_query
def stg_financials(i: Inputs) -> DataFrame:
    return models.stage_financials(i.financials)


@_query
def stg_branches(i: Inputs) -> DataFrame:
    return models.stage_branches(i.branches)


@_query
def stg_history(i: Inputs) -> DataFrame:
    return models.stage_history(i.history)


@_query
def dedupe_financials(i: Inputs) -> DataFrame:
    return latest_per_key(project_financials(i.raw_financials).drop(BAD_CAST, BAD_VALUES), FINANCIALS_KEY)


@_query
def dedupe_branches(i: Inputs) -> DataFrame:
    return latest_per_key(project_branches(i.raw_branches).drop(BAD_CAST, BAD_VALUES), BRANCH_KEY)


@_query
def quarantine_financials(i: Inputs) -> DataFrame:
    return clean_financials(i.raw_financials)[1].drop(BAD_VALUES)


@_query
def quarantine_branches(i: Inputs) -> DataFrame:
    return clean_branches(i.raw_branches)[1].drop(BAD_VALUES)


@_query
def quarantine_all_rejects(i: Inputs) -> DataFrame:
    return clean_financials(i.raw_financials, keep_all_rejects=True)[1].drop(BAD_VALUES)


def _raw_with_bad_casts(i: Inputs) -> DataFrame:
    """Keys as text: every 89th order has letters in it, every 83rd a fraction, whole ones a `.0`."""
    key, order = F.col("CERT").cast("string"), F.col("_batch_id").cast("bigint")
    text = F.when(order % 89 == 0, F.concat(F.lit("x"), key)).when(order % 83 == 0, F.concat(key, F.lit(".5")))
    return i.raw_financials.withColumn("CERT", F.coalesce(text, F.concat(key, F.lit(".0"))))


@_query
def quarantine_bad_cast(i: Inputs) -> DataFrame:
    """Every key that does not cast is a reject of its own, with the key as it came."""
    rejects = clean_financials(_raw_with_bad_casts(i))[1].filter("_reject_reason = 'bad_cast'")
    return rejects.select("repdte", "_batch_id", F.get_json_object(BAD_VALUES, "$.cert").alias("raw_cert"), "cert")


@_query
def clean_text_keys(i: Inputs) -> DataFrame:
    return clean_financials(_raw_with_bad_casts(i))[0]


@_query
def quarantine_snapshots(i: Inputs) -> DataFrame:
    """Snapshots with letters or a fraction in the key, without a key, and with a day that is none."""
    order = F.col("_batch_id").cast("bigint")
    key = F.col("CERT").cast("string")
    raw = i.raw_institutions.withColumns(
        {
            "CERT": F.when(order % 89 == 0, F.concat(F.lit("x"), key)).when(order % 83 == 0, F.concat(key, F.lit(".5"))).when(order % 79 != 0, key),
            "dt": F.when(order % 73 == 0, "20231399").when(order % 71 != 0, F.date_format("SNAPSHOT_DATE", "yyyyMMdd")),
        }
    )
    found = rejected_snapshots(projection.project_snapshots(raw))
    values = [F.get_json_object(BAD_VALUES, f"$.{c}").alias(f"raw_{c}") for c in ("cert", "snapshot_date")]
    return found.select("_batch_id", "cert", "snapshot_date", "_reject_reason", *values)


@_query
def clean_financials_(i: Inputs) -> DataFrame:
    return clean_financials(i.raw_financials)[0]


@_query
def clean_branches_(i: Inputs) -> DataFrame:
    return clean_branches(i.raw_branches)[0]


@_query
def clean_with_stream(i: Inputs) -> DataFrame:
    """Every filing delivered again through the topic changes nothing."""
    batch = project_financials(i.raw_financials)
    sent = messages.filing_messages(i.raw_financials, F.col("REPDTE"))
    received = sent.withColumns({"partition": F.lit(0), "offset": F.lit(0).cast("bigint")})
    copies = project_financials(stream.parse_messages(received))
    merged = latest_per_key(batch.unionByName(copies), FINANCIALS_KEY)
    return quarantine_split(merged, FINANCIALS_KEY, ["asset"])[0]


@_query
def restatement(i: Inputs) -> DataFrame:
    """Amended filings delivered later win over their originals."""
    amended = i.raw_financials.filter("BKCLASS = 'BUILDING'").withColumns(
        {"ASSET": F.col("ASSET") + 50000, "_ingested_at": F.lit("2100-01-01")}
    )
    return clean_financials(i.raw_financials.unionByName(amended))[0]


# ---- history, facts, marts -----------------------------------------------------------------------


@_query
def scd2_history(i: Inputs) -> DataFrame:
    return i.history_text


@_query
def history_spliced(i: Inputs) -> DataFrame:
    """A history of snapshots of which the first, a middle and the last day were late, wrong or too many,
    spliced by a delivery of these days: it equals the one built anew."""
    days = [date(1992, 3, 31), date(1995, 6, 30), date(1995, 9, 30), date(1998, 9, 30)]
    day, cert = F.col("snapshot_date"), F.col("cert")
    wrong = i.snapshots.withColumn("name", F.when(day.isin(days) & (cert % 3 == 0), "wrong").otherwise(F.col("name")))
    before = wrong.filter(~(day.isin(days) & (cert % 5 == 0)))
    extra = wrong.filter((cert % 7 == 0) & (F.quarter(day) == 1)).withColumn("snapshot_date", F.lit(days[1]))
    store = partial(_store, i, i.folder("splice"))
    points = store("points", splice.daily_points(before.unionByName(extra)))
    windows = store("history", build_history(before.unionByName(extra)))
    delivered = store("delivered", splice.daily_points(i.snapshots.filter(day.isin(days))))
    wanted = i.spark.createDataFrame([(d,) for d in days], "snapshot_date date")
    return splice.splice_history(windows, points, delivered, wanted)


@_query
def dim_institution(i: Inputs) -> DataFrame:
    return i.dim


@_query
def dim_date(i: Inputs) -> DataFrame:
    return models.dim_date(i.financials)


@_query
def fct_financials(i: Inputs) -> DataFrame:
    return i.fact


@_query
def fct_financials_swept(i: Inputs) -> DataFrame:
    return models.fct_financials(models.stage_financials(i.financials), i.dim, sweep_as_of)


@_query
def mart_latest_financials(i: Inputs) -> DataFrame:
    return marts.latest_financials(i.fact)


@_query
def mart_profitability_trends(i: Inputs) -> DataFrame:
    return marts.profitability_trends(i.fact)


@_query
def mart_asset_growth(i: Inputs) -> DataFrame:
    return marts.asset_growth(i.fact)


_DELIVERED = [date(1995, 6, 30), date(1997, 3, 31)]


def _undelivered(i: Inputs, fact: DataFrame, amount: str) -> DataFrame:
    """The facts before a delivery of two dates: of these, a third of the amounts are others, a fifth of the
    institutions are missing, and some have a report they should not have."""
    cert, on_days = F.col("cert"), F.col("repdte").isin(*_DELIVERED)
    changed = fact.withColumn(amount, F.when(on_days & (cert % 3 == 0), F.col(amount) + 1000).otherwise(F.col(amount)))
    before = changed.filter(~(on_days & (cert % 5 == 0)))
    reports = before.filter(on_days).select("cert", "repdte").distinct()
    extra = before.filter((cert % 7 == 1) & (F.col("repdte") == date(1996, 3, 31))).withColumn("repdte", F.lit(_DELIVERED[1]))
    return before.unionByName(extra.join(reports, ["cert", "repdte"], "left_anti"))


def _updated(i: Inputs, name: str) -> DataFrame:
    """A mart of facts before a delivery, brought up to date."""
    store = partial(_store, i, i.folder("updated"))
    after = store("after", i.fact)
    before = store("before", _undelivered(i, after, "asset"))
    mart = store("mart", getattr(marts, name)(before))
    return getattr(propagate, name)(mart, before, after, _DELIVERED)


@_query
def mart_latest_updated(i: Inputs) -> DataFrame:
    return _updated(i, "latest_financials")


@_query
def mart_trends_updated(i: Inputs) -> DataFrame:
    return _updated(i, "profitability_trends")


@_query
def mart_growth_updated(i: Inputs) -> DataFrame:
    return _updated(i, "asset_growth")


# Sums of doubles depend on their order in the last digits, so those queries round.


@_query
def bank_state_deposits(i: Inputs) -> DataFrame:
    return marts.bank_state_deposits(i.branches).withColumn(
        "total_deposits", F.round("total_deposits", 2)
    )


@_query
def state_totals(i: Inputs) -> DataFrame:
    return marts.state_totals(marts.bank_state_deposits(i.branches)).withColumn(
        "state_total_deposits", F.round("state_total_deposits", 2)
    )


@_query
def mart_deposit_concentration(i: Inputs) -> DataFrame:
    return marts.deposit_concentration(i.branches).withColumns(
        {
            "total_deposits": F.round("total_deposits", 2),
            "deposit_share": F.round("deposit_share", 8),
            "state_hhi": F.round("state_hhi", 4),
        }
    )


@_query
def mart_concentration_updated(i: Inputs) -> DataFrame:
    """Shares and indexes after a delivery of one survey year, brought up to date by state."""
    store = partial(_store, i, i.folder("updated"))
    year, on_year = date(1995, 6, 30), F.col("repdte") == date(1995, 6, 30)
    after = store("after", i.branches)
    wrong = F.when(on_year & (F.col("stalpbr") == "CHINA"), F.col("depsumbr") + 5000).otherwise(F.col("depsumbr"))
    before = store("before", after.withColumn("depsumbr", wrong).filter(~on_year | (F.col("cert") % 4 != 0)))
    mart = store("mart", marts.deposit_concentration(before))
    return propagate.deposit_concentration(mart, before, after, [year]).withColumns(
        {
            "total_deposits": F.round("total_deposits", 2),
            "deposit_share": F.round("deposit_share", 8),
            "state_hhi": F.round("state_hhi", 4),
        }
    )


# ---- serving -------------------------------------------------------------------------------------


def _list(i: Inputs, **arguments) -> DataFrame:
    return serving.list_institutions(i.dim, marts.latest_financials(i.fact), **arguments)


@_query
def list_institutions(i: Inputs) -> DataFrame:
    return _list(i)


@_query
def list_institutions_filtered(i: Inputs) -> DataFrame:
    return _list(i, state="NATION_3", bkclass="BUILDING", min_asset=50000.0, max_asset=400000.0)


@_query
def page_institutions(i: Inputs) -> DataFrame:
    return _list(i, limit=20, offset=40)


@_query
def page_institutions_after(i: Inputs) -> DataFrame:
    """The page behind an institution, asked for by its key."""
    return _list(i, limit=20, after=75)


@_query
def page_financials_after(i: Inputs) -> DataFrame:
    return serving.institution_financials(i.fact, 7, date_to=date(1999, 12, 31), limit=5, after=date(1994, 6, 30))


@_query
def get_institution(i: Inputs) -> DataFrame:
    return serving.get_institution(i.dim, i.fact, 7)


@_query
def institution_financials(i: Inputs) -> DataFrame:
    return serving.institution_financials(
        i.fact, 7, date_from=date(1995, 6, 30), date_to=date(1999, 12, 31), limit=10
    )


_MARTS = {
    "mart_profitability_trends": marts.profitability_trends,
    "mart_asset_growth": marts.asset_growth_unranked,
}


def _rankings(metric: str, **arguments) -> Callable[[Inputs], DataFrame]:
    def build(i: Inputs) -> DataFrame:
        # The last report date is that of the cleaned filings; the mart need not be scanned for it.
        latest = i.financials.select(F.max("repdte"))
        mart = _MARTS[METRICS[metric][0]](i.fact)
        return serving.rankings(mart, i.dim, metric, latest=latest, **arguments)

    return build


for _metric in METRICS:
    _add(f"rankings_{_metric}", _rankings(_metric))
_add("rankings_state", _rankings("roe", state="NATION_3", period=date(1996, 3, 31)))
_add("rankings_period", _rankings("asset_growth_qoq", period=date(1997, 6, 30), limit=30, offset=20))


@_query
def rankings_deep(i: Inputs) -> DataFrame:
    """A page near the end of a ranking of all reports of all dates."""
    reports = i.fact.select((F.col("cert") * 1_000_000 + F.datediff("repdte", F.lit("1990-01-01"))).alias("report"), "roa")
    return ranking.ranked_page(reports, "roa", "report", 40, DEEP_OFFSET, most_kept=0)


@_query
def health(i: Inputs) -> DataFrame:
    return serving.health(freshness(i.fact, PUBLISHED_AT))


@_query
def health_published(i: Inputs) -> DataFrame:
    """Of the freshness table as it was published."""
    folder = i.folder("warehouse")
    warehouse = Warehouse(i.spark, "published_" + folder.rpartition("-")[2], folder)
    staged = warehouse.begin()
    staged.replace("fact", i.fact)
    publish_freshness(staged, "fact", PUBLISHED_AT)
    warehouse.publish(staged)
    return serving.health(warehouse.table(FRESHNESS_TABLE))


@_query
def freshness_(i: Inputs) -> DataFrame:
    return freshness(i.fact, PUBLISHED_AT)


# ---- streaming -----------------------------------------------------------------------------------


def _landed(i: Inputs) -> str:
    """Write the messages as files and land them with a streaming query; the root of the result."""
    root = i.folder("stream")
    files = max(4, i.spark.sparkContext.defaultParallelism)
    i.messages.repartition(files, "offset").write.json(f"{root}/topic")
    source = stream.file_messages(i.spark, f"{root}/topic", files_per_trigger=files // 4)
    stream.start_landing(source, root, f"{root}/checkpoint").awaitTermination()
    return root


def _landed_rows(i: Inputs) -> DataFrame:
    rows = i.spark.read.parquet(f"{_landed(i)}/raw/{stream.STREAM_DATASET}")
    return rows.withColumn("dt", F.col("dt").cast("string"))


@_query
def stream_landed(i: Inputs) -> DataFrame:
    return _landed_rows(i).select(
        "CERT", "REPDTE", "ASSET", "_ingested_at", "_batch_id", "_source_url", "dt",
        "_kafka_topic", "_kafka_partition", "_kafka_offset",
    )


@_query
def stream_mixed_types(i: Inputs) -> DataFrame:
    """Numbers as text, keys as 12.0, and every 41st key with letters in it."""
    key, event = F.col("user_id"), F.col("event_id")
    text = F.when(event % 41 == 0, F.concat(F.lit("x"), key)).when(event % 3 == 0, F.concat(key, F.lit(".0")))
    day = F.date_format("ts", "yyyyMMdd")
    payload = F.struct(
        F.coalesce(text, key.cast("string")).alias("CERT"),
        day.alias("REPDTE"),
        F.col("value").cast("string").alias("ASSET"),
        day.alias(DT_MARKER),
    )
    sent = i.table("events").select(
        key.cast("string").alias("key"),
        F.to_json(payload).alias("value"),
        (key % 4).cast("int").alias("partition"),
        event.alias("offset"),
    )
    root = i.folder("stream")
    sent.write.json(f"{root}/topic")
    source = stream.file_messages(i.spark, f"{root}/topic", files_per_trigger=1000)
    stream.start_landing(source, root, f"{root}/checkpoint").awaitTermination()
    landed = i.spark.read.parquet(f"{root}/raw/{stream.STREAM_DATASET}")
    lost = i.spark.read.parquet(f"{root}/quarantine/{stream.STREAM_DATASET}")
    columns = ["CERT", "REPDTE", "ASSET", "_kafka_offset"]
    none = F.lit(None).cast("string").alias("_reject_reason")
    return landed.select(*columns, none).unionByName(lost.select(*columns, "_reject_reason"))


@_query
def stream_counts(i: Inputs) -> DataFrame:
    """The counts that the batches of a landing left behind, added up."""
    found = counts.batch_counts(i.spark, _landed(i), stream.STREAM_DATASET)
    return found.agg(F.sum("landed").alias("landed"), F.sum("quarantined").alias("quarantined"))


@_query
def stream_quarantine(i: Inputs) -> DataFrame:
    rows = i.spark.read.parquet(f"{_landed(i)}/quarantine/{stream.STREAM_DATASET}")
    return rows.select("_kafka_key", "_kafka_partition", "_kafka_offset", "_reject_reason")


@_query
def stream_deduped(i: Inputs) -> DataFrame:
    return latest_per_key(_landed_rows(i), ["CERT", "REPDTE"]).select(
        "CERT", "REPDTE", "ASSET", "_ingested_at", "_batch_id"
    )


@_query
def stream_groups(i: Inputs) -> DataFrame:
    return stream.landed_groups(_landed_rows(i))


@_query
def stream_manifest(i: Inputs) -> DataFrame:
    """Flush ranges joined up per report date and source partition."""
    return (
        stream.flush_manifest(_landed_rows(i))
        .groupBy("dt", "source_partition")
        .agg(
            F.min("first_offset").alias("first_offset"),
            F.max("last_offset").alias("last_offset"),
            F.sum("rows").alias("rows"),
        )
    )


@_query
def stream_labels(i: Inputs) -> DataFrame:
    """Range labels of all messages landed as one batch."""
    root = i.folder("stream")
    stream.land_batch(i.messages, root, "batch-1")
    rows = i.spark.read.parquet(f"{root}/raw/{stream.STREAM_DATASET}")
    found = stream.flush_manifest(rows.withColumn("dt", F.col("dt").cast("string")))
    return found.select("dt", "source_partition", "batch", "label", "rows")


# ---- data quality: the checks on data that violates them -----------------------------------------


@_query
def dq_not_null(i: Inputs) -> DataFrame:
    raw = project_financials(i.raw_financials)
    return quality.null_rows(raw, ["cert", "repdte"]).select("cert", "repdte", "_batch_id")


@_query
def dq_unique(i: Inputs) -> DataFrame:
    return quality.repeated_keys(project_financials(i.raw_financials), FINANCIALS_KEY)


@_query
def dq_unique_branches(i: Inputs) -> DataFrame:
    return quality.repeated_keys(project_branches(i.raw_branches), BRANCH_KEY)


@_query
def dq_fct_unique(i: Inputs) -> DataFrame:
    return quality.repeated_keys(i.fact, ["cert", "repdte"])


@_query
def dq_fct_unique_planted(i: Inputs) -> DataFrame:
    """Facts of which every seventh institution's are delivered twice."""
    again = i.fact.filter(F.col("cert") % 7 == 0)
    return quality.repeated_keys(i.fact.unionByName(again), ["cert", "repdte"])


@_query
def dq_overlap_planted(i: Inputs) -> DataFrame:
    """A history whose closed versions end ten days late."""
    late = F.when(F.col("is_current"), F.col("valid_to")).otherwise(F.date_add("valid_to", 10))
    return quality.overlapping_windows(i.dim.withColumn("valid_to", late), touching=True)


@_query
def dq_accepted(i: Inputs) -> DataFrame:
    return quality.unaccepted_values(i.dim, "bkclass", (*BANK_CLASSES, "BUILDING", "MACHINERY"))


@_query
def dq_relationships(i: Inputs) -> DataFrame:
    known = i.dim.filter(F.col("institution_sk") != UNKNOWN_SK)
    return quality.orphan_keys(i.fact, "institution_sk", known, "institution_sk")


@_query
def dq_overlap(i: Inputs) -> DataFrame:
    """Windows of 100 days from each quarterly snapshot, so consecutive quarters overlap."""
    daily = latest_per_key(i.snapshots, ["cert", "snapshot_date"])
    windows = daily.select(
        "cert",
        F.col("snapshot_date").alias("valid_from"),
        F.date_add("snapshot_date", 100).alias("valid_to"),
    )
    return quality.overlapping_windows(windows)


@_query
def dq_overlap_history(i: Inputs) -> DataFrame:
    return quality.overlapping_windows(i.dim, touching=True)


@_query
def dq_rerun(i: Inputs) -> DataFrame:
    """A rerun over the same filings in another arrival order, and one amended quarter."""
    before = clean_financials(i.raw_financials)[0]
    again = i.raw_financials.repartition("_batch_id").withColumn(
        "ASSET", F.when(F.col("REPDTE") == "19970630", F.col("ASSET") + 1).otherwise(F.col("ASSET"))
    )
    after = clean_financials(again)[0]
    changed = quality.changed_rows(before, after)
    return changed.select("change", "cert", "repdte", "asset", "_batch_id", "copies")


@_query
def dq_rerun_by_day(i: Inputs) -> DataFrame:
    """The same reruns, of which only the quarters with unequal fingerprints are compared."""
    store = partial(_store, i, i.folder("rerun"))
    before = store("before", clean_financials(i.raw_financials)[0])
    amended = F.when(F.col("REPDTE") == "19970630", F.col("ASSET") + 1).otherwise(F.col("ASSET"))
    after = store("after", clean_financials(i.raw_financials.withColumn("ASSET", amended))[0])
    changed = quality.changed_rows_by_day(before, after, "repdte")
    return changed.select("change", "cert", "repdte", "asset", "_batch_id", "copies")


def _store(i: Inputs, folder: str, name: str, df: DataFrame) -> DataFrame:
    """Write a table that is read more than once, as the refresh does, and read it back."""
    df.write.parquet(f"{folder}/{name}")
    return i.spark.read.parquet(f"{folder}/{name}")


@_query
def dq_report(i: Inputs) -> DataFrame:
    """All declared checks over stored tables, each table built once from those below it."""
    store = partial(_store, i, i.folder("models"))
    tables = {
        "stg_institution_history": store("history", models.stage_history(i.history)),
        "stg_financials": store("financials", models.stage_financials(i.financials)),
        "stg_branch_deposits": store("branches", models.stage_branches(i.branches)),
    }
    dim = store("dim", models.dim_institution(tables["stg_institution_history"]))
    fact = store("fact", models.fct_financials(tables["stg_financials"], dim))
    tables |= {
        "dim_institution": dim,
        "dim_date": models.dim_date(tables["stg_financials"]),
        "fct_bank_quarterly_financials": fact,
        "mart_latest_financials": marts.latest_financials(fact),
        "mart_profitability_trends": marts.profitability_trends(fact),
        "mart_asset_growth": marts.asset_growth(fact),
        "mart_deposit_concentration": marts.deposit_concentration(tables["stg_branch_deposits"]),
    }
    return quality.check_report(tables)
