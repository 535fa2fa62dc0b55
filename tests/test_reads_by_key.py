"""Pages by the last key, as-of by one sweep, fingerprints by day, freshness from footers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from filingmill.operators.asof import join_as_of, sweep_as_of
from filingmill.plans.quality import changed_rows, changed_rows_by_day, fingerprints
from filingmill.plans.serving import Reads, list_institutions
from filingmill.sources import warehouse as tables
from filingmill.sources.warehouse import Warehouse
from tests.test_refresh import PUBLISHED, fill, make_lake

DAY = dt.date(2024, 1, 1)
VERSION = "cert long, valid_from date, valid_to date, name string"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    from filingmill.plans.refresh import refresh

    lake = make_lake(spark, tmp_path_factory.mktemp("by_key"), "by_key")
    fill(spark, lake.root)
    refresh(lake, published_at=PUBLISHED)
    return lake


def test_pages_by_key_joined_are_the_whole_list(lake):
    reads = Reads(lake.warehouse)
    for arguments in ({}, {"min_asset": 150.0}, {"state": "va"}):
        whole, joined, after = reads.institutions(**arguments).items, [], None
        while True:
            page = reads.institutions(limit=1, after=after, **arguments)
            joined += page.items
            after = page.after
            if not page.has_more:
                break
        assert joined == whole and after is None
    page = reads.financials(2, limit=3)
    rest = reads.financials(2, limit=3, after=page.after)
    assert [r.repdte for r in page.items + rest.items] == [r.repdte for r in reads.financials(2).items]


def test_a_deep_page_reads_only_the_files_from_its_key_on(spark, tmp_path):
    warehouse = Warehouse(spark, "by_range", str(tmp_path))
    rows = spark.range(20_000).select(
        (F.col("id") * 7 % 20_000).alias("cert"), F.lit("sk").alias("institution_sk"), F.lit(True).alias("is_current"),
        *(F.lit(None).cast("string").alias(c) for c in ("name", "city", "state", "bkclass", "regagnt", "holding_company")),
        F.lit(DAY).alias("valid_from"),
    )
    latest = spark.createDataFrame([], "cert long, latest_repdte date, latest_asset double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        warehouse.replace("dim", rows, sort_by=["cert"], range_by="cert")
        page = list_institutions(warehouse.table("dim"), latest, limit=10, after=19_000)
        assert [r.cert for r in page.collect()] == list(range(19_001, 19_012))
        plan = page._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")

    def nodes(plan):
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from nodes(children.apply(i))

    read = [n.metrics().apply("numOutputRows").value() for n in nodes(plan) if n.nodeName().startswith("Scan parquet")]
    assert len(read) == 1 and 1000 <= read[0] <= 20_000 / 4 * 1.5  # one of four files


def brute_force(spark, facts, versions):
    take = {"name": "_name"}
    return join_as_of(facts, versions, "cert", "day", take)


def test_a_sweep_equals_the_join(spark):
    rng = random.Random(0)
    versions, facts = [], []
    for cert in range(30):
        at = rng.randrange(-40, 20)
        for k in range(rng.randrange(6)):
            end = at + rng.randrange(0, 30)
            versions.append((cert, DAY + dt.timedelta(at), DAY + dt.timedelta(end), f"{cert}-{k}"))
            at = end + rng.choice([1, 1, 5])  # gaps
        facts += [(cert, DAY + dt.timedelta(rng.randrange(-50, 120)), i) for i in range(rng.randrange(12))]
    facts += [(None, DAY, 1), (3, None, 2), (99, DAY, 3), (5, DAY, 4), (5, DAY, 4)]
    f = spark.createDataFrame(facts, "cert long, day date, x int")
    v = spark.createDataFrame([*versions, (None, DAY, DAY, "none"), (4, None, DAY, "open")], VERSION)
    found = sweep_as_of(f, v, "cert", "day", {"name": "_name"})
    assert changed_rows(brute_force(spark, f, v), found).collect() == []
    assert sweep_as_of(f, v.limit(0), "cert", "day", {"name": "_name"}).filter("_name is null").count() == len(facts)


def test_a_hot_institution_with_many_versions_costs_a_sort(spark):
    """10,000 versions and as many facts: nothing is compared pair by pair."""
    v = spark.range(10_000).select(F.lit(1).cast("long").alias("cert"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("valid_from"), F.col("id").cast("string").alias("name"))
    v = v.select("cert", "valid_from", F.col("valid_from").alias("valid_to"), "name")
    f = v.select("cert", F.col("valid_from").alias("day"), F.col("name").alias("expected"))
    found = sweep_as_of(f, v, "cert", "day", {"name": "_name"})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Window [") == 1
    assert found.filter("_name = expected").count() == 10_000


def test_only_days_that_differ_are_compared(spark, tmp_path):
    rows = [(d, c, float(c)) for d in range(6) for c in range(20)] + [(None, 1, 1.0), (3, 5, 5.0)]
    late = [(d, c, x + (d == 2 and c == 4)) for d, c, x in rows if not (d == 5 and c == 0)]
    schema = "day int, cert int, x double"
    for name, some in (("a", rows), ("b", late)):
        spark.createDataFrame(some, schema).write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / name)) for name in "ab")
    found = changed_rows_by_day(a, b, "day")
    assert changed_rows(found, changed_rows(a, b)).count() == 0
    assert "day" in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.day for r in found.collect()} == {2, 5}
    assert changed_rows_by_day(a, a, "day").count() == changed_rows_by_day(a.limit(0), b.limit(0), "day").count() == 0
    gone = changed_rows_by_day(a, b.filter("day is not null and day <> 3"), "day")
    assert changed_rows(gone, changed_rows(a, b.filter("day is not null and day <> 3"))).count() == 0
    # Copies count: a row twice is not the row once.
    assert fingerprints(a, "day").exceptAll(fingerprints(a.distinct(), "day")).count() == 1


def test_freshness_is_read_from_footers(lake, spark):
    warehouse, fact = lake.warehouse, "fct_bank_quarterly_financials"
    version = warehouse.versions.current()
    path = f"{warehouse.versions.path(version)}/{fact}"
    found = tables.in_footers(spark, path)
    assert (found.max_repdte, found.financials_row_count) == (dt.date(2024, 12, 31), 20)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    for key, value in tables._FROM_FOOTERS.items():
        spark.conf.set(key, value)
    try:
        plan = tables._in_footers(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", before)
        spark.conf.unset("spark.sql.parquet.aggregatePushdown")
    assert "PushedAggregation: [MAX(repdte), COUNT(*)]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert tables.in_footers(spark, path) == found and spark.conf.get("spark.sql.sources.useV1SourceList") == before
