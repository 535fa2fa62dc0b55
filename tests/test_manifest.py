"""Commits of a conformed dataset: side changes, emptied dates, readers in flight, gates, two writers."""

import datetime as dt

import pytest

from filingmill.plans import refresh as plan
from filingmill.plans.quality import Accepted, changed_rows
from filingmill.plans.refresh import BAD, FINANCIALS_CLEANING, ChecksFailedError, clean_dates, refresh, refresh_dates
from filingmill.sources.landing import land
from filingmill.sources.manifest import ConflictError, Manifest, within
from tests.test_refresh import FILING, PUBLISHED, QUARTERS, fill, filing, make_lake

FAILING = (Accepted("stg_financials", "bkclass", ("nothing",)),)


def deliver(spark, lake, rows, when):
    frame = spark.createDataFrame(rows, FILING)
    land(frame, lake.root, "financials", frame.REPDTE, source_url="u", batch_id=when, ingested_at=when)


def sides(lake):
    return {
        outcome: sorted((r.cert or 0, r.repdte, r.asset) for r in lake.read("financials", outcome).collect())
        for outcome in ("cleaned", BAD)
    }


@pytest.fixture()
def lake(spark, tmp_path):
    lake = make_lake(spark, tmp_path, "m" + tmp_path.name.replace("-", "_"))
    fill(spark, lake.root)
    refresh(lake, published_at=PUBLISHED)
    return lake


def test_rows_change_sides_both_ways_and_dates_empty(lake, spark):
    before = sides(lake)
    assert (5, QUARTERS[0], -1.0) in before[BAD]
    good = [r for r in before["cleaned"] if r[1] > QUARTERS[1]]
    # The first quarter's reject is mended and a good filing spoiled; the second quarter keeps rejects only.
    first = [filing(1, QUARTERS[0], -5.0), filing(5, QUARTERS[0], 8.0)]
    deliver(spark, lake, [*first, filing(2, QUARTERS[1], -7.0)], "2025-03-01")
    counts = clean_dates(lake, FINANCIALS_CLEANING, QUARTERS[0], QUARTERS[1])
    assert counts == {"cleaned": 1, "quarantine": 2}
    partly = sides(lake)
    assert partly["cleaned"] == sorted([(5, QUARTERS[0], 8.0), *good])
    assert partly[BAD] == [(1, QUARTERS[0], -5.0), (2, QUARTERS[1], -7.0)]
    plan.clean_financials(lake)
    assert sides(lake) == partly


def test_a_date_without_raw_rows_is_emptied(lake, spark):
    from filingmill.sources.landing import _file_system

    path, fs = _file_system(spark, f"{lake.raw('financials')}/dt={QUARTERS[3]}")
    fs.delete(path, True)
    assert clean_dates(lake, FINANCIALS_CLEANING, QUARTERS[3], QUARTERS[3]) == {"cleaned": 0, "quarantine": 0}
    assert {r[1] for r in sides(lake)["cleaned"]} == set(QUARTERS[:3])


def test_a_reader_in_flight_keeps_its_files(lake, spark):
    reading = lake.read("financials")
    deliver(spark, lake, [filing(1, QUARTERS[2], 1234.0)], "2025-03-01")
    clean_dates(lake, FINANCIALS_CLEANING, QUARTERS[2], QUARTERS[2])
    assert reading.filter("asset = 1234").count() == 0 and reading.count() == 20
    assert lake.read("financials").filter(f"repdte = '{QUARTERS[2]}'").count() == 1
    commits = lake.manifest("financials").numbers()
    assert lake.read("financials", commit=lake.manifest("financials").commit_of(commits[0])).count() == 20


@pytest.mark.parametrize("partly", [False, True])
def test_a_failing_gate_leaves_cleaned_data_as_it_was(lake, spark, partly):
    before, number = sides(lake), lake.manifest("financials").numbers()
    history = lake.history().count()
    deliver(spark, lake, [filing(1, QUARTERS[3], 7.0)], "2025-03-01")

    with pytest.raises(ChecksFailedError):
        plan._refresh(lake, (QUARTERS[3], QUARTERS[3]) if partly else None, FAILING, PUBLISHED)
    assert sides(lake) == before and lake.manifest("financials").numbers() == number
    assert lake.history().count() == history
    refresh_dates(lake, QUARTERS[3], QUARTERS[3], published_at=PUBLISHED)
    assert (1, QUARTERS[3], 7.0) in sides(lake)["cleaned"]


def test_two_writers_of_different_dates_both_count(lake, spark):
    deliver(spark, lake, [filing(1, QUARTERS[0], 11.0), filing(1, QUARTERS[1], 22.0)], "2025-03-01")
    manifest = lake.manifest("financials")
    one, _ = plan.stage_cleaned(lake, FINANCIALS_CLEANING, (QUARTERS[0], QUARTERS[0]))
    two, _ = plan.stage_cleaned(lake, FINANCIALS_CLEANING, (QUARTERS[1], QUARTERS[1]))
    late, _ = plan.stage_cleaned(lake, FINANCIALS_CLEANING, (QUARTERS[1], QUARTERS[2]))
    whole, _ = plan.stage_cleaned(lake, FINANCIALS_CLEANING)
    assert manifest.commit(one).number + 1 == manifest.commit(two).number
    found = sides(lake)["cleaned"]
    assert (1, QUARTERS[0], 11.0) in found and (1, QUARTERS[1], 22.0) in found
    for staged in (late, whole):
        with pytest.raises(ConflictError):
            manifest.commit(staged)
    assert sides(lake)["cleaned"] == found


def test_partial_refresh_equals_a_whole_one(lake, spark):
    deliver(spark, lake, [filing(c, QUARTERS[1], -c + 2.5) for c in (1, 2, 3, 4)], "2025-03-01")
    refresh_dates(lake, QUARTERS[1], QUARTERS[1], published_at=PUBLISHED)
    names = ["fct_bank_quarterly_financials", "mart_asset_growth", "mart_latest_financials"]
    for name in names:
        lake.warehouse.table(name).write.parquet(f"{lake.root}/partly/{name}")
    refresh(lake, published_at=dt.datetime(2026, 2, 1, tzinfo=dt.UTC))
    for name in names:
        assert changed_rows(spark.read.parquet(f"{lake.root}/partly/{name}"), lake.warehouse.table(name)).count() == 0


def test_pruning_keeps_what_commits_name(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"))
    for k, dates in enumerate([None, ("2", "2"), ("3", "3"), ("2", "3")]):
        rows = spark.createDataFrame([(k, d) for d in "1234" if dates is None or dates[0] <= d <= dates[1]], "x int, dt string")
        staged = manifest.stage(lambda p, rows=rows: rows.write.partitionBy("dt").parquet(p), rows.schema, dates)
        manifest.commit(staged)
        manifest.prune()
    assert len(manifest.numbers()) == 2 and len(manifest.versions()) == 4  # two dates are still in the first
    assert sorted(r.x for r in manifest.read(manifest.current()).collect()) == [0, 0, 3, 3]
    assert manifest.read(manifest.current(), "dt=9").columns == ["x"]
    rows = spark.createDataFrame([(9, "1")], "x int, dt string")
    for _ in range(2):
        manifest.commit(manifest.stage(lambda p: rows.write.partitionBy("dt").parquet(p), rows.schema))
        manifest.prune()
    assert len(manifest.versions()) == 2
    assert not within("dt=__HIVE_DEFAULT_PARTITION__", ("0", "9")) and within("dt=__HIVE_DEFAULT_PARTITION__", None)
