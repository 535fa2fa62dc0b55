"""Typed loads, staging, dates, freshness, session settings."""

import datetime as dt

import pytest

from filingmill.operators.dedupe import latest_per_key
from filingmill.plans import catalog
from filingmill.plans.inputs import Inputs
from filingmill import session
from filingmill.plans.models import dim_date, dim_institution, stage_financials, unknown_member
from filingmill.schemas import BRANCHES, FINANCIALS, FRESHNESS, HISTORY, columns_of
from filingmill.sources.warehouse import freshness, typed

FILED = (1, "20240331", "n", "VA", "Virginia", "N", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)


def filed(spark, *stamps):
    text = columns_of(
        "cert bigint, repdte string, name string, stalp string, stname string, bkclass string, "
        "asset double, dep double, eq double, netinc double, roa double, roe double, "
        "_ingested_at string, _batch_id string"
    )
    return typed(spark.createDataFrame([(*FILED, at, "b") for at in stamps], text), FINANCIALS)


def test_report_dates_are_parsed(spark):
    loaded = filed(spark, "2024-05-01")
    assert loaded.schema.simpleString() == FINANCIALS.simpleString()
    assert loaded.first().repdte == dt.date(2024, 3, 31)


def test_validity_windows_are_parsed_at_both_ends(spark):
    rows = [(1, "n", "c", "VA", "N", None, None, "1900-01-01", "9999-12-31", True, "h")]
    names = HISTORY.names
    text = ", ".join(f"{n} {'bigint' if n == 'cert' else 'boolean' if n == 'is_current' else 'string'}" for n in names)
    row = typed(spark.createDataFrame(rows, text), HISTORY, "yyyy-MM-dd").first()
    assert (row.valid_from, row.valid_to) == (dt.date(1900, 1, 1), dt.date(9999, 12, 31))


def test_text_that_is_no_date_is_an_error_at_load(spark):
    df = spark.createDataFrame([("2024-13",)], "repdte string")
    with pytest.raises(Exception, match="CANNOT_PARSE"):
        typed(df, columns_of("repdte date")).collect()


def test_staging_reads_any_iso_time_and_survives_other_text(spark):
    rows = stage_financials(filed(spark, "2024-05-01", "2024-05-01T02:00:00+02:00", "soon")).collect()
    assert [r.ingested_at for r in rows] == [dt.datetime(2024, 5, 1)] * 2 + [None]
    assert rows[0].batch_id == "b" and "_batch_id" not in rows[0]


def test_dates_are_distinct_with_their_quarter(spark):
    days = [dt.date(2024, 3, 31)] * 3 + [dt.date(2024, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "repdte date")
    rows = [tuple(r) for r in dim_date(df).orderBy("date_day").collect()]
    assert rows == [(days[0], 2024, 1, "2024-Q1"), (days[3], 2024, 4, "2024-Q4")]


def test_the_unknown_member(spark):
    row = unknown_member(spark).first()
    assert (row.institution_sk, row.cert, row.name, row.is_current) == ("unknown", None, "Unknown Institution", True)
    assert (row.valid_from, row.valid_to) == (dt.date(1900, 1, 1), dt.date(9999, 12, 31))
    assert dim_institution(spark.createDataFrame([], HISTORY)).count() == 1


def test_freshness_of_facts_and_of_none(spark):
    when = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)
    facts = spark.createDataFrame([(dt.date(2024, 3, 31),), (dt.date(2024, 6, 30),)], "repdte date")
    assert tuple(freshness(facts, when).first()) == (dt.datetime(2026, 1, 1), dt.date(2024, 6, 30), 2)
    empty = freshness(facts.filter("false"), when)
    assert empty.schema.simpleString() == FRESHNESS.simpleString()
    assert tuple(empty.first())[1:] == (None, 0)


def test_declared_tables():
    assert len(FINANCIALS) == 14 and len(BRANCHES) == 12 and len(HISTORY) == 11


class Elsewhere:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_must_name_its_shared_folder(spark):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Elsewhere)
    assert session.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


def test_prepare_sets_what_results_depend_on(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    session.prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_load_does_not_clean_again(spark, monkeypatch):
    """What the two loads of a query get is stored: no plan of theirs deduplicates."""
    rows = [(1, "a"), (1, "b"), (2, None)]
    cleaned = latest_per_key(spark.createDataFrame(rows, "cert bigint, name string"), ["cert"], [])
    plans = []
    load = catalog.load_table

    def spied(warehouse, table, frame, schema, **options):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        load(warehouse, table, frame, schema, **options)

    monkeypatch.setattr(catalog, "load_table", spied)
    found = catalog._loaded(Inputs(spark, "unused"), cleaned, cleaned.schema)
    assert sorted(map(tuple, found.collect())) == [(1, "b"), (2, None)]
    assert len(plans) == 2 and not any("Window" in p for p in plans)


def test_files_are_written_in_zstd(spark, tmp_path):
    session.prepare(spark).range(9).write.parquet(f"{tmp_path}/rows")
    assert list((tmp_path / "rows").glob("*.zstd.parquet"))
