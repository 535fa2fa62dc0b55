"""The raw layer: pages, stamps, partitions, drift, listing, messages."""

import datetime as dt
import json

import pytest

from filingmill.operators.projection import BAD_CAST, project_financials
from filingmill.schemas import BRANCH_DICTIONARY, FINANCIALS_FIELDS, columns_of
from filingmill.sources import landing, messages
from filingmill.sources.drift import read_projected, schema_drift


def write_page(folder, name, total, certs):
    folder.mkdir(parents=True, exist_ok=True)
    page = {"meta": {"total": total}, "data": [{"data": {"CERT": c}, "score": 0} for c in certs]}
    (folder / name).write_text(json.dumps(page, indent=1))


def test_pages_are_read_and_unwrapped_in_any_order(spark, tmp_path):
    write_page(tmp_path / "source=a", "p2.json", 3, [3])
    write_page(tmp_path / "source=a", "p1.json", 3, [1, 2])
    write_page(tmp_path / "source=b", "p1.json", 4, [4])
    write_page(tmp_path / "source=c", "p1.json", 0, [])
    pages = landing.read_pages(spark, str(tmp_path), columns_of("CERT bigint"))
    assert sorted(r.CERT for r in landing.unwrap_pages(pages).collect()) == [1, 2, 3, 4]
    short = landing.incomplete_pages(pages, ["source"]).collect()
    assert [(r.source, r.announced, r.received) for r in short] == [("b", 4, 1)]


def test_ingested_pages_keep_every_field_and_report_what_is_missing(spark, tmp_path):
    pages = [
        {"meta": {"total": 2}, "data": [{"data": {"CERT": 1, "REPDTE": "20240331"}, "score": 1}]},
        {"meta": {"total": 2}, "data": [{"data": {"CERT": 2, "REPDTE": "20240630", "NEW": "x"}}]},
    ]
    for name, page in zip("ab", pages, strict=True):
        folder = tmp_path / "pages" / f"source={name}"
        folder.mkdir(parents=True)
        (folder / "1.json").write_text(json.dumps(page, indent=1))
    root = str(tmp_path / "lake")
    pages_path = str(tmp_path / "pages")
    for require in (True, False):
        short = landing.ingest_pages(
            spark, pages_path, root, "financials", "REPDTE",
            source_url="u", batch_id="b", require_complete=require,
        )
        assert sorted((r.source, r.announced, r.received) for r in short) == [("a", 2, 1), ("b", 2, 1)]
        if require:
            assert landing.partition_values(spark, landing.dataset_path(root, "financials")) == []
    rows = spark.read.parquet(landing.dataset_path(root, "financials")).orderBy("CERT").collect()
    assert [(r.CERT, r.NEW, r._batch_id, str(r.dt)) for r in rows] == [
        (1, None, "b", "20240331"), (2, "x", "b", "20240630"),
    ]


def test_a_records_own_provenance_stays(spark):
    records = spark.createDataFrame(
        [(1, "t0", None), (2, None, "old")], "CERT long, _ingested_at string, _batch_id string"
    )
    when = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)
    out = landing.stamp_raw(records, source_url="u", batch_id="new", ingested_at=when)
    assert [tuple(r) for r in out.orderBy("CERT").collect()] == [
        (1, "t0", "new", "u"), (2, when.isoformat(), "old", "u"),
    ]


def test_one_batch_id_per_write(spark):
    out = landing.stamp_raw(spark.range(50).repartition(5), source_url="u")
    assert out.select("_batch_id").distinct().count() == 1


def test_records_with_different_fields_are_padded(spark):
    a = spark.createDataFrame([(1, "x")], "CERT long, NAME string")
    b = spark.createDataFrame([(2, "y")], "CERT long, NEW_FIELD string")
    out = landing.union_of_fields([a, b]).orderBy("CERT").collect()
    assert [tuple(r) for r in out] == [(1, "x", None), (2, None, "y")]


def rows_of(spark, path):
    return sorted((str(r.dt), r.v) for r in spark.read.parquet(path).select("dt", "v").collect())


def test_a_rerun_replaces_only_the_partitions_it_has_rows_for(spark, tmp_path):
    path = str(tmp_path / "d")
    first = spark.createDataFrame([("20240331", 1), ("20240630", 2)], "dt string, v int")
    landing.write_partitions(first, path)
    landing.write_partitions(first.filter("dt = '20240630'").selectExpr("dt", "v + 10 as v"), path)
    assert rows_of(spark, path) == [("20240331", 1), ("20240630", 12)]
    landing.write_partitions(first.filter("false"), path)
    assert rows_of(spark, path) == [("20240331", 1), ("20240630", 12)]
    landing.write_partitions(first.filter("v = 1"), path, replace_all=True)
    assert rows_of(spark, path) == [("20240331", 1)]


def test_partition_listing_and_the_raw_gate(spark, tmp_path):
    root = str(tmp_path)
    assert landing.partition_values(spark, landing.dataset_path(root, "sod")) == []
    df = spark.createDataFrame([("2024", 1), ("2023", 2)], "dt string, v int")
    for name in ("sod", "financials"):
        landing.write_partitions(df, landing.dataset_path(root, name))
    assert landing.partition_values(spark, landing.dataset_path(root, "sod")) == ["2023", "2024"]
    assert landing.missing_datasets(spark, root) == ["institutions"]
    with pytest.raises(RuntimeError, match="institutions"):
        landing.require_raw(spark, root)


def test_period_selection(spark):
    assert landing.quarter_ends("20230630", "20240101") == ["20230630", "20230930", "20231231"]
    assert len(landing.quarter_ends("20230331", "20251231")) == 12
    assert landing.quarter_ends("20260101", "20261231") == ["20260331", "20260630", "20260930", "20261231"]
    assert len(landing.quarter_ends("19000101", "29991231")) == 4400
    assert landing.survey_years("20230630", "20240101") == [2023, 2024]
    assert landing.survey_years("20240331", "20241231") == [2024]
    df = spark.createDataFrame([("20230331",), ("20240331",), ("2023",), ("2025",)], "dt string")
    kept = landing.within_periods(df, "20230101", "20231231").collect()
    assert [r.dt for r in kept] == ["20230331", "2023"]


def test_periods_whose_types_disagree_are_read_together(spark, tmp_path):
    path = str(tmp_path / "financials")
    kinds = {"20240331": "int", "20240630": "string", "20240930": "bigint", "20241231": "int"}
    schema = "CERT int, REPDTE string, _ingested_at string, _batch_id string"
    for day, kind in kinds.items():
        frame = spark.createDataFrame([(7, day, "t", "b")], schema)
        frame.withColumn("CERT", frame.CERT.cast(kind)).write.parquet(f"{path}/dt={day}")
    out = read_projected(spark, path, project_financials).drop(BAD_CAST)
    assert sorted((r.cert, r.repdte) for r in out.collect()) == [(7, day) for day in kinds]
    some = read_projected(spark, path, project_financials, ["20240331", "20990331"])
    assert [r.repdte for r in some.collect()] == ["20240331"]
    assert read_projected(spark, str(tmp_path / "none"), project_financials) is None


def test_files_of_one_partition_may_disagree(spark, tmp_path):
    folder = str(tmp_path / "financials" / "dt=20240331")
    schema = "CERT int, REPDTE string, _ingested_at string, _batch_id string"
    frame = spark.createDataFrame([(7, "20240331", "t", "b")], schema)
    frame.write.parquet(folder)
    frame.withColumn("CERT", frame.CERT.cast("string")).write.mode("append").parquet(folder)
    out = read_projected(spark, str(tmp_path / "financials"), project_financials)
    assert [r.cert for r in out.collect()] == [7, 7]


def test_schema_drift(spark):
    df = spark.createDataFrame(
        [("7", 1, None, "b"), ("8", 2, "x", "b")], "CERT string, UNINUMBR long, BRAND_NEW string, _batch_id string"
    )
    found = {(r.field, r.drift): r.rows for r in schema_drift(df, BRANCH_DICTIONARY).collect()}
    assert found["CERT", "retyped"] == 2 and found["BRAND_NEW", "added"] == 1
    assert found["YEAR", "missing"] == 0
    assert ("UNINUMBR", "retyped") not in found and len(found) == 82
    assert sum(kind == "string" for kind in BRANCH_DICTIONARY.values()) == 44
    assert schema_drift(df, {"CERT": "string", "UNINUMBR": "number", "BRAND_NEW": "string"}).count() == 0


def test_messages_are_keyed_and_carry_their_partition(spark):
    raw = spark.createDataFrame(
        [
            (10042, 5.0, "t0", "b2", "20230331"),
            (7, 1.0, "t0", "b1", "20230331"),
            (None, 1.0, "t", "b", "20230331"),
            (8, 1.0, "t", "b", "20230630"),
        ],
        "CERT long, ASSET double, _ingested_at string, _batch_id string, dt string",
    )
    out = {r.key: json.loads(r.value) for r in messages.replay_partition(raw, "20230331").collect()}
    assert set(out) == {"10042", "7"}
    assert out["10042"] == {
        "CERT": 10042, "ASSET": 5.0, "_ingested_at": "t0", "_batch_id": "b2",
        "_repdte_partition": "20230331",
    }
    limited = messages.replay_partition(raw.filter("CERT is not null"), "20230331", limit=1)
    assert [r.key for r in limited.collect()] == ["7"]
    assert messages.keyless_filings(raw).count() == 1


@pytest.mark.parametrize("partitions", [3, 30])
def test_the_drift_read_needs_as_many_jobs_for_few_partitions_as_for_many(spark, tmp_path, partitions):
    path = str(tmp_path / "financials")
    for kind in ("int", "string"):
        rows = spark.range(partitions).selectExpr(
            f"cast(id as {kind}) CERT", f"cast(20200101 + 2 * id + {int(kind == 'int')} as string) dt",
            "'t' _ingested_at", "'b' _batch_id", f"id as ONLY_{kind}",
        )
        landing.write_recorded(rows, path)
    spark.sparkContext.setJobGroup(f"drift-{partitions}", "footers")
    out = read_projected(spark, path, project_financials, fields=FINANCIALS_FIELDS)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"drift-{partitions}")) <= 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert out.filter("cert is not null").count() == 2 * partitions


def test_a_write_that_fails_half_way_leaves_partitions_to_their_footers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "financials")
    days = ["20240331", "20240630", "20240930"]
    rows = spark.createDataFrame([(1, d) for d in days], "CERT int, dt string")
    landing.write_recorded(rows, path)
    assert set(landing.recorded_schemas(spark, path)) == set(days)
    real = landing.write_partitions

    def fail(df, path):
        """Replaces one partition of two and stops."""
        real(df.filter(df.dt == days[0]), path)
        raise OSError("no space")

    text = spark.createDataFrame([("1", d) for d in days[:2]], "CERT string, dt string")
    with monkeypatch.context() as patch:
        patch.setattr(landing, "write_partitions", fail)
        with pytest.raises(OSError, match="no space"):
            landing.write_recorded(text, path)
    recorded = landing.recorded_schemas(spark, path)
    assert set(recorded) == set(days[1:]) and {s["CERT"].dataType.simpleString() for s in recorded.values()} == {"int"}
    stamped = [df.selectExpr("*", "'t' _ingested_at", "'b' _batch_id") for df in (rows, text)]
    landing.write_partitions(stamped[1], path)  # by other means
    landing.write_recorded(stamped[0].filter("dt = '20240930'"), path)
    assert set(landing.recorded_schemas(spark, path)) == {days[2]}
    assert {r.cert for r in read_projected(spark, path, project_financials).collect()} == {1}


def test_a_landing_evaluates_its_rows_once(spark, tmp_path):
    path, seen = str(tmp_path / "financials"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(i, f"2024{i % 4 + 1:02}31") for i in range(40)], "CERT long, dt string").mapInPandas(count, "CERT long, dt string")
    landing.write_recorded(rows, path)
    assert seen.value == 40 and len(landing.recorded_schemas(spark, path)) == 4
    landing.write_recorded(rows.limit(0), path)
    landing.write_recorded(rows, path)
    assert len(landing._records(spark, path)) == 1  # that of files that are gone is deleted


def test_periods_that_were_not_landed(spark, tmp_path):
    rows = spark.createDataFrame([("20240331",), ("20240930",)], "dt string")
    landing.write_partitions(rows.selectExpr("1 x", "dt"), f"{tmp_path}/raw/financials")
    landing.write_partitions(rows.selectExpr("1 x", "'2025' dt"), f"{tmp_path}/raw/sod")
    found = landing.missing_periods(spark, str(tmp_path), "20240301", "20250331")
    assert found == [("financials", "20240630"), ("financials", "20241231"), ("financials", "20250331"), ("sod", "2024")]
