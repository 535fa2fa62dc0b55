"""Landing a message topic: provenance, rejects, replay after a crash, restart."""

import datetime as dt
import json

import pytest

from filingmill.operators.dedupe import latest_per_key
from filingmill.operators.projection import project_financials
from filingmill.schemas import MESSAGE
from filingmill.operators.quarantine import clean_financials
from filingmill.sources.drift import read_partition
from filingmill.sources.landing import dataset_path, land
from filingmill.sources.messages import (
    filing_messages,
    keyless_path,
    quarantine_keyless,
    replay_partition,
)
from filingmill.streaming import landing


def message(offset, cert, repdte="20230331", partition=0, **extra):
    value = {"CERT": cert, "REPDTE": repdte, "ASSET": 100.0, "_repdte_partition": repdte, **extra}
    return {"key": str(cert), "value": json.dumps(value), "partition": partition, "offset": offset}


def publish(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(m) + "\n" for m in messages))


def drain(spark, tmp_path, **options):
    stream = landing.file_messages(spark, str(tmp_path / "topic"))
    query = landing.start_landing(stream, str(tmp_path / "lake"), str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()


def landed(spark, tmp_path):
    return spark.read.parquet(str(tmp_path / "lake" / "raw" / landing.STREAM_DATASET))


def rejects(spark, tmp_path):
    return spark.read.parquet(str(tmp_path / "lake" / "quarantine" / landing.STREAM_DATASET))


def test_batches_land_by_date_and_source_partition(spark, tmp_path):
    publish(tmp_path / "topic", "1.json", [message(0, 1), message(1, 2), message(0, 3, partition=1)])
    publish(tmp_path / "topic", "2.json", [message(2, 4, "20230630"), message(3, 5)])
    drain(spark, tmp_path)
    rows = landed(spark, tmp_path)
    groups = {(str(r.dt), r.source_partition): r.rows for r in landing.landed_groups(rows).collect()}
    assert groups == {("20230331", 0): 3, ("20230331", 1): 1, ("20230630", 0): 1}
    labels = {r.label for r in landing.flush_manifest(rows).collect()}
    assert "stream-p0-000000000000-000000000001" in labels and len(labels) == 4
    row = rows.filter("_kafka_offset = 2").first()
    assert (row._kafka_topic, row._source_url) == ("filing.received", "kafka://filing.received")
    assert row._consumed_at is not None


def test_provenance_of_the_original_is_kept(spark, tmp_path):
    publish(tmp_path / "topic", "1.json", [message(0, 1, _ingested_at="t0", _batch_id="b0"), message(1, 2)])
    drain(spark, tmp_path)
    rows = {r.CERT: (r._ingested_at, r._batch_id) for r in landed(spark, tmp_path).collect()}
    assert rows[1] == ("t0", "b0")
    assert rows[2][0] > "2020" and rows[2][1]


def test_poison_and_unmarked_messages_are_quarantined_and_counted(spark, tmp_path):
    unmarked = {**message(1, 2), "value": json.dumps({"CERT": 2})}
    poison = {**message(2, 3), "value": "not json {"}
    publish(tmp_path / "topic", "1.json", [message(0, 1), unmarked, poison])
    drain(spark, tmp_path)
    assert landed(spark, tmp_path).count() == 1
    found = {r._kafka_offset: (r._reject_reason, r._payload) for r in rejects(spark, tmp_path).collect()}
    assert found == {1: ("missing_partition", '{"CERT": 2}'), 2: ("bad_json", "not json {")}


def test_a_batch_counts_what_it_wrote(spark, tmp_path):
    rows = [message(0, 1), message(1, 2), {**message(2, 3), "value": "{"}]
    batch = spark.createDataFrame([(m["key"], m["value"], m["partition"], m["offset"]) for m in rows], MESSAGE)
    counts = landing.land_batch(batch, str(tmp_path / "lake"), "b-1")
    assert counts == {"landed": 2, "quarantined": 1}


def test_fields_that_are_not_declared_stay_in_the_payload(spark, tmp_path):
    publish(tmp_path / "topic", "1.json", [message(0, 1, BRAND_NEW=5)])
    drain(spark, tmp_path)
    assert json.loads(landed(spark, tmp_path).first()._payload)["BRAND_NEW"] == 5


def test_a_batch_written_before_a_crash_is_replaced_by_its_replay(spark, tmp_path):
    publish(tmp_path / "topic", "1.json", [message(n, n) for n in range(8)])

    def crash(*args, **kwargs):
        landing.land_batch(*args, **kwargs)
        raise OSError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        drain(spark, tmp_path, writer=crash)
    assert landed(spark, tmp_path).count() == 8
    publish(tmp_path / "topic", "2.json", [message(8, 8)])
    drain(spark, tmp_path)
    offsets = [r._kafka_offset for r in landed(spark, tmp_path).collect()]
    assert sorted(offsets) == list(range(9))


def test_nothing_is_committed_when_the_write_fails(spark, tmp_path):
    publish(tmp_path / "topic", "1.json", [message(0, 1)])

    def fail(*args, **kwargs):
        raise OSError("no space")

    with pytest.raises(Exception, match="no space"):
        drain(spark, tmp_path, writer=fail)
    drain(spark, tmp_path)
    assert landed(spark, tmp_path).count() == 1


def test_a_new_checkpoint_does_not_replace_older_batches(spark, tmp_path):
    publish(tmp_path / "topic", "1.json", [message(0, 1)])
    drain(spark, tmp_path)
    stream = landing.file_messages(spark, str(tmp_path / "topic"))
    landing.start_landing(stream, str(tmp_path / "lake"), str(tmp_path / "other")).awaitTermination()
    assert landed(spark, tmp_path).count() == 2
    assert landed(spark, tmp_path).select("_kafka_offset").distinct().count() == 1


def test_a_forever_query_keeps_polling(spark, tmp_path):
    publish(tmp_path / "topic", "1.json", [message(0, 1)])
    stream = landing.file_messages(spark, str(tmp_path / "topic"))
    query = landing.start_landing(
        stream, str(tmp_path / "lake"), str(tmp_path / "checkpoint"), run_forever=True
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        assert landed(spark, tmp_path).count() == 1
    finally:
        query.stop()


def test_stream_copy_of_a_batch_row_collapses_onto_it(spark):
    raw = spark.createDataFrame(
        [(1, "20230331", 0.1 + 0.2, "t0", "b0")],
        "CERT long, REPDTE string, ASSET double, _ingested_at string, _batch_id string",
    )
    sent = filing_messages(raw, "20230331").selectExpr("*", "0 as partition", "0L as offset")
    copy = project_financials(landing.parse_messages(sent))
    both = project_financials(raw).unionByName(copy)
    assert both.distinct().count() == 1
    assert latest_per_key(both, ["cert", "repdte"]).count() == 1


def test_numbers_may_come_as_text_and_keys_as_fractions_of_zero(spark, tmp_path):
    values = [("10042", 1.0), (10042.0, "12.5"), ("10042.0", 1), ("x1", 1.0), (3.5, 1.0), (7, "many")]
    rows = [message(n, cert, ASSET=asset) for n, (cert, asset) in enumerate(values)]
    publish(tmp_path / "topic", "1.json", rows)
    totals = {}
    drain(spark, tmp_path, totals=totals)
    assert sorted((r.CERT, r.ASSET) for r in landed(spark, tmp_path).collect()) == [(10042, 1.0), (10042, 1.0), (10042, 12.5)]
    found = {r._kafka_offset: (r._reject_reason, r._bad_cast) for r in rejects(spark, tmp_path).collect()}
    assert found == {3: ("bad_cast", "cert"), 4: ("bad_cast", "cert"), 5: ("bad_cast", "asset")}
    assert totals == {"landed": 3, "quarantined": 3}


def test_a_hot_date_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(20_000).selectExpr(
        "cast(id % 500 as string) key",
        "to_json(named_struct('CERT', id, 'REPDTE', '20230331', '_repdte_partition', '20230331')) value",
        "cast(id % 2 as int) partition", "id offset",
    )
    counts = landing.land_batch(rows, str(tmp_path / "lake"), "b-1", tasks=16, file_messages=2500)
    assert counts == {"landed": 20_000, "quarantined": 0}
    assert len(landed(spark, tmp_path).inputFiles()) >= 8


def test_waiting_batches_do_not_wait_for_a_clock(spark, tmp_path):
    for n in range(3):
        publish(tmp_path / "topic", f"{n}.json", [message(n, n)])
    stream = landing.file_messages(spark, str(tmp_path / "topic"))
    query = landing.start_landing(stream, str(tmp_path / "lake"), str(tmp_path / "checkpoint"), run_forever=True)
    try:
        query.processAllAvailable()
        starts = sorted(dt.datetime.fromisoformat(p.timestamp) for p in query.recentProgress if p.numInputRows)
        assert len(starts) == 3
        assert (starts[2] - starts[0]).total_seconds() < 10 or max(
            p.durationMs["triggerExecution"] for p in query.recentProgress
        ) > 4000
    finally:
        query.stop()


def test_replay_of_a_text_partition_equals_the_batch(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "20230331", "1.5"), ("2.0", "20230331", "-3"), (None, "20230331", "4"), ("x", "20230331", "5")],
        "CERT string, REPDTE string, ASSET string",
    )
    whole = spark.createDataFrame([(9, "20230630", 1.0)], "CERT int, REPDTE string, ASSET double")
    root = str(tmp_path / "lake")
    for frame in (raw, whole):
        land(frame, root, "financials", frame.REPDTE, source_url="u", batch_id="b", ingested_at="t")
    path = dataset_path(root, "financials")
    part = read_partition(spark, path, "20230331")
    assert part.count() == 4 and read_partition(spark, path, "20231231") is None
    assert quarantine_keyless(part, "20230331", root) == 1
    assert quarantine_keyless(part, "20230331", root) == 1
    assert [r._reject_reason for r in spark.read.parquet(keyless_path(root)).collect()] == ["missing_key"]
    sent = replay_partition(part, "20230331").selectExpr("*", "0 as partition", "0L as offset")
    copies = landing.parse_messages(sent)
    assert copies.filter("_reject_reason = 'bad_cast'").count() == 1
    batch = clean_financials(part.filter("CERT is not null"))
    again = clean_financials(copies.filter("_reject_reason is null"))
    for ours, theirs in zip(batch, again):
        ours = ours.filter("cert is not null")
        assert ours.drop("_bad_values").exceptAll(theirs.drop("_bad_values")).count() == 0
        assert theirs.drop("_bad_values").exceptAll(ours.drop("_bad_values")).count() == 0


def test_a_large_batch_is_written_by_as_many_tasks_as_the_session_has(spark, tmp_path):
    rows = spark.range(100_000).selectExpr(
        "cast(id % 500 as string) key",
        "to_json(named_struct('CERT', id, 'REPDTE', '20230331', '_repdte_partition', '20230331')) value",
        "cast(id % 2 as int) partition", "id offset",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        landing.land_batch(rows, str(tmp_path / "lake"), "b-1", file_messages=1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spark.read.parquet(f"{tmp_path}/lake/raw/{landing.STREAM_DATASET}").inputFiles()) > 16
