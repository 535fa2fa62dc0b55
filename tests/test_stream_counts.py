"""Counts of a landing as rows: each batch once, also after a crash; progress from a listener."""

import time

import pytest

from filingmill.streaming.counts import LandingListener, batch_counts
from filingmill.streaming.landing import STREAM_DATASET, file_messages, land_batch, start_landing


def send(spark, folder, first, n):
    rows = spark.range(first, first + n).selectExpr(
        "cast(id as string) key",
        """concat('{"CERT": ', id, ', "REPDTE": "20240331"', if(id % 5 = 0, '', ', "_repdte_partition": "20240331"'), '}') value""",
        "0 partition", "id offset",
    )
    rows.coalesce(1).write.mode("append").json(f"{folder}/topic")


def drain(spark, folder, **options):
    stream = file_messages(spark, f"{folder}/topic")
    start_landing(stream, f"{folder}/lake", f"{folder}/checkpoint", **options).awaitTermination()


def found(spark, folder):
    return batch_counts(spark, f"{folder}/lake", STREAM_DATASET).orderBy("batch").collect()


def test_a_killed_and_resumed_landing_counts_each_batch_once(spark, tmp_path):
    folder = str(tmp_path)
    assert found(spark, folder) == []
    for k in range(3):
        send(spark, folder, 10 * k, 10)

    def dying(batch, *args, **options):
        """Writes its second batch and dies before it is committed."""
        counts = land_batch(batch, *args, **options)
        if args[1].endswith("1"):
            raise OSError("killed")
        return counts

    with pytest.raises(Exception, match="killed"):
        drain(spark, folder, writer=dying)
    assert [(r.landed, r.quarantined) for r in found(spark, folder)] == [(8, 2)]
    drain(spark, folder)
    assert [(r.landed, r.quarantined) for r in found(spark, folder)] == [(8, 2)] * 3
    drain(spark, folder)
    assert len(found(spark, folder)) == 3
    assert spark.read.parquet(f"{folder}/lake/raw/{STREAM_DATASET}").count() == 24


def test_progress_is_heard_of(spark, tmp_path):
    folder = str(tmp_path)
    send(spark, folder, 0, 10)
    send(spark, folder, 10, 5)
    listener = LandingListener(spark, f"{folder}/lake", STREAM_DATASET)
    spark.streams.addListener(listener)
    try:
        drain(spark, folder)
        for _ in range(50):
            rows = found(spark, folder)
            if rows and all(r.rows_read is not None for r in rows):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    # A batch with rejects is read twice.
    assert sorted(r.rows_read for r in rows) == [10, 20] and all(r.duration_ms > 0 for r in rows)
