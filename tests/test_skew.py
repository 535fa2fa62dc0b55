"""One key, date, state or value holds most rows: results are whole and hot rows do not travel."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from filingmill.operators.dedupe import latest_per_key
from filingmill.operators.marts import bank_state_deposits, deposit_concentration, latest_financials
from filingmill.operators.ranking import rank_descending
from filingmill.plans.quality import orphan_keys, repeated_keys
from filingmill.sources.landing import write_partitions

ROWS = 20_000
DAY = dt.date(2024, 6, 30)


@pytest.fixture
def traffic(spark):
    """Runs a frame to its end and returns how many rows its shuffles wrote."""

    def run(df):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, group)
        df.write.format("noop").mode("overwrite").save()
        tracker, store = spark.sparkContext.statusTracker(), spark._jsc.sc().statusStore()
        jobs = (tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group))
        stages = {stage for job in jobs for stage in job.stageIds if tracker.getStageInfo(stage)}
        attempts = [store.lastStageAttempt(stage) for stage in stages]
        return sum(a.shuffleWriteRecords() for a in attempts if a.status().toString() == "COMPLETE")

    return run


def copies(spark):
    """Most rows are deliveries of one key."""
    hot = F.col("id") % 10 != 0
    return spark.range(0, ROWS, 1, 4).select(
        F.when(hot, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("_ingested_at"),
        F.lit("b").alias("_batch_id"),
    )


def test_a_key_delivered_very_often_is_pruned_before_the_shuffle(spark, traffic):
    out = latest_per_key(copies(spark), ["k"])
    assert out.count() == ROWS // 10
    assert 0 < traffic(latest_per_key(copies(spark), ["k"])) <= ROWS // 10 + 4


def test_checks_count_a_hot_key_before_the_shuffle(spark, traffic):
    assert [(r.k, r.row_count) for r in repeated_keys(copies(spark), ["k"]).collect()] == [(0, ROWS * 9 // 10 + 1)]
    assert 0 < traffic(repeated_keys(copies(spark), ["k"])) <= ROWS // 10 + 4
    parents = spark.createDataFrame([(10,)], "k long")
    assert orphan_keys(copies(spark), "k", parents, "k").count() == ROWS // 10 - 1


def test_latest_report_moves_one_row_per_institution_and_task(spark, traffic):
    facts = spark.range(0, ROWS, 1, 4).select(
        F.lit(1).alias("cert"),
        F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("repdte"),
        F.col("id").cast("double").alias("asset"),
    )
    row = latest_financials(facts).first()
    assert (row.latest_repdte, row.latest_asset) == (DAY + dt.timedelta(days=ROWS - 1), ROWS - 1.0)
    assert 0 < traffic(latest_financials(facts)) <= 4


def test_concentration_of_a_state_with_most_deposits(spark, traffic):
    branches = spark.range(0, ROWS, 1, 4).select(
        (F.col("id") % 500).alias("cert"),
        F.when(F.col("id") % 500 == 0, "TX").otherwise("VA").alias("stalpbr"),
        F.lit(DAY).alias("repdte"),
        F.lit(1.0).alias("depsumbr"),
    )
    out = {r.cert: r for r in deposit_concentration(branches).collect()}
    assert len(out) == 500 and out[0].deposit_share == 1.0 and out[0].state_hhi == 10000.0
    assert out[7].deposit_share == pytest.approx(1 / 499) and out[7].state_hhi == pytest.approx(10000 / 499)
    assert 0 < traffic(bank_state_deposits(branches)) <= 4 * 500


def test_rank_where_most_rows_share_a_value(spark):
    rows = spark.range(0, ROWS, 1, 4).select(
        F.lit(DAY).alias("day"),
        F.when(F.col("id") % 10 != 0, F.lit(0.0)).otherwise(F.col("id") - ROWS / 2).alias("v"),
    )
    ranked = rank_descending(rows, ["day"], "v", "rank").groupBy("v").agg(
        F.min("rank").alias("low"), F.max("rank").alias("high"), F.count("*").alias("n")
    )
    above = 0
    for r in ranked.orderBy(F.desc("v")).collect():
        assert r.low == r.high == above + 1
        above += r.n
    assert above == ROWS


@pytest.fixture
def scaled_down(spark):
    """Adaptive thresholds small enough for this data to count as large."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_hot_rows_of_the_rank_join_are_split(scaled_down):
    rows = scaled_down.range(0, ROWS * 5, 1, 4).select(
        F.col("id"),
        F.lit(DAY).alias("day"),
        F.when(F.col("id") % 3 != 0, F.lit(0.0)).otherwise(F.rand(1)).alias("v"),
    )
    ranked = rank_descending(rows, ["day"], "v", "rank")
    assert len(ranked.collect()) == ROWS * 5
    assert "skew=true" in ranked._jdf.queryExecution().executedPlan().toString()


def test_deposits_of_a_hot_state_are_split(scaled_down):
    branches = scaled_down.range(0, ROWS * 2, 1, 4).select(
        F.col("id").alias("cert"),
        F.when(F.col("id") % 10 == 0, (F.col("id") % 40).cast("string")).otherwise("VA").alias("stalpbr"),
        F.lit(DAY).alias("repdte"),
        F.rand(2).alias("depsumbr"),
    )
    shares = deposit_concentration(branches)
    assert len(shares.collect()) == ROWS * 2
    assert "skew=true" in shares._jdf.queryExecution().executedPlan().toString()


def test_a_large_partition_is_written_as_several_files(scaled_down, tmp_path):
    rows = scaled_down.range(0, ROWS * 5, 1, 8).select(
        F.col("id"),
        F.when(F.col("id") % 10 != 0, "20240630").otherwise("20240331").alias("dt"),
        F.rand(3).alias("v"),
    )
    write_partitions(rows, str(tmp_path / "d"), cluster_by=["id"])
    assert len(list((tmp_path / "d" / "dt=20240630").glob("*.parquet"))) >= 4
    assert scaled_down.read.parquet(str(tmp_path / "d")).count() == ROWS * 5
