"""Replaying filings as keyed JSON messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingmill.schemas import DT_MARKER, TOPIC
from filingmill.sources.drift import partition_frames, read_partitions
from filingmill.sources.landing import PARTITION, dataset_path, partition_values, write_partitions


def filing_messages(filings: DataFrame, repdte: str | Column) -> DataFrame:
    """`key`, `value` per filing: the institution as key, so its filings keep their order, and the
    row as JSON with the partition it came from. Filings without a key are in `keyless_filings`."""
    marker = F.lit(repdte) if isinstance(repdte, str) else repdte
    columns = [F.col(c) for c in filings.columns if c != PARTITION]
    return filings.filter(F.col("CERT").isNotNull()).select(
        F.col("CERT").cast("string").alias("key"),
        F.to_json(F.struct(*columns, marker.alias(DT_MARKER))).alias("value"),
    )


def keyless_filings(filings: DataFrame) -> DataFrame:
    return filings.filter(F.col("CERT").isNull()).withColumn("_reject_reason", F.lit("missing_key"))


def replay_partition(raw: DataFrame, repdte: str, limit: int | None = None) -> DataFrame:
    """Messages of one raw partition, or of its first `limit` filings by key and batch."""
    filings = raw.filter(F.col(PARTITION).cast("string") == repdte)
    if limit is not None:
        filings = filings.orderBy("CERT", "_batch_id").limit(limit)
    return filing_messages(filings, repdte)


def quarantine_keyless(raw: DataFrame, repdte: str, root: str) -> int:
    """Write the filings of a partition that cannot be replayed to `<root>/quarantine/replay`, in place
    of those of an earlier replay of it. Returns how many there are."""
    seen = Observation()
    filings = raw.filter(F.col(PARTITION).cast("string") == repdte)
    rows = keyless_filings(filings).observe(seen, F.count("*").alias("rows"))
    write_partitions(rows.withColumn(PARTITION, F.lit(repdte)), keyless_path(root))
    return int(seen.get["rows"])


def partitions_between(spark: SparkSession, path: str, first: str = "", last: str = "9" * 8) -> list[str]:
    """The partitions of a raw dataset from `first` to `last`; all by default."""
    return [v for v in partition_values(spark, path) if first <= v <= last]


def replay_partitions(
    spark: SparkSession, path: str, first: str = "", last: str = "9" * 8, limit: int | None = None
) -> DataFrame:
    """Messages of all raw partitions from `first` to `last`, or of the first `limit` filings of each by key
    and batch. One read per schema: a message is text, so filings of partitions that differ in types become
    one frame, each as it was written."""
    frames = partition_frames(spark, path, partitions_between(spark, path, first, last))
    if not frames:
        return spark.createDataFrame([], "key string, value string")
    if limit is not None:
        first_of = Window.partitionBy(PARTITION).orderBy("CERT", "_batch_id")
        frames = [f.withColumn("_n", F.row_number().over(first_of)).filter(F.col("_n") <= limit).drop("_n") for f in frames]
    return reduce(DataFrame.unionByName, [filing_messages(f, F.col(PARTITION).cast("string")) for f in frames])


def quarantine_keyless_partitions(
    spark: SparkSession, path: str, root: str, first: str = "", last: str = "9" * 8
) -> int:
    """`quarantine_keyless` of all partitions from `first` to `last`, in one job."""
    raw = read_partitions(spark, path, partitions_between(spark, path, first, last))
    if raw is None:
        return 0
    seen = Observation()
    rows = keyless_filings(raw.withColumn(PARTITION, F.col(PARTITION).cast("string")))
    write_partitions(rows.observe(seen, F.count("*").alias("rows")), keyless_path(root))
    return int(seen.get["rows"])


def keyless_path(root: str) -> str:
    return dataset_path(root, "replay", "quarantine")


def send_to_kafka(messages: DataFrame, bootstrap_servers: str, topic: str = TOPIC) -> None:
    """Needs Spark's Kafka connector on the class path."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("topic", topic)
        .save()
    )
