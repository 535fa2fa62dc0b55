"""Landing a topic of filing messages in the raw layer with Structured Streaming."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import UTC, datetime
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from filingmill.operators.projection import BAD_CAST, typed_fields
from filingmill.schemas import DT_MARKER, FINANCIALS_FIELDS, MESSAGE, PROVENANCE, TOPIC, TYPES
from filingmill.sources.landing import stamp_raw
from filingmill.streaming.counts import batch_name, record_counts

logger = logging.getLogger(__name__)

STREAM_DATASET = "financials_stream"
# A batch starts at this many new messages, or when the oldest has waited this long. Fixed values of
# the landing policy: a flush size, not a rate. What is there when a batch starts goes into it.
FLUSH_MESSAGES = 1000
MAX_WAIT = "10 seconds"
# Consecutive offsets of one source partition and report date that a file holds at most.
FILE_MESSAGES = 250_000

LANDED, QUARANTINED = "landed", "quarantined"
_CORRUPT = "_corrupt"


def payload_schema(fields: dict[str, str] | None = None) -> T.StructType:
    """Declared fields of a message value in their types; what a message lacks is null."""
    schema = T.StructType()
    for name, type_name in (fields or FINANCIALS_FIELDS).items():
        schema = schema.add(name, TYPES[type_name])
    for name in (*PROVENANCE, DT_MARKER, _CORRUPT):
        schema = schema.add(name, TYPES["string"])
    return schema


def _text_schema(fields: dict[str, str] | None) -> T.StructType:
    """Any JSON value is text first: a number may come quoted, a key as 10042.0."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in payload_schema(fields).fields])


def kafka_messages(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = TOPIC,
    flush_messages: int = FLUSH_MESSAGES,
    most_messages: int | None = None,
) -> DataFrame:
    """The topic from its earliest offset. Needs Spark's Kafka connector on the class path.

    A batch starts at `flush_messages` new messages or after the wait, whichever is first, and takes
    all there are, or `most_messages` of them where a first batch must be kept small.
    """
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("minOffsetsPerTrigger", flush_messages)
        .option("maxTriggerDelay", MAX_WAIT)
    )
    if most_messages is not None:
        source = source.option("maxOffsetsPerTrigger", most_messages)
    return source.load().select(
        F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset"
    )


def file_messages(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Messages landed as JSON lines with the same columns."""
    return (
        spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_trigger).json(path)
    )


def parse_messages(
    messages: DataFrame, topic: str = TOPIC, fields: dict[str, str] | None = None
) -> DataFrame:
    """Decode values and tag what cannot be landed: `bad_json`, `bad_cast` or `missing_partition`.

    Every field is decoded as text and then cast as the batch path does. `_payload` keeps the value as
    received, with the fields the declared ones leave out; `_bad_cast` names those that do not cast.
    """
    fields = fields or FINANCIALS_FIELDS
    text = _text_schema(fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    decoded = messages.withColumn("_v", F.from_json("value", text, options))
    present = {f.name: f.dataType for f in text.fields}
    columns, bad, _ = typed_fields(lambda name: F.col(f"_v.{name}"), present, fields)
    reason = (
        F.when(F.col("_v").isNull() | F.col(f"_v.{_CORRUPT}").isNotNull(), F.lit("bad_json"))
        .when(bad.isNotNull(), F.lit("bad_cast"))
        .when(F.col(f"_v.{DT_MARKER}").isNull(), F.lit("missing_partition"))
    )
    return decoded.select(
        *(column.alias(name) for name, column in columns.items()),
        *(F.col(f"_v.{name}") for name in (*PROVENANCE, DT_MARKER)),
        F.lit(topic).alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.col("key").alias("_kafka_key"),
        F.col("value").alias("_payload"),
        bad.alias(BAD_CAST),
        reason.alias("_reject_reason"),
    )


def land_batch(
    messages: DataFrame,
    root: str,
    batch: str,
    *,
    topic: str = TOPIC,
    consumed_at: datetime | None = None,
    fields: dict[str, str] | None = None,
    tasks: int | None = None,
    file_messages: int = FILE_MESSAGES,
) -> dict[str, int]:
    """Write one micro-batch: landed rows by report date, rejects by reason. Returns how many there
    were of each, counted by the write itself; only a batch with rejects is read a second time.

    A file holds consecutive offsets of one report date and source partition, `file_messages` at most,
    so a date that all messages belong to is written by many tasks: as many as the session has shuffle
    partitions, or `tasks`. The ranges a file covers can be read from it (`flush_manifest`).

    `batch` names a folder of its own, replaced when the batch runs again, so a batch that was
    written but not committed before a crash is not landed twice.
    """
    when = (consumed_at or datetime.now(UTC)).isoformat()
    is_good = F.col("_reject_reason").isNull()
    seen = Observation()
    tagged = parse_messages(messages, topic, fields)
    counted = tagged.observe(
        seen, F.count_if(is_good).alias(LANDED), F.count_if(~is_good).alias(QUARANTINED)
    )
    landed = stamp_raw(
        counted.filter(is_good).drop("_reject_reason", BAD_CAST),
        source_url=f"kafka://{topic}",
        batch_id=batch,
        ingested_at=when,
        extra={
            "_consumed_at": F.lit(when),
            "dt": F.col(DT_MARKER),
            "batch": F.lit(batch),
        },
    )
    _write(landed, f"{root}/raw/{STREAM_DATASET}", ["dt", "batch"], tasks, file_messages)
    counts = {name: int(seen.get[name]) for name in (LANDED, QUARANTINED)}
    if counts[QUARANTINED]:
        rejects = tagged.filter(~is_good).withColumn("batch", F.lit(batch))
        path = f"{root}/quarantine/{STREAM_DATASET}"
        _write(rejects, path, ["_reject_reason", "batch"], tasks, file_messages)
    logger.info("batch %s of %s: %s", batch, topic, counts)
    return counts


def _write(df: DataFrame, path: str, parts: list[str], tasks: int | None, file_messages: int) -> None:
    ranges = [*parts, "_kafka_partition", F.floor(F.col("_kafka_offset") / file_messages)]
    (
        (df.repartition(*ranges) if tasks is None else df.repartition(tasks, *ranges))
        .sortWithinPartitions(*parts, "_kafka_partition", "_kafka_offset")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def start_landing(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    *,
    topic: str = TOPIC,
    run_forever: bool = False,
    fields: dict[str, str] | None = None,
    tasks: int | None = None,
    file_messages: int = FILE_MESSAGES,
    totals: dict[str, int] | None = None,
    writer: Callable[..., dict[str, int]] = land_batch,
) -> StreamingQuery:
    """Land a stream of messages; drain it and stop, or poll until stopped.

    A batch begins as soon as the one before has ended and the source has what its flush rule asks
    for: no clock holds back messages that are there. The numbers landed and quarantined are kept as a row
    for each batch (`batch_counts`); `totals`, if given, adds up those of this process.

    Offsets are committed in the checkpoint after the write, so delivery is at least once and the
    batch folder makes the replay overwrite itself. The folder carries the id of the checkpoint, so
    a landing restarted from a new checkpoint never replaces what an older one wrote.
    """

    @cache
    def run_id() -> str:
        return messages.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]

    def land(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(run_id(), batch_id)
        counts = writer(
            batch, root, name, topic=topic, fields=fields, tasks=tasks, file_messages=file_messages
        )
        now = datetime.now(UTC).isoformat()
        record_counts(messages.sparkSession, root, STREAM_DATASET, name, counts, now)
        if totals is not None:
            for outcome, n in counts.items():
                totals[outcome] = totals.get(outcome, 0) + n

    stream = messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (stream if run_forever else stream.trigger(availableNow=True)).start()


def _by_source(landed: DataFrame) -> DataFrame:
    return landed.withColumn("source_partition", F.col("_kafka_partition"))


def landed_groups(landed: DataFrame) -> DataFrame:
    """Rows per report date and source partition."""
    return _by_source(landed).groupBy("dt", "source_partition").agg(F.count("*").alias("rows"))


def flush_manifest(landed: DataFrame) -> DataFrame:
    """Offset range, row count and range label per report date, source partition and batch."""
    offsets = F.col("first_offset"), F.col("last_offset")
    label = F.format_string("stream-p%d-%012d-%012d", F.col("source_partition"), *offsets)
    return (
        _by_source(landed)
        .groupBy("dt", "source_partition", "batch")
        .agg(
            F.min("_kafka_offset").alias("first_offset"),
            F.max("_kafka_offset").alias("last_offset"),
            F.count("*").alias("rows"),
        )
        .withColumn("label", label)
    )
