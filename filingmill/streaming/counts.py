"""Counts of a landing that outlive its process: a row for each batch, and its progress from a listener."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from filingmill.sources.landing import _exists, dataset_path, write_text

_COUNTS = "batch string, landed bigint, quarantined bigint, consumed_at string"
_PROGRESS = "batch string, rows_read bigint, duration_ms bigint, ended_at string"


def batch_name(checkpoint_id: str, batch_id: int) -> str:
    return f"{checkpoint_id}-{batch_id:012d}"


def _folder(root: str, dataset: str, kind: str) -> str:
    return f"{dataset_path(root, dataset, 'counts')}/{kind}"


def record_counts(spark: SparkSession, root: str, dataset: str, batch: str, counts: dict[str, int], consumed_at: str) -> None:
    """A file of its own for each batch, written before the batch is committed and in place of that of an
    earlier try: a batch that runs again after a crash counts once."""
    row = {"batch": batch, **counts, "consumed_at": consumed_at}
    write_text(spark, f"{_folder(root, dataset, 'batches')}/{batch}.json", json.dumps(row))


def batch_counts(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """`batch`, `landed`, `quarantined`, `consumed_at` of every batch, with `rows_read`, `duration_ms` and
    `ended_at` of those whose progress was heard of; a landing that was killed leaves its last one out."""

    def read(kind: str, schema: str) -> DataFrame:
        folder = _folder(root, dataset, kind)
        if not _exists(spark, folder):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).json(folder)

    return read("batches", _COUNTS).join(read("progress", _PROGRESS), "batch", "left")


class LandingListener(StreamingQueryListener):
    """Writes the progress of a landing's batches beside their counts. To be added to `spark.streams`; it
    hears of all queries of the session and keeps to the one whose checkpoint it is given."""

    def __init__(self, spark: SparkSession, root: str, dataset: str, checkpoint_id: str | None = None):
        self.spark, self.root, self.dataset, self.checkpoint_id = spark, root, dataset, checkpoint_id

    def onQueryStarted(self, event) -> None:  # noqa: N802
        """Nothing is known of batches yet."""

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if self.checkpoint_id not in (None, str(progress.id)):
            return
        name = batch_name(str(progress.id), progress.batchId)
        row = {
            "batch": name,
            "rows_read": progress.numInputRows,
            "duration_ms": progress.durationMs.get("triggerExecution", 0),
            "ended_at": progress.timestamp,
        }
        write_text(self.spark, f"{_folder(self.root, self.dataset, 'progress')}/{name}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        """An idle source ends no batch."""

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        """What was written stays."""
