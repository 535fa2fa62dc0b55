"""Validity-window history of institutions from dated snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingmill.functions.columns import row_hash
from filingmill.operators.dedupe import latest_per_key
from filingmill.operators.projection import BAD_CAST, BAD_VALUES
from filingmill.operators.quarantine import rejected, tag_rejects
from filingmill.schemas import LOW_WATER_MARK, OPEN_END, PROVENANCE, TRACKED_FIELDS

_DATED = "cert is not null and snapshot_date is not null"


def build_history(snapshots: DataFrame, low_water_mark: str = LOW_WATER_MARK) -> DataFrame:
    """One row per run of unchanged tracked attributes, with `valid_from`/`valid_to` as ISO text.

    A version is the snapshot that changed something, so the changed rows are kept and each is
    closed the day before the next one; A-B-A gives three versions. The first version reaches back
    to `low_water_mark`, the last stays open and is current.

    One snapshot per institution and day is kept first. That bounds an institution's rows by the
    number of snapshot days, however often one of them was delivered, before they meet in a window.
    Snapshots without a key or a day are left out here; `rejected_snapshots` returns them.
    """
    attributes = list(TRACKED_FIELDS.values())
    order = [c for c in PROVENANCE if c in snapshots.columns]
    daily = latest_per_key(
        snapshots.filter(_DATED).drop(BAD_CAST, BAD_VALUES), ["cert", "snapshot_date"], order
    ).withColumn("_hash", row_hash(attributes))

    by_day = Window.partitionBy("cert").orderBy("snapshot_date")
    previous = F.lag("_hash").over(by_day)
    versions = (
        daily.withColumn("_previous", previous)
        .filter("_previous is null or _previous <> _hash")
        .withColumn("_next", F.lead("snapshot_date").over(by_day))
    )
    return versions.select(
        "cert",
        *attributes,
        F.when(F.col("_previous").isNull(), F.lit(low_water_mark))
        .otherwise(F.col("snapshot_date").cast("string"))
        .alias("valid_from"),
        F.coalesce(F.date_sub("_next", 1).cast("string"), F.lit(OPEN_END)).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
        "_hash",
    )


def rejected_snapshots(snapshots: DataFrame) -> DataFrame:
    """Snapshots that no version can be made of, with the reason: a key or a day that did not cast,
    whose raw values are kept, or none at all."""
    keys = ["cert", "snapshot_date"]
    return rejected(tag_rejects(snapshots, keys))
