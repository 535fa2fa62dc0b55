"""Latest-delivery-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingmill.schemas import PROVENANCE


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = PROVENANCE
) -> DataFrame:
    """Keep one row per key: the largest `order` values, nulls last.

    The remaining columns break the last ties, so a rerun keeps the same row whatever order the
    rows arrive in. Rows with a null key form one group. Spark prunes to one row per key before the
    shuffle (WindowGroupLimit), so a key delivered very often still sends one row per map task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranking = [F.col(c).desc_nulls_last() for c in (*order, *rest)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")
