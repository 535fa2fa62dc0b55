"""Joining facts to the attributes that were valid on their date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def join_as_of(
    facts: DataFrame, versions: DataFrame, key: str, day: str, take: dict[str, str]
) -> DataFrame:
    """Left join each fact to the version of `key` whose window holds `day`, bounds included.

    `take` maps version columns to output names. The equality on the key makes this a hash or
    sort-merge join with the window test as a residual, never a nested loop; Spark broadcasts the
    versions only when their measured size is under its threshold. Deduplicated facts and versions
    hold at most one row per key and day, which bounds the rows one key brings to the join.
    """
    right = versions.select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *(F.col(c).alias(name) for c, name in take.items()),
    )
    matches = (F.col(key) == F.col("_key")) & F.col(day).between(F.col("_from"), F.col("_to"))
    return facts.join(right, matches, "left").drop("_key", "_from", "_to")


def sweep_as_of(
    facts: DataFrame, versions: DataFrame, key: str, day: str, take: dict[str, str]
) -> DataFrame:
    """`join_as_of` by one ordered sweep instead of a comparison of each fact with each version of its key.

    Versions and facts are united, and in order of the day the last beginning or end of a window is carried
    forward, so a key with V versions and F facts costs a sort of V + F rows. The end of a window is an
    event of the day after it, before a beginning of that day; days in a gap have no version. Windows must not
    overlap, as the gate checks; where they do, a fact has the one that began or ended last, not several.
    Facts without a key or a day have none.
    """
    taken = F.struct(*(F.col(c).alias(name) for c, name in take.items()))
    bounded = versions.filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull() & F.col("valid_to").isNotNull())
    begins = bounded.select(key, F.col("valid_from").alias(day), F.lit(1).alias("_kind"), taken.alias("_version"))
    after = F.unix_date("valid_to") + 1  # no date is needed behind the last one
    ends = bounded.select(key, after.alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast(begins.schema["_version"].dataType).alias("_version"))
    events = begins.withColumn("_at", F.unix_date(day)).drop(day).unionByName(ends)
    rows = facts.withColumns({"_at": F.unix_date(day), "_kind": F.lit(2)})
    both = rows.unionByName(events, allowMissingColumns=True)
    in_order = Window.partitionBy(key).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    event = F.when(F.col("_kind") < 2, F.struct(F.col("_version").alias("v")))
    swept = both.withColumn("_last", F.last(event, ignorenulls=True).over(in_order)).filter("_kind = 2")
    known = F.col(key).isNotNull() & F.col(day).isNotNull()
    names = [F.when(known, F.col(f"_last.v.{name}")).alias(name) for name in take.values()]
    return swept.select(*facts.columns, *names)
