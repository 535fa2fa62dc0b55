"""Ranks that do not gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_KEPT = 10_000  # rows that a task keeps for a page
BINS = 64  # of a group, each with about as many distinct values
_NULL_BIN, _NAN_BIN = -2, -1


def _edges(value: Column) -> Column:
    """Quantiles of a group's distinct numbers, ascending; the accuracy is that of ten times as many."""
    number = F.when(~F.isnan(value), value)
    return F.percentile_approx(number, [i / BINS for i in range(1, BINS)], 10 * BINS)


def _bin(value: Column, edges: Column) -> Column:
    """A whole number that never decreases as `value` grows; null lowest, then NaN. Numbers are found among the
    edges by halving: a step is taken if the edge before its end is lower."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range((BINS - 1).bit_length()))))
    below = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) < value, at + step).otherwise(at)
    )
    numbers = F.when(F.isnan(value), F.lit(_NAN_BIN)).otherwise(below)
    return F.coalesce(F.when(value.isNotNull(), numbers), F.lit(_NULL_BIN))


def rank_descending(df: DataFrame, groups: Sequence[str], value: str, output: str) -> DataFrame:
    """`rank() over (partition by groups order by value desc)`, nulls last, for groups of any size.

    A window over `groups` would sort a whole group in one task. Instead the rank is counted: rows
    in higher bins, plus rows with a higher value in the same bin, plus one. Values are counted
    before they are shuffled, so one that very many rows share is a single row by then. Bins are cut
    at quantiles of the group's own distinct values, so however close together these are, a bin has
    its share of them. The quantiles ask for the counts only so that both read one shuffle of them, which
    computes `df` once. Ranks return to the rows by an equality join, which adaptive execution splits
    where one value is hot.
    """
    groups = list(groups)
    counts = df.groupBy(*groups, value).agg(F.count("*").alias("_rows"))
    seen = counts.filter("_rows > 0")
    edges = _prefixed(seen.groupBy(*groups).agg(_edges(F.col(value)).alias("edges")), "_e_")
    counts = counts.join(edges, _same(groups, "_e_")).withColumn("_bin", _bin(F.col(value), F.col("_e_edges")))
    before = (Window.unboundedPreceding, -1)
    in_bin = Window.partitionBy(*groups, "_bin").orderBy(F.col(value).desc()).rowsBetween(*before)
    over_bins = Window.partitionBy(*groups).orderBy(F.col("_bin").desc()).rowsBetween(*before)
    above_in_bin = F.coalesce(F.sum("_rows").over(in_bin), F.lit(0))
    above_bin = F.coalesce(F.sum("_rows").over(over_bins), F.lit(0))

    bins = counts.groupBy(*groups, "_bin").agg(F.sum("_rows").alias("_rows"))
    offsets = _prefixed(bins.select(*groups, "_bin", above_bin.alias("above")), "_o_")
    counted = counts.select(*groups, value, "_bin", above_in_bin.alias("_above"))
    ranks = counted.join(offsets, _same(groups, "_o_") & (F.col("_bin") == F.col("_o__bin"))).select(
        *groups, value, (F.col("_above") + F.col("_o_above") + 1).alias(output)
    )
    ranks = _prefixed(ranks, "_r_", keep=output)
    return df.join(ranks, _same([*groups, value], "_r_")).select(*df.columns, output)


def _prefixed(df: DataFrame, prefix: str, keep: str | None = None) -> DataFrame:
    return df.select(*(F.col(c).alias(c if c == keep else prefix + c) for c in df.columns))


def _same(columns: Sequence[str], prefix: str) -> Column:
    """Equality with the prefixed columns in which null matches null."""
    pairs = (F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns)
    return reduce(Column.__and__, pairs, F.lit(True))


def best_first(value: Column) -> list[Column]:
    """Sort order of a ranking: descending, NaN after numbers, nulls last."""
    return [value.isNull().asc(), F.isnan(value).asc(), value.desc_nulls_last()]


def ranked_page(
    df: DataFrame, value: str, tie_break: str, limit: int, offset: int, most_kept: int = MOST_KEPT
) -> DataFrame:
    """Rows `offset`.. of the ranking by `value`, `limit` of them, with their rank in all of `df`; equal
    values in the order of the whole number `tie_break`, which tells rows apart.

    A rank depends only on rows that sort earlier. So a page near the top is cut from the first
    `offset + limit` rows, which each task keeps; beyond `most_kept` of them the ranks are counted.
    """
    if offset + limit > most_kept:
        return _deep_page(df, value, tie_break, limit, offset)
    order = best_first(F.col(value))
    top = df.orderBy(*order, tie_break).limit(offset + limit)
    ranked = top.withColumn("rank", F.rank().over(Window.orderBy(*order)).cast("bigint"))
    return ranked.orderBy("rank", tie_break).offset(offset).limit(limit)


def _deep_page(df: DataFrame, value: str, tie_break: str, limit: int, offset: int) -> DataFrame:
    """Nothing is gathered up to the page: rows whose value does not reach into it go, and of what is
    left equal values are ranked by the tie-break in the same way. Only the page itself is sorted."""
    ranked = rank_descending(df.withColumn("_all", F.lit(0)), ["_all"], value, "rank")
    last = offset + limit
    sizes = ranked.filter(F.col("rank") <= last).groupBy("rank").agg(F.count("*").alias("size"))
    reached = _prefixed(sizes.filter(F.col("rank") + F.col("size") > offset + 1), "_p_")
    near = ranked.join(reached, F.col("rank") == F.col("_p_rank"))
    tied = rank_descending(near.withColumn("_tie", -F.col(tie_break)), ["rank"], "_tie", "_among")
    position = F.col("rank") + F.col("_among") - 1
    page = tied.filter((position > offset) & (position <= last))
    return page.select(*df.columns, F.col("rank").cast("bigint").alias("rank")).orderBy("rank", tie_break)
