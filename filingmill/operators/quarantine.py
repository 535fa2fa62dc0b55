"""Rejecting rows with a recorded reason instead of dropping them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.functions.columns import parse_day
from filingmill.operators.dedupe import latest_per_key
from filingmill.operators.projection import BAD_CAST, BAD_VALUES, project_branches, project_financials
from filingmill.schemas import BRANCH_KEY, FINANCIALS_KEY

REASON = "_reject_reason"


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def tag_rejects(
    df: DataFrame,
    keys: Sequence[str],
    non_negative: Sequence[str] = (),
    text_days: Sequence[str] = (),
) -> DataFrame:
    """Add `_reject_reason`, null for a good row.

    In order: `bad_cast` (a raw value did not fit its type, or a `text_days` column is no date),
    `missing_key`, `negative_value`. Null and NaN measures are good.
    """
    bad = [F.col(c).isNotNull() & parse_day(F.col(c), "yyyyMMdd").isNull() for c in text_days]
    if BAD_CAST in df.columns:
        bad.append(F.col(BAD_CAST).isNotNull())
    reason = (
        F.when(_any(bad), "bad_cast")
        .when(_any([F.col(c).isNull() for c in keys]), "missing_key")
        .when(_any([F.col(c) < 0 for c in non_negative]), "negative_value")
    )
    return df.withColumn(REASON, reason)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON, BAD_CAST, BAD_VALUES)


def rejected(tagged: DataFrame) -> DataFrame:
    """Rejects with their reason, and with the values that did not cast as they came."""
    return tagged.filter(F.col(REASON).isNotNull()).drop(BAD_CAST)


def quarantine_split(
    df: DataFrame, keys: Sequence[str], non_negative: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """`(good, rejected)` views over one tagged frame."""
    tagged = tag_rejects(df, keys, non_negative)
    return accepted(tagged), rejected(tagged)


def clean_tagged(
    projected: DataFrame,
    keys: Sequence[str],
    non_negative: Sequence[str],
    *,
    keep_all_rejects: bool = False,
    text_days: Sequence[str] = (),
) -> DataFrame:
    """Deduplicate, then tag.

    By default keyless rows that agree on the rest of the key collapse to one. A key whose raw value
    did not cast is not missing: such rows skip the dedupe, so that different bad keys never collapse.
    With `keep_all_rejects` all rows without a whole key do: each is kept and reported, and they are
    never shuffled into one group.
    """
    keyless = _any([F.col(c).isNull() for c in keys])
    if not keep_all_rejects:
        if BAD_CAST not in projected.columns:
            return tag_rejects(latest_per_key(projected, keys), keys, non_negative, text_days)
        keyless = keyless & F.col(BAD_CAST).isNotNull()
    whole = latest_per_key(projected.filter(~keyless), keys)
    return tag_rejects(
        whole.unionByName(projected.filter(keyless)), keys, non_negative, text_days
    )


def _cleaner(project: Callable[[DataFrame], DataFrame], keys: Sequence[str], measure: str):
    def clean(raw: DataFrame, *, keep_all_rejects: bool = False) -> tuple[DataFrame, DataFrame]:
        tagged = clean_tagged(project(raw), keys, [measure], keep_all_rejects=keep_all_rejects)
        return accepted(tagged), rejected(tagged)

    return clean


clean_financials = _cleaner(project_financials, FINANCIALS_KEY, "asset")
clean_branches = _cleaner(project_branches, BRANCH_KEY, "depsumbr")
