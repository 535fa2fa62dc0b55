"""Column expressions shared by the jobs. All of them run inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def survey_date(year: Column) -> Column:
    """Branch surveys are dated June 30; a missing year gives a missing date."""
    return F.concat(year.cast("string"), F.lit("0630"))


def row_hash(columns: Iterable[str]) -> Column:
    """Change fingerprint of a row; null and empty text are the same value to it."""
    parts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)
    return F.sha2(F.concat_ws("|", *parts), 256)


def surrogate_key(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *(part.cast("string") for part in parts)))


def growth(current: Column, prior: Column) -> Column:
    """Relative change; null when there is no prior value or it is zero."""
    return F.try_divide(current - prior, prior)


def year_quarter(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def parse_day(text: Column, pattern: str) -> Column:
    """Text to date; null instead of an error for text that is no date."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EXACT = "decimal(38,18)"  # holds every bigint and more decimals than a double tells apart


def cast_can_fail(source: T.DataType, target: T.DataType) -> bool:
    """Whether a cast can lose a value. Text targets and widening number casts cannot."""
    if isinstance(target, T.StringType) or source == target:
        return False
    if isinstance(target, T.LongType):
        return not isinstance(source, _WHOLE)
    if isinstance(target, T.DoubleType):
        return not isinstance(source, (*_WHOLE, T.FloatType, T.DecimalType))
    return True


def try_typed(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """The value in the target type, null if it has no such value.

    A whole number may be written as 12.0, as text or as a number; 12.7 is none."""
    if not isinstance(target, T.LongType) or isinstance(source, _WHOLE):
        return value.try_cast(target)
    if isinstance(source, (T.StringType, T.DecimalType)):
        exact = value.try_cast(_EXACT)
    elif isinstance(source, (T.DoubleType, T.FloatType)):
        exact = value
    else:
        return value.try_cast(target)
    return F.when(exact == F.floor(exact), exact.try_cast(target))
