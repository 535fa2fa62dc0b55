"""Typed projections of raw records. Fields outside the allowlist never leave the scan."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingmill.functions.columns import cast_can_fail, parse_day, survey_date, try_typed
from filingmill.schemas import BRANCH_FIELDS, FINANCIALS_FIELDS, PROVENANCE, TRACKED_FIELDS, TYPES

BAD_CAST = "_bad_cast"
BAD_VALUES = "_bad_values"


def typed_fields(
    value: Callable[[str], Column], present: Mapping[str, T.DataType], fields: Mapping[str, str]
) -> tuple[dict[str, Column], Column, Column]:
    """The fields in their types, the names of those whose value has none, and these raw values.

    `value` gives the raw column of a field. The names are comma-joined, the values a JSON object by
    name; both are null when every value fits. A field that is not present comes out null."""
    columns: dict[str, Column] = {}
    names: list[Column] = []
    raw: list[Column] = []
    for field, type_name in fields.items():
        if field not in present:
            columns[field] = F.lit(None).cast(type_name)
            continue
        columns[field] = try_typed(value(field), present[field], TYPES[type_name])
        if cast_can_fail(present[field], TYPES[type_name]):
            failed = value(field).isNotNull() & columns[field].isNull()
            names.append(F.when(failed, F.lit(field.lower())))
            raw.append(F.when(failed, value(field).cast("string")).alias(field.lower()))
    if not names:
        nothing = F.lit(None).cast("string")
        return columns, nothing, nothing
    bad = F.nullif(F.concat_ws(",", *names), F.lit(""))
    return columns, bad, F.when(bad.isNotNull(), F.to_json(F.struct(*raw)))


def project_typed(raw: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Select and cast `fields`, lower-casing their names, and keep provenance.

    A value that does not cast becomes null, its column is named in `_bad_cast` and the value as it
    came is in `_bad_values`, so the row can be rejected without losing it instead of failing the job.
    A field the files of a period lack comes out null.
    """
    present = {f.name: f.dataType for f in raw.schema.fields}
    columns, bad, values = typed_fields(F.col, present, fields)
    stamps = [F.col(c).cast("string").alias(c) for c in PROVENANCE]
    named = (column.alias(field.lower()) for field, column in columns.items())
    return raw.select(*named, *stamps, bad.alias(BAD_CAST), values.alias(BAD_VALUES))


def project_financials(raw: DataFrame) -> DataFrame:
    return project_typed(raw, FINANCIALS_FIELDS)


def project_branches(raw: DataFrame) -> DataFrame:
    """Branch survey rows carry only a year; the report date follows from it."""
    return project_typed(raw, BRANCH_FIELDS).withColumn("repdte", survey_date(F.col("year")))


def project_snapshots(raw: DataFrame, snapshot_date: Column | None = None) -> DataFrame:
    """Institution snapshots: the key, the snapshot day and the tracked attributes.

    The day is that of the partition (`dt`, yyyyMMdd) unless given. A field the files of a day lack
    comes out null; a key or a day that does not cast is null and kept in `_bad_values`.
    """
    present = {f.name: f.dataType for f in raw.schema.fields}
    columns, bad, values = typed_fields(F.col, present, {"CERT": "bigint"})
    day = snapshot_date
    if day is None:
        text_day = F.col("dt").cast("string")
        day = parse_day(text_day, "yyyyMMdd")
        no_day = text_day.isNotNull() & day.isNull()
        bad = F.nullif(F.concat_ws(",", bad, F.when(no_day, "snapshot_date")), F.lit(""))
        cert = F.when(columns["CERT"].isNull(), F.col("CERT").cast("string")) if "CERT" in present else F.lit(None).cast("string")
        raw_values = F.struct(cert.alias("cert"), F.when(no_day, text_day).alias("snapshot_date"))
        values = F.when(bad.isNotNull(), F.to_json(raw_values))

    def text(field: str) -> Column:
        value = F.col(field) if field in raw.columns else F.lit(None)
        return value.cast("string")

    return raw.select(
        columns["CERT"].alias("cert"),
        day.alias("snapshot_date"),
        *(text(field).alias(name) for field, name in TRACKED_FIELDS.items()),
        *(text(stamp).alias(stamp) for stamp in PROVENANCE),
        bad.alias(BAD_CAST),
        values.alias(BAD_VALUES),
    )
