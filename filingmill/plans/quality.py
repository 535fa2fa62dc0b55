"""Data-quality checks. Each returns what is wrong with the data; no row means it passes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingmill.schemas import BANK_CLASSES, STATE_CODES


# ---- single checks -------------------------------------------------------------------------------


def null_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows where any of `columns` is null."""
    return df.filter(reduce(Column.__or__, (F.col(c).isNull() for c in columns)))


def repeated_keys(df: DataFrame, keys: Sequence[str], count: str = "row_count") -> DataFrame:
    """Keys held by more than one row, and by how many. A key with a null is no key."""
    whole = reduce(Column.__and__, (F.col(c).isNotNull() for c in keys))
    return df.filter(whole).groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def unaccepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the accepted ones, and how many rows have them. Null is accepted."""
    outside = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return df.filter(outside).groupBy(column).agg(F.count("*").alias("row_count"))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys that no parent row has, and how many child rows refer to them. Null refers to nothing.

    Child keys are counted before the anti-join, so a key most rows share is one row in it.
    """
    referring = child.filter(F.col(column).isNotNull())
    used = referring.groupBy(column).agg(F.count("*").alias("row_count"))
    known = parent.select(F.col(parent_column).alias(column))
    return used.join(known, column, "left_anti")


def overlapping_windows(versions: DataFrame, touching: bool = False) -> DataFrame:
    """Versions that begin before an earlier version of the same institution has ended.

    Each is reported once with the latest end among the versions that begin before it. One pass
    over each institution's versions in order takes the place of comparing all pairs of them.
    `touching` also reports a version that begins on the day another ends: both bounds belong to a
    window, so a fact of that day would match twice.
    """
    begin = F.unix_date("valid_from")
    earlier = (
        Window.partitionBy("cert").orderBy(begin).rangeBetween(Window.unboundedPreceding, -1)
    )
    collides = F.col("valid_from") < F.col("prior_valid_to")
    if touching:
        collides = F.col("valid_from") <= F.col("prior_valid_to")
    return (
        versions.filter(F.col("cert").isNotNull())
        .select("cert", "valid_from", "valid_to")
        .withColumn("prior_valid_to", F.max("valid_to").over(earlier))
        .filter(collides)
    )


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows a rerun removed or added, with how many copies of each. One grouping of both sides."""
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    net = signed.groupBy(*before.columns).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    return net.select(
        F.when(F.col("_net") > 0, "added").otherwise("removed").alias("change"),
        *before.columns,
        F.abs("_net").alias("copies"),
    )


def fingerprints(df: DataFrame, day: str) -> DataFrame:
    """A digest of all rows of each day that does not depend on their order: their number, and sums of two
    hashes of whole rows. Combined before the shuffle, it is a row for each day and task."""
    row = [F.xxhash64(F.lit(seed), *df.columns).cast("decimal(20,0)") for seed in (1, 2)]
    return df.groupBy(day).agg(
        F.count("*").alias("rows"), *(F.sum(h).cast("string").alias(f"digest_{i}") for i, h in enumerate(row, 1))
    )


def changed_rows_by_day(before: DataFrame, after: DataFrame, day: str) -> DataFrame:
    """`changed_rows` of which only days with unequal fingerprints are compared row by row. The driver gets
    these days, a value for each at most; rows of other days are read, hashed, and not shuffled."""
    after = after.select(before.columns)
    left, right = (fingerprints(df, day) for df in (before, after))
    same = [left[c].eqNullSafe(right[c]) for c in left.columns]
    unequal = left.join(right, reduce(Column.__and__, same), "left_anti").select(day)
    unequal = unequal.unionByName(right.join(left, reduce(Column.__and__, same), "left_anti").select(day)).distinct()
    days = [r[0] for r in unequal.collect()]
    some = F.lit(False)
    if any(d is not None for d in days):
        some = some | F.coalesce(F.col(day).isin([d for d in days if d is not None]), F.lit(False))
    if None in days:
        some = some | F.col(day).isNull()
    return changed_rows(before.filter(some), after.filter(some))


# ---- declared checks over named tables -----------------------------------------------------------


@dataclass(frozen=True)
class NotNull:
    model: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    model: str
    key: tuple[str, ...]


@dataclass(frozen=True)
class Accepted:
    model: str
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    model: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class NoOverlap:
    model: str
    touching: bool = False


Check = NotNull | Unique | Accepted | Reference | NoOverlap

_FACT = "fct_bank_quarterly_financials"

# What is declared of each model.
DECLARED_CHECKS: tuple[Check, ...] = (
    NotNull("dim_institution", ("institution_sk",)),
    NotNull("dim_date", ("date_day",)),
    NotNull(_FACT, ("cert", "repdte", "institution_sk")),
    NotNull("mart_latest_financials", ("cert", "latest_repdte")),
    NotNull("mart_profitability_trends", ("cert",)),
    NotNull("mart_asset_growth", ("cert",)),
    NotNull("mart_deposit_concentration", ("cert", "state")),
    NotNull("stg_institution_history", ("cert", "valid_from", "valid_to")),
    NotNull("stg_financials", ("cert", "repdte")),
    NotNull("stg_branch_deposits", ("cert", "uninumbr", "repdte")),
    Unique("dim_institution", ("institution_sk",)),
    Unique("dim_date", ("date_day",)),
    Unique("mart_latest_financials", ("cert",)),
    Unique(_FACT, ("cert", "repdte")),
    Accepted("dim_institution", "bkclass", BANK_CLASSES),
    Accepted("dim_institution", "state", STATE_CODES),
    Accepted(_FACT, "bkclass", BANK_CLASSES),
    Reference(_FACT, "institution_sk", "dim_institution", "institution_sk"),
    NoOverlap("dim_institution"),
)


def _row_checks(checks: Iterable[Check]) -> list[tuple[str, str, Column]]:
    """`(check, column, failing condition)` of the checks that look at one row at a time."""
    found = []
    for check in checks:
        if isinstance(check, NotNull):
            found += [("not_null", c, F.col(c).isNull()) for c in check.columns]
        elif isinstance(check, Accepted):
            bad = F.col(check.column).isNotNull() & ~F.col(check.column).isin(*check.values)
            found.append(("accepted_values", check.column, bad))
    return found


Counted = tuple[str, str, Column]  # check, subject, number of failures


def _as_rows(counted: DataFrame, model: str, found: Sequence[Counted]) -> DataFrame:
    results = (
        F.struct(
            F.lit(check).alias("check"),
            F.lit(model).alias("model"),
            F.lit(subject).alias("subject"),
            F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
        )
        for check, subject, failures in found
    )
    return counted.select(F.inline(F.array(*results)))


def _one_pass(model: str, df: DataFrame, checks: list[tuple[str, str, Column]], key: Sequence[str] | None) -> DataFrame:
    """All row-wise checks of a table and whether a key is unique, in one pass over it: failures are
    counted per key, which is one exchange, and the counts summed."""
    bad = [F.count_if(condition).alias(f"_{i}") for i, (_, _, condition) in enumerate(checks)]
    found = [(check, column, F.col(f"_{i}")) for i, (check, column, _) in enumerate(checks)]
    if key is None:
        return _as_rows(df.agg(*bad), model, found)
    whole = reduce(Column.__and__, (F.col(c).isNotNull() for c in key))
    by_key = df.groupBy(*key).agg(F.count("*").alias("_rows"), *bad)
    summed = by_key.agg(
        F.count_if(whole & (F.col("_rows") > 1)).alias("_repeated"),
        *(F.sum(f"_{i}").alias(f"_{i}") for i in range(len(checks))),
    )
    return _as_rows(summed, model, [*found, ("unique", ",".join(key), F.col("_repeated"))])


def _counted(failing: DataFrame, check: str, model: str, subject: str) -> DataFrame:
    labels = {"check": check, "model": model, "subject": subject}
    return failing.agg(F.count("*").alias("failures")).select(
        *(F.lit(value).alias(name) for name, value in labels.items()), "failures"
    )


def check_report(
    tables: Mapping[str, DataFrame], checks: Sequence[Check] = DECLARED_CHECKS
) -> DataFrame:
    """One row per check with the number of failures: rows, or keys for unique and references."""
    reports = []
    for model in dict.fromkeys(check.model for check in checks):
        df, own = tables[model], [check for check in checks if check.model == model]
        row_checks = _row_checks(own)
        keys = [check.key for check in own if isinstance(check, Unique)]
        if row_checks or keys:
            reports.append(_one_pass(model, df, row_checks, keys[0] if keys else None))
        reports += [_one_pass(model, df, [], key) for key in keys[1:]]
        for check in own:
            if isinstance(check, Reference):
                lost = orphan_keys(df, check.column, tables[check.parent], check.parent_column)
                reports.append(_counted(lost, "relationships", model, check.column))
            elif isinstance(check, NoOverlap):
                over = overlapping_windows(df, check.touching)
                name = "no_touching_windows" if check.touching else "no_overlapping_windows"
                reports.append(_counted(over, name, model, "valid_from,valid_to"))
    return reduce(DataFrame.unionByName, reports)
