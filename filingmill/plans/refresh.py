"""The whole refresh: raw gate, cleaning, load, models, checks, and publication only if they pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from filingmill.functions.columns import parse_day
from filingmill.operators import marts
from filingmill.operators.projection import (
    BAD_CAST,
    BAD_VALUES,
    project_branches,
    project_financials,
    project_snapshots,
)
from filingmill.operators.quarantine import REASON, clean_tagged
from filingmill.operators.scd2 import build_history, rejected_snapshots
from filingmill.plans import models
from filingmill.plans.quality import DECLARED_CHECKS, Check, NoOverlap, check_report
from filingmill.schemas import (
    BRANCH_FIELDS,
    BRANCH_KEY,
    BRANCHES,
    FINANCIALS,
    FINANCIALS_FIELDS,
    FINANCIALS_KEY,
    HISTORY,
)
from filingmill.session import prepare
from filingmill.sources.drift import read_projected
from filingmill.sources.landing import dataset_path, partition_values, require_raw, write_partitions
from filingmill.sources.manifest import Commit, Manifest, Staged
from filingmill.sources.versions import Versions
from filingmill.sources.warehouse import Warehouse, load_table, publish_freshness
from filingmill.streaming.landing import STREAM_DATASET

OUTCOME = "outcome"
GOOD, BAD = "cleaned", "quarantine"
_BAD_COLUMNS = "_bad_columns"

HISTORY_DATASET, REJECTS_DATASET = "institution_history", "institution_rejects"
HISTORY_TABLE = "cleaned_institution_history"
FINANCIALS_TABLE = "cleaned_financials"
BRANCHES_TABLE = "cleaned_branch_deposits"
FACT_TABLE = "fct_bank_quarterly_financials"

# The declared checks, with the stricter form of the window check.
GATE_CHECKS: tuple[Check, ...] = (*DECLARED_CHECKS, NoOverlap("dim_institution", touching=True))


class ChecksFailedError(RuntimeError):
    """Publication was blocked; `failures` are the rows of the report that count failures."""

    def __init__(self, failures: list[Row]) -> None:
        super().__init__("; ".join(f"{r.check} {r.model}.{r.subject}: {r.failures}" for r in failures))
        self.failures = failures


@dataclass(frozen=True)
class Lake:
    """Where the layers live: `<root>/raw`, `<root>/conformed`, and the warehouse's own location."""

    spark: SparkSession
    root: str
    warehouse: Warehouse

    def raw(self, dataset: str) -> str:
        return dataset_path(self.root, dataset)

    def versions(self, dataset: str) -> Versions:
        return Versions(self.spark, dataset_path(self.root, dataset, "conformed"))

    def manifest(self, dataset: str) -> Manifest:
        return Manifest(self.spark, dataset_path(self.root, dataset, "conformed"), (OUTCOME, "dt"))

    def history(self) -> DataFrame:
        """The history that is read."""
        versions = self.versions(HISTORY_DATASET)
        version = versions.current()
        if version is None:
            raise RuntimeError("no history was built; run the cleaning first")
        return self.spark.read.parquet(versions.path(version))

    def read(self, dataset: str, outcome: str = GOOD, commit: Commit | None = None) -> DataFrame:
        """Good rows or rejects of a conformed dataset, by the last commit or the one given. The outcome is
        a folder, so one is read. What was read stays as it is, whatever is committed later."""
        manifest = self.manifest(dataset)
        commit = commit or manifest.current()
        if commit is None:
            raise RuntimeError(f"nothing cleaned of {dataset}; run the cleaning first")
        rows = manifest.read(commit, f"{OUTCOME}={outcome}")
        return rows.drop(*([REASON, _BAD_COLUMNS, BAD_VALUES] if outcome == GOOD else []))


def _stage_outcomes(
    manifest: Manifest, tagged: DataFrame, cluster_by: Sequence[str], replaced: tuple[str, str] | None
) -> tuple[Staged, dict[str, int]]:
    """Write good rows and rejects in one job, and count both by the footers of what was written.

    Text that is no date goes to the default partition, so bad dates cannot multiply folders.
    """
    is_day = parse_day(F.col("repdte"), "yyyyMMdd").isNotNull()
    rows = tagged.withColumn(OUTCOME, F.when(F.col(REASON).isNull(), GOOD).otherwise(BAD)).withColumn(
        "dt", F.when(is_day, F.col("repdte"))
    )

    def write(path: str) -> None:
        write_partitions(rows, path, [OUTCOME, "dt"], cluster_by=cluster_by, replace_all=True)

    staged = manifest.stage(write, rows.schema, replaced)
    return staged, {o: manifest.read(staged.on(None), f"{OUTCOME}={o}").count() for o in (GOOD, BAD)}


@dataclass(frozen=True)
class Cleaning:
    """How one conformed dataset comes from raw ones."""

    datasets: tuple[str, ...]
    output: str
    project: Callable[[DataFrame], DataFrame]
    fields: Mapping[str, str]
    keys: Sequence[str]
    measure: str

    def tagged(self, lake: Lake, partitions: Mapping[str, Sequence[str]] | None = None) -> DataFrame | None:
        """Good rows and rejects of all raw partitions, or of those named per dataset. All deliveries are
        united before the dedupe, which absorbs repeated ones."""
        parts = [
            read_projected(
                lake.spark,
                lake.raw(name),
                self.project,
                None if partitions is None else partitions[name],
                self.fields,
            )
            for name in self.datasets
        ]
        found = [part for part in parts if part is not None]
        if not found:
            return None
        rows = reduce(DataFrame.unionByName, found)
        tagged = clean_tagged(rows, self.keys, [self.measure], keep_all_rejects=True, text_days=["repdte"])
        return tagged.withColumnRenamed(BAD_CAST, _BAD_COLUMNS)  # which raw values a reject is for


FINANCIALS_CLEANING = Cleaning(
    ("financials", STREAM_DATASET), "financials", project_financials, FINANCIALS_FIELDS, FINANCIALS_KEY, "asset"
)
BRANCHES_CLEANING = Cleaning(
    ("sod",), "branch_deposits", project_branches, BRANCH_FIELDS, BRANCH_KEY, "depsumbr"
)
CLEANINGS = (FINANCIALS_CLEANING, BRANCHES_CLEANING)


def stage_cleaned(
    lake: Lake, cleaning: Cleaning, dates: tuple[str, str] | None = None
) -> tuple[Staged, dict[str, int]]:
    """Clean all of a dataset, or the report dates from the first to the last of `dates`, yyyyMMdd, aside.

    The key contains the report date, so a date's rows depend on the raw partitions of that date
    alone, which are its own by how they are landed. Once committed, every date of the range is replaced as
    good rows and as rejects, also where none are left, and the others stay as they are. Rows without a
    report date are of no range.
    """
    manifest = lake.manifest(cleaning.output)
    if dates is None:
        tagged = cleaning.tagged(lake)
        if tagged is None:
            raise RuntimeError(f"no raw {cleaning.datasets[0]} partitions to clean")
        return _stage_outcomes(manifest, tagged, ["cert"], None)
    if manifest.current() is None:
        raise RuntimeError(f"nothing cleaned of {cleaning.output} yet; clean all dates first")
    first, last = dates
    wanted = {
        name: [v for v in partition_values(lake.spark, lake.raw(name)) if first[: len(v)] <= v <= last[: len(v)]]
        for name in cleaning.datasets
    }
    tagged = cleaning.tagged(lake, wanted)
    if tagged is None:
        return manifest.stage(None, None, dates), {GOOD: 0, BAD: 0}
    return _stage_outcomes(manifest, tagged.filter(F.col("repdte").between(first, last)), ["cert"], dates)


def _commit(lake: Lake, cleaning: Cleaning, staged: Staged) -> None:
    manifest = lake.manifest(cleaning.output)
    manifest.commit(staged)
    manifest.prune()


def clean(lake: Lake, cleaning: Cleaning) -> dict[str, int]:
    """Clean all of a dataset; it is read once it is whole."""
    staged, counts = stage_cleaned(lake, cleaning)
    _commit(lake, cleaning, staged)
    return counts


def clean_dates(lake: Lake, cleaning: Cleaning, first: str, last: str) -> dict[str, int]:
    """Clean the report dates from `first` to `last` again, as `stage_cleaned` has it."""
    staged, counts = stage_cleaned(lake, cleaning, (first, last))
    _commit(lake, cleaning, staged)
    return counts


def clean_financials(lake: Lake) -> dict[str, int]:
    return clean(lake, FINANCIALS_CLEANING)


def clean_branches(lake: Lake) -> dict[str, int]:
    return clean(lake, BRANCHES_CLEANING)


def stage_institutions(lake: Lake) -> tuple[dict[str, str], dict[str, int]]:
    """The history and what no history can be made of, written aside: the version of each, and counts."""
    snapshots = read_projected(lake.spark, lake.raw("institutions"), project_snapshots)
    if snapshots is None:
        raise RuntimeError("no raw institutions partitions to clean")
    outputs = {GOOD: (HISTORY_DATASET, build_history), BAD: (REJECTS_DATASET, rejected_snapshots)}
    versions, counts = {}, {}
    for outcome, (dataset, make) in outputs.items():
        found = lake.versions(dataset)
        versions[dataset] = found.new()
        make(snapshots).write.parquet(found.path(versions[dataset]))
        counts[outcome] = lake.spark.read.parquet(found.path(versions[dataset])).count()  # from the footers
    return versions, counts


def _publish_versions(lake: Lake, versions: Mapping[str, str]) -> None:
    for dataset, version in versions.items():
        lake.versions(dataset).publish(version)
        lake.versions(dataset).prune()


def clean_institutions(lake: Lake) -> dict[str, int]:
    versions, counts = stage_institutions(lake)
    _publish_versions(lake, versions)
    return counts


def load(lake: Lake, warehouse: Warehouse, history: DataFrame, filings: DataFrame, branches: DataFrame) -> None:
    """Cleaned datasets as typed tables."""
    load_table(warehouse, HISTORY_TABLE, history, HISTORY, day_format="yyyy-MM-dd")
    load_table(warehouse, FINANCIALS_TABLE, filings, FINANCIALS)
    load_table(warehouse, BRANCHES_TABLE, branches, BRANCHES)


def stage(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The staging models as temporary views; nothing is stored for them."""
    views = {
        "stg_financials": models.stage_financials(warehouse.table(FINANCIALS_TABLE)),
        "stg_branch_deposits": models.stage_branches(warehouse.table(BRANCHES_TABLE)),
        "stg_institution_history": models.stage_history(warehouse.table(HISTORY_TABLE)),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views


def build_models(warehouse: Warehouse) -> None:
    """Every curated model, each from the stored tables below it."""
    views = stage(warehouse)
    history, filings = views["stg_institution_history"], views["stg_financials"]
    warehouse.replace("dim_institution", models.dim_institution(history), sort_by=["cert"], range_by="cert")
    warehouse.replace("dim_date", models.dim_date(filings))
    # Three marts group the facts by institution; in buckets they do so without a shuffle each.
    warehouse.replace(
        FACT_TABLE,
        models.fct_financials(filings, warehouse.table("dim_institution")),
        bucket_by="cert",
        sort_by=["repdte"],
        rows=filings.count(),  # the join keeps them, and their number is in the file footers
    )
    fact = warehouse.table(FACT_TABLE)
    warehouse.replace("mart_latest_financials", marts.latest_financials(fact), sort_by=["cert"], range_by="cert")
    warehouse.replace(
        "mart_profitability_trends", marts.profitability_trends(fact), sort_by=["cert", "repdte"]
    )
    warehouse.replace("mart_asset_growth", marts.asset_growth(fact), sort_by=["repdte", "cert"])
    warehouse.replace(
        "mart_deposit_concentration",
        marts.deposit_concentration(views["stg_branch_deposits"]),
        sort_by=["state", "cert"],
    )


def checked_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    views = stage(warehouse)
    stored = {check.model for check in GATE_CHECKS} - views.keys()
    return views | {name: warehouse.table(name) for name in stored}


def gate(warehouse: Warehouse, checks: Sequence[Check] = GATE_CHECKS) -> None:
    """Raise if any check fails. The report has one row per check."""
    failures = check_report(checked_tables(warehouse), checks).filter("failures > 0").collect()
    if failures:
        raise ChecksFailedError(failures)


def publish(
    lake: Lake,
    checks: Sequence[Check] = GATE_CHECKS,
    published_at: datetime | None = None,
    cleaned: Mapping[str, Staged] | None = None,
    versions: Mapping[str, str] | None = None,
) -> None:
    """Build the next version of all curated tables of what was staged, and of what is read where nothing
    was; check it, and only then let cleaned data and tables be read.

    If a check fails, or another writer replaced the same dates, what was published before stays as it
    is and is still served, cleaned data too."""
    cleaned, versions = cleaned or {}, versions or {}
    history = lake.history() if HISTORY_DATASET not in versions else lake.spark.read.parquet(
        lake.versions(HISTORY_DATASET).path(versions[HISTORY_DATASET])
    )
    good = {}
    for cleaning in CLEANINGS:
        manifest, staged = lake.manifest(cleaning.output), cleaned.get(cleaning.output)
        good[cleaning.output] = lake.read(cleaning.output, commit=staged and staged.on(manifest.current()))
    tables = lake.warehouse.begin()
    load(lake, tables, history, good[FINANCIALS_CLEANING.output], good[BRANCHES_CLEANING.output])
    build_models(tables)
    gate(tables, checks)
    publish_freshness(tables, FACT_TABLE, published_at)
    for cleaning in CLEANINGS:
        if cleaning.output in cleaned:
            _commit(lake, cleaning, cleaned[cleaning.output])
    _publish_versions(lake, versions)
    lake.warehouse.publish(tables)
    stage(lake.warehouse)


def _refresh(
    lake: Lake, dates: tuple[str, str] | None, checks: Sequence[Check], published_at: datetime | None
) -> dict[str, dict[str, int]]:
    versions, counts = stage_institutions(lake)
    found, cleaned = {"institutions": counts}, {}
    for cleaning in CLEANINGS:
        cleaned[cleaning.output], found[cleaning.output] = stage_cleaned(lake, cleaning, dates)
    publish(lake, checks, published_at, cleaned, versions)
    return found


def refresh(
    lake: Lake, checks: Sequence[Check] = GATE_CHECKS, published_at: datetime | None = None
) -> dict[str, dict[str, int]]:
    """Run every stage in order. A stage that fails stops the run and leaves what it would have
    replaced; rerunning it is safe."""
    prepare(lake.spark)
    require_raw(lake.spark, lake.root)
    return _refresh(lake, None, checks, published_at)


def refresh_dates(
    lake: Lake,
    first: str,
    last: str,
    checks: Sequence[Check] = GATE_CHECKS,
    published_at: datetime | None = None,
) -> dict[str, dict[str, int]]:
    """A refresh after deliveries of the report dates from `first` to `last` only: these are cleaned
    again, snapshots and tables wholly, as a late one changes what follows it."""
    prepare(lake.spark)
    return _refresh(lake, (first, last), checks, published_at)
