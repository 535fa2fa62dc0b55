"""Curated tables in the Spark catalog: ensure, load typed, replace, publish."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingmill.schemas import FRESHNESS
from filingmill.sources.landing import _exists
from filingmill.sources.versions import Versions

BUCKET_ROWS = 5_000_000  # of the widest table, a few hundred megabytes
FRESHNESS_TABLE = "pipeline_freshness"


@dataclass(frozen=True)
class Warehouse:
    """A catalog database whose tables live under `location`.

    A set of tables that belong together is built aside with `begin` and takes the place of the one
    before with `publish`, so readers never meet a half-built or unchecked set. A session whose
    catalog does not know the tables reads the published files.

    A table clustered by one key has as many hash buckets as it has multiples of `bucket_rows`, or
    `buckets` if that is given. Reads that group or window by that key need no shuffle.
    """

    spark: SparkSession
    database: str
    location: str
    buckets: int | None = None
    bucket_rows: int = BUCKET_ROWS
    version: str | None = None

    @property
    def versions(self) -> Versions:
        return Versions(self.spark, self.location)

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def path(self, table: str) -> str:
        return "/".join([self.location, *([self.version] if self.version else []), table])

    def begin(self) -> Warehouse:
        """A warehouse for the next version, with a database of its own."""
        version = self.versions.new()
        return replace(self, database=f"{self.database}_{version.replace('-', '_')}", version=version)

    def publish(self, staged: Warehouse) -> None:
        """Make the tables of a version the ones that are read.

        Its marker is the switch for other sessions. In this one, a name is a view of the table of the
        version, replaced in one step each."""
        self.ensure_database()
        before = self.versions.current()
        self.versions.publish(staged.version)
        for table in self.spark.catalog.listTables(staged.database):
            if table.isTemporary:
                continue
            if self._is_table(table.name):
                self.spark.sql(f"DROP TABLE {self.name(table.name)}")
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.name(table.name)} AS SELECT * FROM {staged.name(table.name)}"
            )
        for version in self.versions.prune():
            if version != before:
                old = f"{self.database}_{version.replace('-', '_')}"
                self.spark.sql(f"DROP DATABASE IF EXISTS `{old}` CASCADE")

    def _is_table(self, table: str) -> bool:
        if not self.spark.catalog.tableExists(f"{self.database}.{table}"):
            return False
        return self.spark.catalog.getTable(f"{self.database}.{table}").tableType != "VIEW"

    def ensure_database(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")

    def ensure_table(self, table: str, schema: T.StructType) -> None:
        """Create an empty table with the declared columns unless it exists."""
        self.ensure_database()
        if not self.exists(table):
            self.replace(table, self.spark.createDataFrame([], schema))

    def _published_path(self, table: str) -> str | None:
        """Where the files of a published table lie that this session's catalog does not know."""
        version = self.version or self.versions.current()
        path = None if version is None else f"{self.versions.path(version)}/{table}"
        return path if path is not None and _exists(self.spark, path) else None

    def _in_catalog(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def exists(self, table: str) -> bool:
        return self._in_catalog(table) or self._published_path(table) is not None

    def table(self, table: str) -> DataFrame:
        if not self._in_catalog(table) and (path := self._published_path(table)):
            return self.spark.read.parquet(path)
        return self.spark.table(self.name(table))

    def replace(
        self,
        table: str,
        df: DataFrame,
        bucket_by: str | None = None,
        sort_by: Sequence[str] = (),
        rows: int | None = None,
        range_by: str | None = None,
    ) -> None:
        """Truncate and load, each file sorted by `sort_by` so reads can skip by its bounds. With
        `range_by`, files hold ranges of a key, so a read from some key on skips whole files.

        A bucketed table is shuffled by the key first, so there is one file per bucket; `rows`, if
        known, saves counting them for the number of buckets.
        """
        self.ensure_database()
        buckets = 0
        if bucket_by:
            buckets = self.buckets or -(-(df.count() if rows is None else rows) // self.bucket_rows) or 1
            arranged = df.repartition(buckets, bucket_by)
        else:
            arranged = df.repartitionByRange(range_by) if range_by else df
            arranged = arranged.sortWithinPartitions(*sort_by) if sort_by else arranged
        writer = arranged.write.format("parquet").mode("overwrite").option("path", self.path(table))
        if bucket_by:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by, *sort_by)
        writer.saveAsTable(self.name(table))


def typed(df: DataFrame, schema: T.StructType, day_format: str = "yyyyMMdd") -> DataFrame:
    """Columns of `schema` in its types; text days are parsed, text that is no day is an error."""
    present = df.schema
    return df.select(
        *(
            F.to_date(field.name, day_format).alias(field.name)
            if isinstance(field.dataType, T.DateType)
            and isinstance(present[field.name].dataType, T.StringType)
            else F.col(field.name).cast(field.dataType).alias(field.name)
            for field in schema.fields
        )
    )


def load_table(
    warehouse: Warehouse,
    table: str,
    cleaned: DataFrame | None,
    schema: T.StructType,
    *,
    day_format: str = "yyyyMMdd",
    bucket_by: str | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """Replace a table by a cleaned dataset in its declared types."""
    if cleaned is None:
        raise RuntimeError(f"nothing cleaned to load into {table}; run the cleaning first")
    warehouse.replace(table, typed(cleaned, schema, day_format), bucket_by, sort_by)


def freshness(fact: DataFrame, published_at: datetime | None = None) -> DataFrame:
    """One row: when, up to which report date, and how many facts. An empty table counts 0."""
    when = published_at or datetime.now(UTC)
    row = fact.agg(F.max("repdte").alias("max_repdte"), F.count("*").alias("financials_row_count"))
    return row.select(F.lit(when).cast("timestamp").alias("published_at"), *row.columns).to(FRESHNESS)


# Settings by which Spark answers a maximum and a count from footers.
_FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def in_footers(spark: SparkSession, path: str) -> Row:
    """`max_repdte` and `financials_row_count` of a table's files. The aggregates are pushed into the scan,
    which takes them from the files' footers and reads no column, however many rows there are."""
    before = {key: spark.conf.get(key, None) for key in _FROM_FOOTERS}
    try:
        for key, value in _FROM_FOOTERS.items():
            spark.conf.set(key, value)
        return _in_footers(spark, path).first()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _in_footers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).agg(F.max("repdte").alias("max_repdte"), F.count("*").alias("financials_row_count"))


def publish_freshness(
    warehouse: Warehouse, table: str, published_at: datetime | None = None
) -> None:
    """The freshness of a stored table, by the footers of its files."""
    found = in_footers(warehouse.spark, warehouse.path(table))
    row = (published_at or datetime.now(UTC), found.max_repdte, found.financials_row_count)
    warehouse.replace(FRESHNESS_TABLE, warehouse.spark.createDataFrame([row], FRESHNESS))
