"""The raw layer: landed pages in, provenance-stamped hive partitions out."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingmill.schemas import PROVENANCE, REQUIRED_RAW

PARTITION = "dt"
_JOB = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")
MOST_SHORT = 1000  # incomplete sources that a report lists; all of them are left out


def page_schema(record: T.StructType) -> T.StructType:
    """A landed page: `{"meta": {"total": n}, "data": [{"data": record, "score": x}, ...]}`."""
    item = T.StructType().add("data", record).add("score", T.DoubleType())
    meta = T.StructType().add("total", T.LongType())
    return T.StructType().add("meta", meta).add("data", T.ArrayType(item))


def read_pages(
    spark: SparkSession, path: str, record: T.StructType | None = None, page_per_file: bool = True
) -> DataFrame:
    """Landed pages, one JSON document per file or per line; hive folders become columns.

    A page holds at most the interface's page size, so one is a small unit of work. Without a
    `record` schema the fields are inferred, which keeps every field any record has but reads the
    pages twice.
    """
    reader = spark.read if record is None else spark.read.schema(page_schema(record))
    return reader.option("multiLine", page_per_file).json(path)


def unwrap_pages(pages: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """One row per record of every page; nothing depends on the order of the pages."""
    return pages.select(*keep, F.explode("data").alias("_item")).select(*keep, "_item.data.*")


def incomplete_pages(pages: DataFrame, source: Iterable[str]) -> DataFrame:
    """Sources whose pages hold another number of records than they announce."""
    seen = F.sum(F.coalesce(F.size("data"), F.lit(0))).cast("bigint")
    return (
        pages.groupBy(*source)
        .agg(F.max("meta.total").alias("announced"), seen.alias("received"))
        .filter("announced is null or announced <> received")
    )


def stamp_raw(
    records: DataFrame,
    *,
    source_url: str | Column,
    batch_id: str | None = None,
    ingested_at: datetime | str | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Stamp how these records arrived.

    A record's own `_ingested_at`/`_batch_id` stay, so a replayed copy never outranks its original;
    `_source_url` and `extra` always describe this arrival. The batch id is one value chosen here,
    not one per row, so a retried task stamps the same.
    """
    when = ingested_at or datetime.now(UTC)
    values = {
        "_ingested_at": when if isinstance(when, str) else when.isoformat(),
        "_batch_id": batch_id or uuid.uuid4().hex,
    }
    stamps = {
        name: F.coalesce(F.col(name).cast("string"), F.lit(values[name]))
        if name in records.columns
        else F.lit(values[name])
        for name in PROVENANCE
    }
    url = source_url if isinstance(source_url, Column) else F.lit(source_url)
    return records.withColumns({**stamps, "_source_url": url, **(extra or {})})


def union_of_fields(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of records that do not share their fields; what one lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str] = (PARTITION,),
    *,
    cluster_by: Iterable[str] = (),
    replace_all: bool = False,
) -> None:
    """Write hive partitions in one job, replacing the partitions the rows belong to.

    Partitions without new rows stay as they are, so an empty delivery changes nothing, unless
    `replace_all` makes this the whole dataset. The rebalance groups rows by partition and splits a
    partition that is large into several files of the advisory size, so no single task writes it.
    """
    parts = list(partition_by)
    arranged = df.hint("rebalance", *parts).sortWithinPartitions(*parts, *cluster_by)
    mode = "static" if replace_all else "dynamic"
    (
        arranged.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*parts)
        .parquet(path)
    )


def _schema_folder(path: str) -> str:
    """Hidden from readers of the dataset, as its name begins with an underscore."""
    return f"{path}/_schemas"


def _jobs(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """By partition, the write jobs its files are from: Spark puts a job's number into their names."""
    folder, fs = _file_system(spark, path)
    found: dict[str, set[str]] = {}
    if fs.exists(folder):
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(f"{PARTITION}="):
                files = (f.getPath().getName() for f in fs.listStatus(status.getPath()))
                jobs = {m.group() if (m := _JOB.search(f)) else f for f in files if not f.startswith(("_", "."))}
                found[name.removeprefix(f"{PARTITION}=")] = jobs
    return found


def _records(spark: SparkSession, path: str) -> dict[str, str]:
    """By write job, where the schema it wrote is recorded."""
    folder, fs = _file_system(spark, _schema_folder(path))
    if not fs.exists(folder):
        return {}
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return {name.removesuffix(".json"): f"{_schema_folder(path)}/{name}" for name in names if name.endswith(".json")}


def recorded_schemas(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """The schema each partition was written with, where all its files are of one write job that recorded
    it. Files are listed, none is read but the records, one for each job."""
    records = _records(spark, path)
    schemas: dict[str, T.StructType] = {}
    found = {}
    for value, jobs in _jobs(spark, path).items() if records else ():
        if len(jobs) == 1 and (job := next(iter(jobs))) in records:
            if job not in schemas:
                schemas[job] = T.StructType.fromJson(json.loads(read_text(spark, records[job])))
            found[value] = schemas[job]
    return found


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text, read by the driver from wherever Spark's paths reach."""
    file, fs = _file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    file, fs = _file_system(spark, path)
    stream = fs.create(file, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def write_recorded(df: DataFrame, path: str) -> None:
    """`write_partitions`, with the schema recorded for the files of this write. The rows are evaluated once.

    A record is of a write job and holds for the files that bear its number, so a write that fails half
    way, or one by other means, leaves partitions that are read by their footers. Records of jobs of which
    no file is left are deleted. If another job wrote meanwhile, it is not known whose files are whose, and
    none is recorded.
    """
    spark = df.sparkSession
    before = set().union(*_jobs(spark, path).values())
    write_partitions(df, path)
    after = set().union(*_jobs(spark, path).values())
    written = after - before
    if len(written) == 1:
        write_text(spark, f"{_schema_folder(path)}/{written.pop()}.json", df.drop(PARTITION).schema.json())
    for job, record in _records(spark, path).items():
        if job not in after:
            file, fs = _file_system(spark, record)
            fs.delete(file, False)


def land(
    records: DataFrame,
    root: str,
    dataset: str,
    partition: Column,
    **stamps,
) -> None:
    """Stamp records and write them to their partitions of a raw dataset."""
    stamped = stamp_raw(records, **stamps).withColumn(PARTITION, partition.cast("string"))
    write_recorded(stamped, dataset_path(root, dataset))


def ingest_pages(
    spark: SparkSession,
    pages_path: str,
    root: str,
    dataset: str,
    partition: str,
    *,
    record: T.StructType | None = None,
    page_per_file: bool = True,
    require_complete: bool = True,
    **stamps,
) -> list[Row]:
    """Land every record of the pages in the partition its field `partition` names.

    Sources that announced another number of records than arrived are known before anything is
    written: with `require_complete` their pages are not landed, so an incomplete delivery replaces no
    partition. The first `MOST_SHORT` of them are returned, one row each, in order. Pages without a
    source folder count as one source.
    """
    pages = read_pages(spark, pages_path, record, page_per_file)
    source = ["source"] if "source" in pages.columns else []
    short = incomplete_pages(pages, source)
    found = short.orderBy(*source).limit(MOST_SHORT).collect()
    if found and require_complete and not source:
        return found
    whole = pages
    if found and require_complete:
        whole = pages.join(short.select(*source), source, "left_anti")
    land(unwrap_pages(whole), root, dataset, F.col(partition), **stamps)
    return found


def dataset_path(root: str, dataset: str, layer: str = "raw") -> str:
    return f"{root}/{layer}/{dataset}"


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    folder, fs = _file_system(spark, path)
    return fs.exists(folder)


def partition_values(spark: SparkSession, path: str) -> list[str]:
    """Sorted `dt` values of a dataset, empty when there is none. Lists folders, reads no file."""
    folder, fs = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    prefix = f"{PARTITION}="
    return sorted(name.removeprefix(prefix) for name in names if name.startswith(prefix))


def missing_datasets(
    spark: SparkSession, root: str, required: Iterable[str] = REQUIRED_RAW
) -> list[str]:
    """Required raw datasets that have no partition at all."""
    return [name for name in required if not partition_values(spark, dataset_path(root, name))]


def require_raw(spark: SparkSession, root: str, required: Iterable[str] = REQUIRED_RAW) -> None:
    missing = missing_datasets(spark, root, required)
    if missing:
        raise RuntimeError(f"raw layer has no partitions for: {', '.join(missing)}")


def quarter_ends(first: str, last: str) -> list[str]:
    """Quarter ends from `first` to `last`, yyyyMMdd, bounds included."""
    years = range(int(first[:4]), int(last[:4]) + 1)
    ends = (f"{year}{day}" for year in years for day in ("0331", "0630", "0930", "1231"))
    return [end for end in ends if first <= end <= last]


def survey_years(first: str, last: str) -> list[int]:
    """Years from `first` to `last`, which begin with a year, bounds included."""
    return list(range(int(first[:4]), int(last[:4]) + 1))


def missing_periods(spark: SparkSession, root: str, first: str, last: str) -> list[tuple[str, str]]:
    """`(dataset, partition)` of the quarters and survey years from `first` to `last`, yyyyMMdd, that were
    not landed. Lists folders, reads no file."""
    wanted = {"financials": quarter_ends(first, last), "sod": [str(y) for y in survey_years(first, last)]}
    landed = {name: set(partition_values(spark, dataset_path(root, name))) for name in wanted}
    return [(name, value) for name, values in wanted.items() for value in values if value not in landed[name]]


def within_periods(raw: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of the partitions from `first` to `last`; the filter prunes the others.

    Yearly partitions are compared by their year.
    """
    dt = F.col(PARTITION).cast("string")
    yearly = F.length(dt) == 4
    return raw.filter(
        F.when(yearly, dt.between(first[:4], last[:4])).otherwise(dt.between(first, last))
    )
