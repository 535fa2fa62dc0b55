"""Reading raw datasets whose files do not agree on their types."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingmill.schemas import PROVENANCE
from filingmill.sources.landing import PARTITION, partition_values, recorded_schemas

_LOOKUPS = 16
_CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def _is_conflict(error: PySparkException | Py4JJavaError) -> bool:
    """Whether files of one folder hold a column in types that do not go together."""
    if isinstance(error, Py4JJavaError):
        java = error.java_exception
        while java is not None:
            condition = getattr(java, "getCondition", None)
            if condition is not None and _condition(java) in _CONFLICTS:
                return True
            java = java.getCause()
        return False
    return error.getCondition() in _CONFLICTS


def _condition(java) -> str | None:
    try:
        return java.getCondition()
    except Exception:  # an exception without conditions
        return None


def _footers(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """`(schema, paths)` of one partition: one entry, or one per schema when its files disagree."""
    try:
        return [(spark.read.option("mergeSchema", True).parquet(path).schema, [path])]
    except (PySparkException, Py4JJavaError) as error:
        if not _is_conflict(error):
            raise
    files = spark.read.parquet(path).inputFiles()
    with ThreadPoolExecutor(_LOOKUPS) as pool:
        return list(pool.map(lambda file: (spark.read.parquet(file).schema, [file]), files))


def partition_schemas(
    spark: SparkSession, path: str, partitions: Iterable[str]
) -> list[tuple[T.StructType, list[str]]]:
    """`(schema, paths)` that together are these partitions.

    What the writer recorded is read in one job, however many partitions there are. Only partitions
    without a record, written by other means, have their footers read, one job each.
    """
    recorded = recorded_schemas(spark, path)
    folders = {value: f"{path}/{PARTITION}={value}" for value in partitions}
    found = [(recorded[v], [folder]) for v, folder in folders.items() if v in recorded]
    unknown = [folder for v, folder in folders.items() if v not in recorded]
    if unknown:
        with ThreadPoolExecutor(_LOOKUPS) as pool:
            found += [e for group in pool.map(lambda f: _footers(spark, f), unknown) for e in group]
    return found


def _frames(
    spark: SparkSession, path: str, entries: list[tuple[T.StructType, list[str]]], fields: Iterable[str] | None
) -> list[DataFrame]:
    """One frame per distinct schema of the selected fields; the others do not tell schemas apart."""
    wanted = None if fields is None else {*fields, *PROVENANCE}
    paths_by_schema: dict[str, list[str]] = defaultdict(list)
    for schema, paths in entries:
        kept = sorted(
            (f for f in schema.fields if wanted is None or f.name in wanted), key=lambda f: f.name
        )
        key = T.StructType([T.StructField(f.name, f.dataType) for f in kept]).json()
        paths_by_schema[key] += paths
    return [
        spark.read.schema(T.StructType.fromJson(json.loads(schema)))
        .option("basePath", path)
        .parquet(*paths)
        for schema, paths in paths_by_schema.items()
    ]


def read_projected(
    spark: SparkSession,
    path: str,
    project: Callable[[DataFrame], DataFrame],
    partitions: Iterable[str] | None = None,
    fields: Iterable[str] | None = None,
) -> DataFrame | None:
    """Project the partitions of a raw dataset and union the results; None when there are none.

    `project` casts to one schema, so a field that is whole in one period and text in another does
    not break the read. Partitions that agree on the types of the `fields` that are selected are
    read together: the plan grows with the number of distinct types, not of partitions or of sparse
    fields that nobody selects.
    """
    known = partition_values(spark, path)
    wanted = known if partitions is None else sorted(set(partitions) & set(known))
    if not wanted:
        return None
    frames = _frames(spark, path, partition_schemas(spark, path, wanted), fields)
    return reduce(DataFrame.unionByName, map(project, frames))


def partition_frames(spark: SparkSession, path: str, values: Iterable[str]) -> list[DataFrame]:
    """All fields of some partitions, one frame per schema, whatever their number; none if none exists."""
    wanted = sorted(set(values) & set(partition_values(spark, path)))
    return _frames(spark, path, partition_schemas(spark, path, wanted), None) if wanted else []


def read_partition(spark: SparkSession, path: str, value: str) -> DataFrame | None:
    """All fields of one partition, whatever the types in the others; None if there is none."""
    return read_partitions(spark, path, [value])


def read_partitions(spark: SparkSession, path: str, values: Iterable[str]) -> DataFrame | None:
    """All fields of some partitions; None if there is none. A field that they hold in different types
    is text."""
    frames = partition_frames(spark, path, values)
    if not frames:
        return None
    types: dict[str, set[str]] = defaultdict(set)
    for frame in frames:
        for name, kind in frame.dtypes:
            types[name].add(kind)
    mixed = [name for name, kinds in types.items() if len(kinds) > 1]
    texts = [
        frame.withColumns({c: F.col(c).cast("string") for c in mixed if c in frame.columns})
        for frame in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)


def schema_drift(df: DataFrame, dictionary: dict[str, str]) -> DataFrame:
    """Columns of `df` against a field dictionary (`string` or `number` per name).

    One row per difference - `added` (not in the dictionary), `missing` or `retyped` - with the
    number of rows that hold a value, all counted in one pass. Stamped columns are not compared.
    """
    found = {
        f.name: "number" if isinstance(f.dataType, T.NumericType) else f.dataType.simpleString()
        for f in df.schema.fields
        if not f.name.startswith("_")
    }
    differences = [
        (name, "added" if known is None else "missing" if kind is None else "retyped", known, kind)
        for name in sorted(found.keys() | dictionary.keys())
        for known, kind in [(dictionary.get(name), found.get(name))]
        if known != kind
    ]
    counts = df.agg(
        F.lit(0).cast("bigint").alias("_none"),
        *(F.count(name).alias(name) for name, _, _, kind in differences if kind is not None),
    )
    rows = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(drift).alias("drift"),
            F.lit(known).cast("string").alias("expected"),
            F.lit(kind).cast("string").alias("found"),
            F.col("_none" if kind is None else name).alias("rows"),
        )
        for name, drift, known, kind in differences
    ]
    if not rows:
        empty = "field string, drift string, expected string, found string, rows bigint"
        return df.sparkSession.createDataFrame([], empty)
    return counts.select(F.inline(F.array(*rows)))
