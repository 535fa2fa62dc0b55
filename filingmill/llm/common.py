"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingmill.session import new_folder

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 2500  # of a batch that Spark and a worker hold several times over

_shipped: set[str] = set()


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends there, so a lost executor
    costs a reread of files and never a recomputation of what led to them."""
    folder = new_folder(frame.sparkSession, label)
    frame.write.parquet(folder)
    release_shuffles(frame.sparkSession)
    found = frame.sparkSession.read.schema(frame.schema).parquet(folder)
    found.stored_in = folder
    return found


def discard(*frames: DataFrame) -> None:
    """Deletes the files of stored rows that nothing reads any more: what was made of them is stored too."""
    for frame in frames:
        path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame.stored_in)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Has the driver's garbage collected. Spark deletes the shuffle files of a job once nothing on the
    driver refers to it, which otherwise may be long after its rows are stored and disks are full."""
    spark.sparkContext._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once per application, where they do not have it installed, and
    sees that a batch of texts is not as many rows as one of numbers may be."""
    if int(spark.conf.get(BATCH_ROWS)) > MOST_ROWS:
        spark.conf.set(BATCH_ROWS, MOST_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="filingmill-code-")) / "filingmill_code.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def text_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text, the text as a string that is never null. Whatever else the table
    holds, also columns named like the results, does not travel."""
    return docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


def map_texts(
    rows: DataFrame, schema: str, start: Callable[[], Callable[[list[int], list[str]], dict[str, list]]], chars: int = 8_000_000
) -> DataFrame:
    """Applies a function of (keys, texts) to every Arrow batch and returns its columns.

    `start` runs once per task, so that tables are built and caches kept per task. A batch is cut
    into parts of bounded text size first; one text is never cut.
    """
    ship(rows.sparkSession)
    out = rows.sparkSession.createDataFrame([], schema).schema
    target = _arrow_schema(out)

    def worked(work: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in parts(batch.column(0).to_pylist(), batch.column(1).to_pylist(), chars):
                columns = work(keys, texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) for f in target], schema=target
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from worked(start(), batches)  # whose last batch and tables are free once it has ended
        give_back()

    return rows.mapInArrow(run, out)


def give_back() -> None:
    """Returns to the system what a task has freed: the worker lives on for tasks of other kinds, beside
    which it would keep the memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def rewrite(
    docs: DataFrame, start: Callable[[], Callable[..., tuple[list[bool] | None, dict[str, list]]]], text: str = "text",
    beside: str | None = None, chars: int = 8_000_000,
) -> DataFrame:
    """The rows with some columns replaced and some rows left out, in place: nothing is joined back, so
    rows without a key and rows that share one are no special case.

    A function of the texts (null: empty) returns which rows stay, None for all, and the values of the
    columns it replaces; columns that the table lacks are ignored. The values of a column `beside` the
    text are a second argument."""
    ship(docs.sparkSession)
    target = _arrow_schema(docs.schema)
    names = docs.columns

    def worked(work: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = range(batch.num_rows)
            texts = [t or "" for t in batch.column(names.index(text)).to_pylist()]
            others = batch.column(names.index(beside)).to_pylist() if beside else []
            for some, values in parts(list(rows), texts, chars):
                keep, replaced = work(values, [others[i] for i in some]) if beside else work(values)
                part = batch.slice(some[0], len(some))
                columns = [
                    pa.array(replaced[f.name], f.type) if f.name in replaced else part.column(i)
                    for i, f in enumerate(target)
                ]
                part = pa.RecordBatch.from_arrays(columns, schema=target)
                yield part if keep is None else part.filter(pa.array(keep, pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from worked(start(), batches)  # whose last batch and tables are free once it has ended
        give_back()

    return docs.mapInArrow(run, docs.schema)


def _arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def parts(keys: list, texts: list[str], chars: int = 8_000_000) -> Iterator[tuple[list, list[str]]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield keys[start:i], texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(keys):
        yield keys[start:], texts[start:]


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Memo(dict):
    """A dictionary that fills itself by a function and starts anew at a size, so memory is bounded.

    Only speed depends on what it holds."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key):
        if len(self) >= self.size:
            self.clear()
        value = self[key] = self.make(key)
        return value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
