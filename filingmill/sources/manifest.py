"""Which folder holds each partition of a dataset, commit by commit.

A writer stages new folders aside: all of a dataset, or those of a range of dates. A commit is one small
file that names, for every partition, the version whose folder holds it; partitions outside the range
keep the folder they had, and a date of the range without rows has none. Nothing that a commit names is
ever rewritten, so who reads one keeps its files, and a failed writer or check leaves only folders that
nobody reads.

Writers do not wait for each other. A commit takes the next number; if somebody else took it first, it is
tried again on top of theirs, unless both replace the same dates, which is an error. The number is taken by a
rename that fails if the name is taken, as HDFS has it; where a store lacks that, let one job write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from filingmill.sources.landing import PARTITION, _exists, _file_system, read_text, write_text

COMMITS = "_commits"  # hidden from Spark's readers by its underscore
KEPT = 2
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


class ConflictError(RuntimeError):
    """Another writer replaced the same dates since this one began."""


@dataclass(frozen=True)
class Commit:
    number: int
    version: str  # that was written for it
    folders: dict[str, str]  # partition, as a path below a version, to the version that holds it
    schema: str  # of the files, as JSON
    replaced: tuple[str, str] | None  # first and last date; all partitions if None


@dataclass(frozen=True)
class Staged:
    """What was written, and which commit it was made for."""

    version: str
    folders: tuple[str, ...]
    schema: str
    replaced: tuple[str, str] | None
    parent: int

    def on(self, base: Commit | None) -> Commit:
        """The commit that this makes of another one."""
        kept = {} if base is None else {f: v for f, v in base.folders.items() if not within(f, self.replaced)}
        number = 1 if base is None else base.number + 1
        return Commit(number, self.version, kept | {f: self.version for f in self.folders}, self.schema, self.replaced)


def within(folder: str, dates: tuple[str, str] | None) -> bool:
    """Whether a partition is of a range of dates; rows without a date are of none but the whole."""
    if dates is None:
        return True
    value = folder.rpartition(f"{PARTITION}=")[2]
    return value != NO_DATE and dates[0] <= value <= dates[1]


def overlapping(a: tuple[str, str] | None, b: tuple[str, str] | None) -> bool:
    return a is None or b is None or (a[0] <= b[1] and b[0] <= a[1])


@dataclass(frozen=True)
class Manifest:
    """The commits of a dataset under `base`, whose versions are hive folders by `partition_by`."""

    spark: SparkSession
    base: str
    partition_by: tuple[str, ...] = (PARTITION,)

    # ---- commits ----

    def _commit_path(self, number: int) -> str:
        return f"{self.base}/{COMMITS}/{number:010d}.json"

    def numbers(self) -> list[int]:
        """Of the commits that are kept, in order."""
        return sorted(int(n.removesuffix(".json")) for n in self._names(f"{self.base}/{COMMITS}") if n.endswith(".json"))

    def commit_of(self, number: int) -> Commit:
        values = json.loads(read_text(self.spark, self._commit_path(number)))
        replaced = values.pop("replaced")
        return Commit(**values, replaced=replaced and tuple(replaced))

    def current(self) -> Commit | None:
        """The last commit, None if there is none."""
        numbers = self.numbers()
        return self.commit_of(numbers[-1]) if numbers else None

    # ---- writing ----

    def stage(
        self, write: Callable[[str], None] | None, schema: T.StructType | None, replaced: tuple[str, str] | None = None
    ) -> Staged:
        """Has a new version written; without a writer, the dates are replaced by nothing."""
        base = self.current()
        version = f"v{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        if write is not None:
            write(f"{self.base}/{version}")
        written = T.StructType([f for f in schema if f.name not in self.partition_by]).json() if schema else base.schema
        return Staged(version, tuple(self._leaves(version)), written, replaced, base.number if base else 0)

    def commit(self, staged: Staged) -> Commit:
        """Makes what was staged the data that is read."""
        while True:
            base = self.current()
            since = range(staged.parent + 1, (base.number if base else 0) + 1)
            if any(overlapping(staged.replaced, self.commit_of(n).replaced) for n in since if n in self.numbers()):
                raise ConflictError(f"{self.base}: dates of {staged.version} were replaced by another writer")
            if staged.folders and not _exists(self.spark, f"{self.base}/{staged.version}"):
                raise ConflictError(f"{self.base}: {staged.version} was pruned while it waited")
            made = staged.on(base)
            if self._take(made):
                return made

    def _take(self, commit: Commit) -> bool:
        final, fs = _file_system(self.spark, self._commit_path(commit.number))
        draft, _ = _file_system(self.spark, f"{self.base}/{COMMITS}/draft-{uuid.uuid4().hex}")
        write_text(self.spark, draft.toString(), json.dumps(asdict(commit)))
        if not fs.exists(final) and fs.rename(draft, final):
            return True
        fs.delete(draft, False)
        return False

    def prune(self, kept: int = KEPT) -> list[str]:
        """Forgets all but the last commits and deletes the versions that none of these names; returns
        their names. Versions newer than the oldest commit kept stay, as they may be waiting."""
        numbers = self.numbers()
        if len(numbers) <= kept:
            return []
        for number in numbers[:-kept]:
            path, fs = _file_system(self.spark, self._commit_path(number))
            fs.delete(path, False)
        commits = [self.commit_of(n) for n in numbers[-kept:]]
        used = {v for c in commits for v in c.folders.values()}
        old = [v for v in self.versions() if v not in used and v < commits[0].version]
        for version in old:
            path, fs = _file_system(self.spark, f"{self.base}/{version}")
            fs.delete(path, True)
        return old

    # ---- reading ----

    def read(self, commit: Commit, *partition: str) -> DataFrame:
        """The rows of a commit, of all partitions or those whose path begins with the given folders.

        The folders are read as one scan, whatever the number of versions that they lie in."""
        start = "".join(f"{p}/" for p in partition)
        paths = [f"{self.base}/{v}/{f}" for f, v in sorted(commit.folders.items()) if f.startswith(start)]
        schema = T.StructType.fromJson(json.loads(commit.schema))
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # ---- folders ----

    def versions(self) -> list[str]:
        return sorted(n for n in self._names(self.base) if n.startswith("v"))

    def _names(self, path: str) -> list[str]:
        folder, fs = _file_system(self.spark, path)
        return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []

    def _leaves(self, version: str) -> list[str]:
        found = [""]
        for column in self.partition_by:
            found = [
                f"{f}{n}/" for f in found for n in self._names(f"{self.base}/{version}/{f}") if n.startswith(f"{column}=")
            ]
        return [f.rstrip("/") for f in found]
