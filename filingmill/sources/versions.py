"""Folders that are written whole, checked, and only then read: one per version, with a marker."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from filingmill.sources.landing import _file_system

PUBLISHED = "_PUBLISHED"
KEPT = 2


@dataclass(frozen=True)
class Versions:
    """The versions of something under `base`. Their names sort by time.

    A version counts from the moment its marker exists, which is one file made in one step: until
    then, and if its writer fails, readers see the one before."""

    spark: SparkSession
    base: str

    def new(self) -> str:
        """The name of a version to be written."""
        return f"v{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def path(self, version: str) -> str:
        return f"{self.base}/{version}"

    def _names(self) -> list[str]:
        folder, fs = _file_system(self.spark, self.base)
        if not fs.exists(folder):
            return []
        names = (status.getPath().getName() for status in fs.listStatus(folder))
        return sorted((n for n in names if n.startswith("v")), reverse=True)

    def _is_published(self, version: str) -> bool:
        marker, fs = _file_system(self.spark, f"{self.path(version)}/{PUBLISHED}")
        return fs.exists(marker)

    def current(self) -> str | None:
        """The name of the version published last, None if there is none."""
        return next((v for v in self._names() if self._is_published(v)), None)

    def publish(self, version: str) -> None:
        marker, fs = _file_system(self.spark, f"{self.path(version)}/{PUBLISHED}")
        fs.create(marker, True).close()

    def prune(self, kept: int = KEPT) -> list[str]:
        """Delete all but the last published versions and what is newer; returns the names deleted.

        More than one is kept, as a read that began before the switch may still need it."""
        published = [v for v in self._names() if self._is_published(v)]
        if len(published) <= kept:
            return []
        old = [v for v in self._names() if v < published[kept - 1]]
        for version in old:
            folder, fs = _file_system(self.spark, self.path(version))
            fs.delete(folder, True)
        return old
