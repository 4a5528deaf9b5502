"""Control tables: a few rows of state with versions, changed by compare and commit."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from amperline.sources.commits import listed, publish_once, read_published


class OutdatedVersion(Exception):
    """Another writer committed the version after the one that was read."""


class ControlTable:
    """A versioned table: every commit writes new rows and then claims the next version.

    The rows of a version are Parquet in a folder of their own; the version is a small
    file naming that folder. A writer says which version it has read. If another one
    was first, its claim fails and nothing changes. Old versions stay readable.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str) -> None:
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def _claim(self, version: int) -> str:
        return f"{self.folder}/versions/{version:012d}.json"

    def version(self) -> int:
        """Number of the newest version, 0 for a table that was never written."""
        names = listed(self.spark, f"{self.folder}/versions")
        return int(names[-1].removesuffix(".json")) if names else 0

    def read(self, version: int | None = None) -> tuple[int, DataFrame]:
        """A version, the newest by default, and its rows."""
        version = self.version() if version is None else version
        if not version:
            return 0, self.spark.createDataFrame([], self.schema)
        claim = read_published(self.spark, self._claim(version))
        if claim is None:
            raise ValueError(f"there is no version {version}")
        return version, self.spark.read.schema(self.schema).parquet(f"{self.folder}/{claim['rows']}")

    def commit(self, rows: DataFrame, after: int, note: dict | None = None) -> int:
        """Write the rows as the version following ``after``, or raise ``OutdatedVersion``."""
        if self.version() != after:
            raise OutdatedVersion(f"version {self.version()} is newer than {after}")
        place = f"rows/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{place}")
        if not publish_once(self.spark, self._claim(after + 1), {"rows": place, **(note or {})}):
            raise OutdatedVersion(f"version {after + 1} was committed by another writer")
        return after + 1

    def note(self, version: int) -> dict:
        """What was written beside the rows of a version."""
        return read_published(self.spark, self._claim(version)) or {}
