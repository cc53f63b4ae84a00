"""A reference table that changes while streams read it.

Every change is a whole new version in a folder of its own; a small file names the folder
once it is written. A micro-batch is bound to the newest version when it is first seen, and
the binding is kept beside the results: a replay of the batch meets the same table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skyledger.sources import notes


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        return [int(n) for n in notes.names_in(self.spark, f"{self.path}/versions")]

    def publish(self, df: DataFrame) -> int:
        """Make ``df`` the newest version."""
        version = max(self.versions(), default=-1) + 1
        folder = f"{version}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/data/{folder}")
        notes.write_note(self.spark, f"{self.path}/versions/{version:012d}", folder)
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """A version of the table, the newest one by default."""
        known = self.versions()
        if not known:
            raise ValueError(f"nothing has been published to {self.path}")
        version = known[-1] if version is None else version
        folder = notes.read_note(self.spark, f"{self.path}/versions/{version:012d}")
        return self.spark.read.parquet(f"{self.path}/data/{folder}")

    def bind(self, bindings: str, epoch: int) -> int:
        """The version of a micro-batch: the one it had before, or else the newest."""
        note = f"{bindings}/{epoch:012d}"
        bound = notes.read_note(self.spark, note)
        if bound is None:
            bound = str(self.versions()[-1])
            notes.write_note(self.spark, note, bound)
        return int(bound)
