"""A table of states that micro-batches add to, in few folders however many there were.

A batch writes its states to a folder of its own. The parts that count are listed in a
manifest, a small file that is written in one step; the newest manifest is in force. So a
batch either counts or does not, and an epoch that a manifest already covers is left out
when it is replayed.

Parts are merged by size: the newest ones that are each no larger than twice what follows
them make one new part, which takes their place in the next manifest. The parts left are
roughly a geometric series: there are as many as the logarithm of all states, reading them
costs about the size of the key space, and a state is rewritten a logarithmic number of
times. A crash before the manifest leaves a folder that nobody reads and a later merge
removes; what the last two manifests name stays, for readers that are under way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.sources import notes

#: Parts of like size that are merged.
FAN = 4

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Part:
    """The states of the epochs ``low`` to ``high``, in a folder of so many bytes."""

    folder: str
    low: int
    high: int
    size: int


@dataclass(frozen=True)
class Snapshot:
    version: int = -1
    run: str | None = None
    parts: tuple[Part, ...] = ()

    @property
    def high(self) -> int:
        """The last epoch that counts; -1 if there is none."""
        return self.parts[-1].high if self.parts else -1


class StateTable:
    """States of one run, merged by ``merge``: any split of them must merge to the same."""

    def __init__(
        self, spark: SparkSession, path: str, run: str, schema: StructType, merge: Merge, fan: int = FAN
    ) -> None:
        self.spark, self.path, self.run, self.schema, self.fan = spark, path, run, schema, fan
        self._merge = merge

    # ---- manifests ----

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifest/{version:012d}"

    def _load(self, version: int) -> Snapshot:
        found = json.loads(notes.read_note(self.spark, self._manifest(version)))
        return Snapshot(version, found["run"], tuple(Part(**p) for p in found["parts"]))

    def snapshot(self) -> Snapshot:
        versions = notes.names_in(self.spark, f"{self.path}/manifest")
        return self._load(int(versions[-1])) if versions else Snapshot()

    def _publish(self, before: Snapshot, parts: Sequence[Part]) -> Snapshot:
        version = before.version + 1
        text = json.dumps({"run": self.run, "parts": [asdict(p) for p in parts]})
        notes.write_note(self.spark, self._manifest(version), text)
        notes.remove(self.spark, self._manifest(version - 2))
        return Snapshot(version, self.run, tuple(parts))

    # ---- states ----

    def _write(self, states: DataFrame, low: int, high: int) -> Part:
        folder = f"{low}-{high}-{uuid.uuid4().hex}"
        states.select(*self.schema.names).write.parquet(f"{self.path}/parts/{folder}")
        return Part(folder, low, high, notes.bytes_of(self.spark, f"{self.path}/parts/{folder}"))

    def _read(self, parts: Sequence[Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/parts/{p.folder}" for p in parts])

    def read(self) -> DataFrame:
        """One state per key."""
        return self._merge(self._read(self.snapshot().parts)).select(*self.schema.names)

    def commit(self, epoch: int, states: DataFrame) -> None:
        """Add the states of an epoch, unless they count already."""
        now = self.snapshot()
        if now.run not in (None, self.run):
            raise ValueError(f"{self.path} has states of another run, {now.run}")
        if epoch <= now.high:
            return
        now = self._publish(now, [*now.parts, self._write(states, epoch, epoch)])
        self._compact(now)

    def due(self, parts: Sequence[Part]) -> int:
        """How many of the newest parts are of like size."""
        size = n = 0
        for part in reversed(parts):
            if n and part.size > 2 * size:
                break
            size += part.size
            n += 1
        return n

    def _compact(self, now: Snapshot) -> None:
        n = self.due(now.parts)
        if n < self.fan:
            return
        kept, merged = now.parts[:-n], now.parts[-n:]
        states = self._merge(self._read(merged))
        after = self._publish(now, [*kept, self._write(states, merged[0].low, merged[-1].high)])
        named = {p.folder for p in (*now.parts, *after.parts)}
        for folder in notes.names_in(self.spark, f"{self.path}/parts"):
            if folder not in named:
                notes.remove(self.spark, f"{self.path}/parts/{folder}")


def newest(keys: Sequence[str], version: str = "epoch") -> Merge:
    """Of the states of a key the one with the highest ``version``."""

    def merge(states: DataFrame) -> DataFrame:
        others = [c for c in states.columns if c not in keys]
        last = F.max_by(F.struct(*others), version).alias("last")
        return states.groupBy(*keys).agg(last).select(*keys, "last.*")

    return merge
