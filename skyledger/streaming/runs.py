"""Streams of readings, and how they end in exact results.

Two ways to aggregate, by the size of the key space:

* few keys (years, continents): Spark's state store, ``run_complete``;
* many keys (station and day): one partial state per micro-batch, written to a
  folder of its own so that a replayed batch overwrites itself, ``run_partials``;
  ``Product.finish`` merges the folders. ``run_merged`` keeps them few over a long run.

``run_update`` takes only the keys that a batch changes from the state store and keeps
the newest state of each.

Either way the checkpoint decides where a restart goes on. A new checkpoint
cuts the input into other batches and needs a new, empty output path.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from skyledger.operators.clean import sorted_messages
from skyledger.operators.means import merge_wide, once_per_batch
from skyledger.plans.products import Ledger, Product
from skyledger.session import materialize
from skyledger.sources import jdbc, notes
from skyledger.sources.files import replace_partitions
from skyledger.sources.versions import VersionedTable
from skyledger.streaming.statetable import FAN, StateTable, newest


class _Idle(StreamingQueryListener):
    """Tells when a query has found no more input."""

    def __init__(self, query: StreamingQuery, done: threading.Event) -> None:
        self._run, self._done = str(query.runId), done

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        if str(event.runId) == self._run:
            self._done.set()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


@dataclass(frozen=True)
class Cadence:
    """What is there now, or every ``every`` until ``seconds`` have passed.

    A timed run also ends after ``batches`` micro-batches, or with ``until_idle`` as soon
    as it finds no more input.
    """

    every: str | None = None
    seconds: float | None = None
    batches: int | None = None
    until_idle: bool = False

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        if self.every is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=self.every).start()

    def wait(self, query: StreamingQuery, done: threading.Event | None = None) -> None:
        """Until the query has ended, ``done`` is set or the time is up."""
        done = done or threading.Event()
        listener = _Idle(query, done) if self.until_idle else None
        streams = SparkSession.active().streams
        if listener:
            streams.addListener(listener)
        end = None if self.seconds is None else time.monotonic() + self.seconds
        try:
            while not done.is_set() and not query.awaitTermination(0.1):
                if end is not None and time.monotonic() > end:
                    break
        finally:
            if listener:
                streams.removeListener(listener)


AVAILABLE_NOW = Cadence()

# Enough for the years, countries and continents that run_complete is meant for.
STATE_PARTITIONS = 16


@contextmanager
def _shuffle_partitions(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """For the start of a query, which copies the settings of its session."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, partitions or before)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    cadence: Cadence = AVAILABLE_NOW,
    output_mode: str = "append",
    partitions: int | None = None,
) -> list[StreamingQueryProgress]:
    """Call ``write(batch, epoch)`` per micro-batch. It may see an epoch twice.

    Returns the progress of the last batches, as many as the session keeps. When the time is up the batch being written is finished first, and no batch
    is written after this returns.
    """
    gate = threading.Lock()
    done = threading.Event()
    closed = False
    n = 0

    def guarded(batch: DataFrame, epoch: int) -> None:
        nonlocal closed, n
        with gate:
            if closed:
                raise RuntimeError("the stream is stopping; the batch is left for the next start")
            write(batch, epoch)
            n += 1
            if n == cadence.batches:
                closed = True
                done.set()

    writer = stream.writeStream.outputMode(output_mode).foreachBatch(guarded)
    with _shuffle_partitions(stream.sparkSession, partitions):
        query = cadence.start(writer.option("checkpointLocation", checkpoint))
    try:
        cadence.wait(query, done)
    finally:
        with gate:
            closed = True
        query.stop()
    return list(query.recentProgress)


def run_append(
    stream: DataFrame, path: str, checkpoint: str, cadence: Cadence = AVAILABLE_NOW
) -> None:
    """Append rows to Parquet files, each exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    query = cadence.start(writer.option("checkpointLocation", checkpoint))
    try:
        cadence.wait(query)
    finally:
        query.stop()


def run_partials(
    product: Product | Ledger,
    readings: DataFrame,
    path: str,
    checkpoint: str,
    cadence: Cadence = AVAILABLE_NOW,
) -> None:
    """One folder of partial states per micro-batch, and an empty one from the start."""

    def write(batch: DataFrame, epoch: int) -> None:
        write_partial(product, batch, path, epoch)

    nothing = readings.sparkSession.createDataFrame([], product.partial(readings).schema)
    nothing.write.mode("overwrite").parquet(f"{path}/batch_id=-1")
    run_batches(readings, write, checkpoint, cadence)


def write_partial(product: Product | Ledger, batch: DataFrame, path: str, epoch: int) -> None:
    product.partial(batch).write.mode("overwrite").parquet(f"{path}/batch_id={epoch}")


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def run_states(
    stream: DataFrame,
    partial: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    cadence: Cadence = AVAILABLE_NOW,
    fan: int = FAN,
) -> StateTable:
    """States of micro-batches in a table that merges them as it grows.

    ``partial`` makes the states of a batch, and ``merge`` adds up those of any batches. A
    checkpoint is the name of its run.
    """
    table = StateTable(stream.sparkSession, path, checkpoint, partial(stream).schema, merge, fan)

    def write(batch: DataFrame, epoch: int) -> None:
        table.commit(epoch, partial(batch))

    run_batches(stream, write, checkpoint, cadence)
    return table


def run_merged(
    product: Product | Ledger,
    readings: DataFrame,
    path: str,
    checkpoint: str,
    cadence: Cadence = AVAILABLE_NOW,
    fan: int = FAN,
) -> StateTable:
    """Partial states of a product, as few folders of them as their size asks for."""
    if any(n.startswith("batch_id=") for n in notes.names_in(readings.sparkSession, path)):
        raise ValueError(f"{path} has one folder per batch, of a run that did not merge them")
    return run_states(readings, product.partial, product.combine, path, checkpoint, cadence, fan)


def run_update(
    states: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    cadence: Cadence = AVAILABLE_NOW,
    partitions: int | None = None,
    fan: int = FAN,
) -> StateTable:
    """The newest state of every key of an aggregated stream.

    The state store hands over the keys that a batch has changed, with their whole state, so
    a batch writes as many rows as it changes keys. Each carries its epoch as a version.
    """
    schema = StructType([*states.schema.fields]).add("epoch", "long")
    table = StateTable(states.sparkSession, path, checkpoint, schema, newest(keys), fan)

    def write(batch: DataFrame, epoch: int) -> None:
        table.commit(epoch, batch.withColumn("epoch", F.lit(epoch).cast("long")))

    run_batches(states, write, checkpoint, cadence, "update", partitions)
    return table


def run_as_of(
    product_of: Callable[[DataFrame], Product],
    dimension: VersionedTable,
    readings: DataFrame,
    path: str,
    checkpoint: str,
    cadence: Cadence = AVAILABLE_NOW,
) -> DataFrame:
    """A product whose dimension may change between micro-batches.

    Each batch is joined with the version that is the newest when it is first seen, so its
    states are kept by the keys of the result.
    """
    spark = readings.sparkSession
    product = product_of(dimension.read())
    schema = product.merge(product.partial(readings)).schema

    def add_up(states: DataFrame) -> DataFrame:
        return merge_wide(states, product.keys, product.variables)

    table = StateTable(spark, f"{path}/states", checkpoint, schema, add_up)

    def write(batch: DataFrame, epoch: int) -> None:
        then = product_of(dimension.read(dimension.bind(f"{path}/versions", epoch)))
        table.commit(epoch, then.merge(then.partial(batch)))

    run_batches(readings, write, checkpoint, cadence)
    return product.present(table.read())


def run_partitions(
    product: Product,
    readings: DataFrame,
    path: str,
    checkpoint: str,
    columns: Sequence[str],
    cadence: Cadence = AVAILABLE_NOW,
) -> None:
    """The product in a folder per value of ``columns``, of which a batch writes only those
    that it changes. A replay makes the same folders of the same states.

    ``columns`` are keys of the product.
    """
    schema = product.partial(readings).schema
    table = StateTable(readings.sparkSession, f"{path}/states", checkpoint, schema, product.combine)

    def write(batch: DataFrame, epoch: int) -> None:
        states = materialize(product.partial(batch), "partial")
        table.commit(epoch, states)
        changed = product.merge(states).select(*columns).distinct()
        whole = product.merge(table.read()).join(changed, list(columns), "left_semi")
        replace_partitions(product.present(whole), f"{path}/result", *columns)

    run_batches(readings, write, checkpoint, cadence)


#: What becomes of a message.
OUTCOMES = ("kept", "flagged", "unparsable")


def run_sorted(
    messages: DataFrame, path: str, checkpoint: str, cadence: Cadence = AVAILABLE_NOW
) -> None:
    """Clean readings under ``status=kept``, and what is left out beside them, by reason.

    A batch parses its messages once and writes a folder of its own, which a replay
    overwrites; its numbers of messages, observed as they pass, are noted under ``counts``.
    """
    spark = messages.sparkSession

    def write(batch: DataFrame, epoch: int) -> None:
        seen = Observation()
        columns = [F.count(F.when(F.col("status") == s, 1)).alias(s) for s in OUTCOMES]
        rows = sorted_messages(batch).observe(seen, F.count(F.lit(1)).alias("read"), *columns)
        folder = f"{path}/messages/epoch={epoch}"
        rows.write.mode("overwrite").partitionBy("status").parquet(folder)
        note = f"{path}/counts/{epoch:012d}"
        notes.remove(spark, note)
        notes.write_note(spark, note, json.dumps(seen.get))

    run_batches(messages, write, checkpoint, cadence)


def message_counts(spark: SparkSession, path: str) -> DataFrame:
    """Of each batch of ``run_sorted``: messages read, kept, flagged and unparsable."""
    found = []
    for name in notes.names_in(spark, f"{path}/counts"):
        counts = json.loads(notes.read_note(spark, f"{path}/counts/{name}"))
        found.append((int(name), *[counts.get(c, 0) for c in ("read", *OUTCOMES)]))
    columns = ", ".join(f"{c} long" for c in ("epoch", "read", *OUTCOMES))
    return spark.createDataFrame(found, columns)


def run_partials_to_table(
    product: Product,
    readings: DataFrame,
    table: str,
    connection: dict[str, str],
    checkpoint: str,
    run_id: str,
    cadence: Cadence = AVAILABLE_NOW,
    connections: int = jdbc.CONNECTIONS,
) -> None:
    """Partial states into a SQL table, each row with the run and batch it comes from.

    An append cannot be taken back, so a replayed batch repeats its rows;
    ``finish_table`` counts a (run, batch, key) once. Batches are numbered from 0 by
    every checkpoint: ``run_id`` stays the same when a run is replayed, and is a new one
    for other topics, another batch size or any other cut of the input.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        states = product.partial(batch).withColumns(
            {"run_id": F.lit(run_id), "batch_id": F.lit(epoch).cast("bigint")}
        )
        jdbc.append_table(states, table, connection, connections)

    run_batches(readings, write, checkpoint, cadence)


def finish_table(
    spark: SparkSession,
    product: Product,
    table: str,
    connection: dict[str, str],
    split: jdbc.Split | None = None,
) -> DataFrame:
    states = jdbc.read_table(spark, table, connection, split)
    return product.finish(once_per_batch(states, product.grain, product.variables))


def run_complete(
    states: DataFrame,
    path: str,
    checkpoint: str,
    cadence: Cadence = AVAILABLE_NOW,
    partitions: int = STATE_PARTITIONS,
) -> None:
    """Write the whole of a small aggregated stream after every micro-batch.

    Every state partition costs a task and files per batch, and a few keys need
    few. The number is fixed when a checkpoint is made.

    Epochs take turns in two folders, so the last whole one is there whatever happens
    to the next, and older ones go. A folder is in force only while its mark is.
    """
    spark = states.sparkSession

    def mark(slot: int, epoch: int, mode: str = "overwrite") -> None:
        row = spark.createDataFrame([(epoch, slot)], _MARK).coalesce(1)
        row.write.mode(mode).parquet(f"{path}/committed/{slot}")

    def write(batch: DataFrame, epoch: int) -> None:
        slot = epoch % 2
        mark(slot, -1)
        batch.write.mode("overwrite").parquet(f"{path}/states/{slot}")
        mark(slot, epoch)

    for slot in (0, 1):
        mark(slot, -1, "ignore")
    run_batches(states, write, checkpoint, cadence, "complete", partitions)


_MARK = "epoch long, slot int"


def read_latest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The states of the last whole epoch of ``run_complete``; none if there is none yet."""
    marks = spark.read.schema(_MARK).parquet(*[f"{path}/committed/{slot}" for slot in (0, 1)])
    last = max(marks.collect(), key=lambda r: r["epoch"], default=None)
    if last is None or last["epoch"] < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/states/{last['slot']}")


def run(
    product: Product | Ledger,
    readings: DataFrame,
    path: str | None = None,
    checkpoint: str | None = None,
    cadence: Cadence = AVAILABLE_NOW,
    merged: bool = False,
) -> DataFrame:
    """The product of a table or of a stream, whichever ``readings`` is.

    With ``merged`` the partial states of a stream are merged as they become many.
    """
    if not readings.isStreaming:
        return product.compute(readings)
    if path is None or checkpoint is None:
        raise ValueError("a stream needs a path for its partial states and a checkpoint")
    if merged:
        return product.finish(run_merged(product, readings, path, checkpoint, cadence).read())
    run_partials(product, readings, path, checkpoint, cadence)
    return product.finish(read_partials(readings.sparkSession, path))
