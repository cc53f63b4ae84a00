from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from skyledger import registry
from skyledger.operators.clean import clean_messages
from skyledger.operators.means import wide_state_columns
from skyledger.plans import products
from skyledger.session import scratch_path
from skyledger.sources import tables
from skyledger.sources.messages import read_topic_files
from skyledger.streaming import runs
from tests.test_products import GEO, GEOGRAPHY, READING, ROWS, STATION, STATIONS


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame(ROWS, READING)


@pytest.fixture(scope="module")
def source(spark, readings):
    """Seven files, so that a limit of one file per trigger makes seven batches."""
    path = scratch_path(spark, "source")
    readings.repartition(7).write.parquet(path)
    return path


def stream(spark, source, files=1):
    return spark.readStream.schema(READING).option("maxFilesPerTrigger", files).parquet(source)


def every_product(spark):
    geography, stations = spark.createDataFrame(GEOGRAPHY, GEO), spark.createDataFrame(STATIONS, STATION)
    return {
        "temp_gap": products.temp_gap(),
        "continent_prcp": products.continent_prcp(geography),
        "elevation_snow": products.elevation_snow(stations),
        "ml_features": products.ml_features(),
        "bonus": products.bonus_station_month(daily=True),
    }


@pytest.mark.parametrize(
    ("name", "files"),
    [("temp_gap", 1), ("temp_gap", 3), ("continent_prcp", 3), ("elevation_snow", 3),
     ("ml_features", 3), ("bonus", 1)],
)
def test_stream_equals_table(spark, readings, source, name, files):
    product = every_product(spark)[name]
    path, checkpoint = scratch_path(spark, "states"), scratch_path(spark, "checkpoint")
    streamed = runs.run(product, stream(spark, source, files), path, checkpoint)
    whole = sorted(runs.run(product, readings).collect(), key=str)
    assert sorted(streamed.collect(), key=str) == whole
    batches = runs.read_partials(spark, path).filter("batch_id >= 0")
    assert batches.select("batch_id").distinct().count() == -(-7 // files)


def test_replay_and_restart_change_nothing(spark, readings, source):
    product = products.bonus_station_month()
    path, checkpoint = scratch_path(spark, "states"), scratch_path(spark, "checkpoint")
    runs.run_partials(product, stream(spark, source), path, checkpoint)
    before = sorted(product.finish(runs.read_partials(spark, path)).collect())
    runs.run_partials(product, stream(spark, source), path, checkpoint)  # nothing new
    seen = []
    runs.run_batches(
        stream(spark, source), lambda b, e: seen.append((e, b.collect())), scratch_path(spark, "c")
    )
    for epoch, rows in seen[2:4]:
        runs.write_partial(product, spark.createDataFrame(rows, READING), path, epoch)
    assert sorted(product.finish(runs.read_partials(spark, path)).collect()) == before
    assert before == sorted(product.compute(readings).collect())


def test_failed_batch_is_done_again(spark, readings, source):
    product = products.temp_gap()
    path, checkpoint = scratch_path(spark, "states"), scratch_path(spark, "checkpoint")

    def failing(batch, epoch):
        runs.write_partial(product, batch, path, epoch)
        if epoch == 3:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        runs.run_batches(stream(spark, source), failing, checkpoint)
    result = runs.run(product, stream(spark, source), path, checkpoint)
    assert sorted(result.collect()) == sorted(product.compute(readings).collect())


def test_state_store(spark, readings, source):
    variables = ("TMAX", "TMIN")
    rows = stream(spark, source).filter(
        F.col("variable").isin(*variables) & F.col("obs_date").isNotNull()
    )
    states = rows.groupBy(F.year("obs_date").alias("year")).agg(*wide_state_columns(variables))
    path, checkpoint = scratch_path(spark, "complete"), scratch_path(spark, "checkpoint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    runs.run_complete(states, path, checkpoint, partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    product = products.temp_gap()
    latest = runs.read_latest(spark, path, states.schema)
    assert product.present(latest).collect() == product.compute(readings).collect()
    assert len(latest.inputFiles()) <= 3 + 1
    # A batch that is lost half way leaves the one before in force.
    last = max(r["epoch"] for k in (0, 1) for r in spark.read.parquet(f"{path}/committed/{k}").collect())
    assert last == 6
    broken = spark.createDataFrame([(-1, 1)], "epoch long, slot int")
    broken.write.mode("overwrite").parquet(f"{path}/committed/{last % 2}")
    before = product.present(runs.read_latest(spark, path, states.schema))
    assert 0 < before.count() <= latest.count()


def test_streams_without_data_are_empty(spark):
    path = scratch_path(spark, "nothing")
    spark.createDataFrame([], READING).write.parquet(path)
    product = products.temp_gap()
    states, checkpoint = scratch_path(spark, "states"), scratch_path(spark, "checkpoint")
    assert runs.run(product, stream(spark, path), states, checkpoint).collect() == []
    rows = stream(spark, path).groupBy(F.year("obs_date").alias("year"))
    rows = rows.agg(*wide_state_columns(("TMAX", "TMIN")))
    out = scratch_path(spark, "complete")
    runs.run_complete(rows, out, scratch_path(spark, "checkpoint"), partitions=2)
    assert product.present(runs.read_latest(spark, out, rows.schema)).collect() == []


def test_limit_counts_over_batches(spark, source):
    path = scratch_path(spark, "limited")
    rows = stream(spark, source).limit(1000)
    runs.run_append(rows, path, scratch_path(spark, "checkpoint"))
    assert spark.read.parquet(path).count() == 1000


def test_timed_run_ends_between_batches(spark, readings, source):
    product = products.temp_gap()
    path, checkpoint = scratch_path(spark, "states"), scratch_path(spark, "checkpoint")
    cadence = runs.Cadence(every="1 second", seconds=3)
    runs.run_partials(product, stream(spark, source), path, checkpoint, cadence)
    assert not spark.streams.active
    first = runs.read_partials(spark, path)
    assert first.filter("batch_id >= 0").count() > 0
    result = runs.run(product, stream(spark, source), path, checkpoint)  # the rest
    assert sorted(result.collect()) == sorted(product.compute(readings).collect())


def test_messages_as_a_stream(spark):
    path = scratch_path(spark, "topics")
    line = '{{"StationId":"{0}000000001","Date":19870101,"Variable":"TMAX","Value":{1}}}'
    rows = [(t, line.format(t, i)) for i, t in enumerate(["EZ", "US", "CH", "EZ"])] + [("EZ", "junk")]
    messages = spark.createDataFrame(rows, "topic string, value string")
    messages.repartition(3).write.partitionBy("topic").text(path)
    clean = clean_messages(read_topic_files(spark, path, "EZ, CH", True, 1))
    out = scratch_path(spark, "clean")
    runs.run_append(clean, out, scratch_path(spark, "checkpoint"))
    day = datetime.date(1987, 1, 1)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [
        ("CH000000001", day, "TMAX", 2), ("EZ000000001", day, "TMAX", 0), ("EZ000000001", day, "TMAX", 3),
    ]


def test_a_table_of_many_files_streams(spark):
    folder = scratch_path(spark, "tables")
    supplier = spark.range(100).withColumnRenamed("id", "s_suppkey")
    supplier.repartition(5).write.parquet(f"{folder}/supplier.parquet")
    rows = tables.table_stream(spark, folder, "supplier", 2)
    batches = []
    runs.run_batches(rows, lambda b, e: batches.append(b.count()), scratch_path(spark, "checkpoint"))
    assert sum(batches) == 100 and len(batches) == 3


def test_stream_needs_paths(spark, source):
    with pytest.raises(ValueError):
        runs.run(products.temp_gap(), stream(spark, source))


@pytest.mark.parametrize("name", ["continent_prcp", "elevation_snow", "ml_features", "bonus"])
def test_partials_in_a_table_survive_replays(spark, readings, source, monkeypatch, name):
    """The SQL table is played by a folder of appended files, its columns in capitals."""
    folder = scratch_path(spark, "table")

    def read(session, *_):
        rows = session.read.parquet(folder)
        return rows.toDF(*[c.upper() for c in rows.columns])

    def append(df, table, connection, connections):
        df.write.mode("append").parquet(folder)

    monkeypatch.setattr(runs.jdbc, "append_table", append)
    monkeypatch.setattr(runs.jdbc, "read_table", read)
    product = every_product(spark)[name]
    for _ in range(2):  # a second checkpoint replays all batches
        checkpoint = scratch_path(spark, "checkpoint")
        runs.run_partials_to_table(product, stream(spark, source, 3), "t", {}, checkpoint, "r")
    got = runs.finish_table(spark, product, "t", {})
    assert sorted(got.collect(), key=str) == sorted(product.compute(readings).collect(), key=str)


def test_two_runs_in_one_table_add_up(spark, monkeypatch):
    """Each has an epoch 0 of its own."""
    folder = scratch_path(spark, "table")
    monkeypatch.setattr(runs.jdbc, "read_table", lambda session, *_: session.read.parquet(folder))
    monkeypatch.setattr(
        runs.jdbc, "append_table", lambda df, *_: df.write.mode("append").parquet(folder)
    )
    day, product, whole = datetime.date(1990, 1, 1), products.temp_gap(), []
    for name, values in (("EZ", (20, 2)), ("US", (30, 12))):
        rows = [(f"{name}000000001", day, v, x) for v, x in zip(("TMAX", "TMIN"), values, strict=True)]
        whole += rows
        path = scratch_path(spark, "one")
        spark.createDataFrame(rows, READING).coalesce(1).write.parquet(path)
        checkpoint = scratch_path(spark, "checkpoint")
        runs.run_partials_to_table(product, stream(spark, path), "t", {}, checkpoint, name)
    want = product.compute(spark.createDataFrame(whole, READING)).collect()
    assert runs.finish_table(spark, product, "t", {}).collect() == want
    assert [tuple(r) for r in want] == [(1990, 18.0)]


def test_landing_spreads_with_the_input_in_three_batches(spark, monkeypatch):
    landed, batches, given = [], [], tables.table_stream

    def noted(spark, folder, name, files):
        landed.append(len(spark.read.parquet(f"{folder}/{name}.parquet").inputFiles()))
        return given(spark, folder, name, files)

    monkeypatch.setattr(tables, "table_stream", noted)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        whole = tables.table(spark, "/root/testdata/sf0.001", "lineitem")
        tasks = whole.rdd.getNumPartitions()
        rows = registry._lines(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    runs.run_batches(rows, lambda b, e: batches.append(b.count()), scratch_path(spark, "checkpoint"))
    assert 3 < tasks <= landed[0] < tasks + 3
    assert len(batches) == 3 and sum(batches) == whole.count()


@pytest.mark.parametrize("name", ["stream_bytes_bound", "stream_partials_merge"])
def test_landed_files_do_not_grow_with_the_table(spark, monkeypatch, name):
    monkeypatch.setattr(registry, "LANDED_ROWS", 500, raising=False)
    folders = []
    stream = tables.table_stream

    def noted(spark, folder, *args, **kwargs):
        folders.append(folder)
        return stream(spark, folder, *args, **kwargs)

    monkeypatch.setattr(tables, "table_stream", noted)
    found = registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    landed = spark.read.parquet(f"{folders[0]}/lineitem.parquet")
    sizes = landed.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 12 and max(r["count"] for r in sizes) <= 550
    if name == "stream_bytes_bound":
        assert [tuple(r) for r in found] == [(landed.count(), 0, 1)]
