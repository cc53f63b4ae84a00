from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.operators.geography import one_row_per_code, split_codes
from skyledger.schemas import INVENTORY_FIELDS, STATION_FIELDS
from skyledger.sources import files, jdbc, messages, text
from skyledger.session import scratch_path



def place(**at):
    """A line with texts at the given columns: place(c0="ab", c5="cd")."""
    line = ""
    for column, value in at.items():
        line = line.ljust(int(column[1:])) + value
    return line


LINES = [
    place(c0="ACW00011604", c13="17.1167", c22="-61.7833", c33="10.1", c41="ST JOHNS COOLIDGE FLD"),
    place(c0="CA001010066", c13="48.8667", c21="-123.2833", c34="4.0", c38="BC", c41="ACTIVE PASS"),
    place(c0="CA001010235", c13="48.4000", c21="-123.4833", c33="17.0", c38="BC", c76="HCN"),
    place(c0="USC00000001", c31="-999.9"),
    place(c0="USC00000002", c13="40.0000"),
    place(c0="USC00000003", c13="4x.0000", c22="-90.0000", c33="12.5", c72="GSN", c80="72000"),
]


def write_lines(spark, lines):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    return path


def test_station_lines(spark):
    rows = {r["station_id"]: r for r in text.read_stations(spark, write_lines(spark, LINES)).collect()}
    assert len(rows) == len(LINES)  # the first line is data as well
    first = rows["ACW00011604"]
    assert (first["latitude"], first["longitude"], first["elevation"]) == (17.1167, -61.7833, 10.1)
    assert (first["state"], first["name"]) == (None, "ST JOHNS COOLIDGE FLD")
    assert rows["CA001010066"]["longitude"] == -123.2833
    assert rows["CA001010235"]["longitude"] == -123.4833  # the sign is in column 21
    assert rows["CA001010235"]["hcn_crn_flag"] == "HCN"
    blank = rows["USC00000001"]
    assert (blank["latitude"], blank["longitude"], blank["elevation"]) == (None, None, None)
    short = rows["USC00000002"]
    assert (short["latitude"], short["longitude"], short["name"]) == (40.0, None, None)
    assert rows["USC00000003"]["latitude"] is None
    assert rows["USC00000003"]["wmo_id"] == "72000"


def test_altitudes(spark):
    rows = {tuple(r) for r in text.read_altitudes(spark, write_lines(spark, LINES)).collect()}
    assert ("ACW00011604", 10.1) in rows and ("USC00000001", -999.9) in rows
    assert ("USC00000002", None) in rows


def test_fixed_width_round_trip(spark):
    for fields in (STATION_FIELDS, INVENTORY_FIELDS):
        schema = ", ".join(f"{name} {kind}" for name, _, _, kind in fields)
        kinds = {"string": "AB", "double": -1.5, "bigint": 1987}
        rows = [tuple(kinds[kind] for *_, kind in fields), tuple(None for _ in fields)]
        df = spark.createDataFrame(rows, schema)
        path = scratch_path(spark, "lines")
        df.select(text.fixed_width_line(fields)).write.text(path)
        back = text.read_fixed_width(spark, path, fields)
        assert back.dtypes == df.dtypes
        assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_geography_csv(spark, tmp_path):
    body = 'TW,Asia,Taiwan\r\n"RI,KV",Europe,Serbia\r\n,Europe,Åland Islands\r\nNL,Americas,Caribbean Netherlands\r\nNL,Europe,Netherlands\r\n'
    (tmp_path / "with.csv").write_bytes(("FIPS,Continent,CountryName\r\n" + body).encode())
    (tmp_path / "without.csv").write_bytes(body.encode())
    rows = text.read_geography(spark, str(tmp_path / "with.csv"))
    assert rows.count() == 5
    assert sorted(rows.collect(), key=str) == sorted(
        text.read_geography(spark, str(tmp_path / "without.csv"), header=False).collect(), key=str
    )
    split = split_codes(rows)
    assert sorted(r["fips"] for r in split.collect()) == ["KV", "NL", "NL", "RI", "TW"]
    single = {r["fips"]: r["country"] for r in one_row_per_code(split).collect()}
    assert single == {
        "TW": "Taiwan", "RI": "Serbia", "KV": "Serbia", "NL": "Caribbean Netherlands",
    }


def test_topics(spark):
    path = scratch_path(spark, "topics")
    df = spark.createDataFrame(
        [("07", "a"), ("07", "b"), ("EZ", "c"), ("US", "d")], "topic string, value string"
    )
    files.write_partitioned(df, path, "topic", fmt="text")
    chosen = messages.read_topic_files(spark, path, "07, EZ")
    assert sorted(map(tuple, chosen.collect())) == [("07", "a"), ("07", "b"), ("EZ", "c")]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [topic" in plan
    for absent in ("07, absent", ["*"], ["0[7]"], ["07}"]):
        with pytest.raises(ValueError, match="no messages of"):
            messages.read_topic_files(spark, path, absent)
    assert messages.read_topic_files(spark, path, "absent", stream=True).isStreaming
    with pytest.warns(UserWarning, match="no messages of absent"):
        assert messages.read_topic_files(spark, path, "07, absent", report=True).count() == 2
    assert messages.read_topic_files(spark, path, ["US"]).collect() == [("US", "d")]
    assert messages.read_topic_files(spark, path).count() == 4


def test_broker_options():
    options = messages.broker_options("host:1", "EZ, US,CH ", 5_000_000)
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "EZ,US,CH",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5000000",
    }
    assert "maxOffsetsPerTrigger" not in messages.broker_options("host:1", ["EZ"])


def test_jdbc_options():
    connection = {"url": "jdbc:x:y", "user": "u"}
    assert jdbc.read_options("t", connection, None) == {**connection, "dbtable": "t"}
    split = jdbc.Split("year", 1900, 2020, 12)
    assert jdbc.read_options("t", connection, split) == {
        **connection, "dbtable": "t", "partitionColumn": "year",
        "lowerBound": "1900", "upperBound": "2020", "numPartitions": "12",
    }
    written = jdbc.write_options("t", {**connection, "batchsize": "5"}, 4)
    assert written == {**connection, "batchsize": "5", "numPartitions": "4", "dbtable": "t"}


def test_partitioned_sinks(spark):
    df = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k"),
        F.col("id").alias("v"),
    )
    for write in (files.write_partitioned, files.write_ranges):
        path = scratch_path(spark, "sink")
        write(df, path, "k")
        back = spark.read.parquet(path)
        assert back.count() == 9000
        assert back.filter("k = 'hot'").count() == 3000
        assert sorted(back.select("v", "k").collect()) == sorted(df.select("v", "k").collect())


def test_single_csv(spark, tmp_path):
    df = spark.createDataFrame([(1990, 1.5), (1991, None)], "year int, gap double").repartition(2)
    path = str(tmp_path / "out")
    files.write_single_csv(df, path)
    parts = list((tmp_path / "out").glob("part-*"))
    assert len(parts) == 1
    header, *lines = parts[0].read_text().split()
    assert header == "year,gap"
    assert sorted(lines) == ["1990,1.5", "1991,"]


@pytest.mark.parametrize(
    ("column", "value"), [("latitude", -123.4567891), ("name", "x" * 40), ("station_id", "y" * 12)]
)
def test_values_wider_than_their_field_fail(spark, column, value):
    row = {name: None for name, *_ in STATION_FIELDS} | {"station_id": "S", column: value}
    schema = ", ".join(f"{name} {kind}" for name, _, _, kind in STATION_FIELDS)
    df = spark.createDataFrame([tuple(row.values())], schema)
    with pytest.raises(Exception, match="is wider than"):
        df.select(text.fixed_width_line(STATION_FIELDS)).collect()
