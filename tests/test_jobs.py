from __future__ import annotations

import pytest

from __spark_entry__ import queries
from skyledger import jobs
from skyledger.schemas import STATION_FIELDS
from skyledger.session import scratch_path
from skyledger.sources import tables, text
from skyledger.sources.files import write_partitioned

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    lineitem = tables.table(spark, SF_DIR, "lineitem")
    paths = {n: scratch_path(spark, n) for n in ("messages", "stations", "geography")}
    landed = tables.messages_of(lineitem)
    landed = landed.withColumn("value", landed.value.cast("string"))
    write_partitioned(landed, paths["messages"], "topic", fmt="text")
    tables.stations(spark, SF_DIR).write.parquet(paths["stations"])
    tables.geography(spark, SF_DIR).write.parquet(paths["geography"])
    return paths


@pytest.mark.parametrize("name", ["temp_gap", "elevation_snow", "ledger"])
def test_stream_and_table_jobs_publish_the_same(spark, inputs, name):
    results = []
    for mode in ("static", "dynamic"):
        output = scratch_path(spark, "output")
        args = jobs.arguments(
            [name, "--messages", inputs["messages"], "--topics", "00, 03, 07", "--mode", mode,
             "--per-trigger", "2", "--work", scratch_path(spark, "work"), "--output", output,
             "--stations", inputs["stations"], "--geography", inputs["geography"]]
        )
        jobs.execute(spark, args)
        results.append(sorted(spark.read.parquet(output).collect(), key=str))
    assert results[0] == results[1] and results[0]


def test_arguments():
    for wrong in (
        ["temp_gap", "--messages", "m", "--topics", "EZ", "--output", "o"],  # a stream without --work
        ["temp_gap", "--messages", "m", "--work", "w", "--output", "o"],
        ["temp_gap", "--topics", "EZ", "--work", "w", "--output", "o"],
        ["unknown", "--messages", "m", "--topics", "EZ", "--output", "o"],
        ["temp_gap", "--messages", "m", "--topics", "EZ", "--work", "w"],
        ["stations", "--output", "o"],
    ):
        with pytest.raises(SystemExit):
            jobs.arguments(wrong)
    args = jobs.arguments(
        ["temp_gap", "--servers", "h:1", "--topics", "EZ", "--work", "w", "--jdbc-url", "jdbc:x"]
    )
    assert (args.mode, args.every, args.seconds) == ("dynamic", None, None)


def test_missing_dimension(spark):
    args = jobs.arguments(
        ["elevation_snow", "--messages", "m", "--topics", "EZ", "--mode", "static", "--output", "o"]
    )
    with pytest.raises(SystemExit, match="--stations"):
        jobs.product_named(spark, args)


def test_sql_sink(spark, monkeypatch):
    calls = []
    monkeypatch.setenv("JDBC_USER", "u")
    monkeypatch.setattr(jobs, "append_table", lambda *a: calls.append(("append", *a[1:])))
    monkeypatch.setattr(jobs, "overwrite_table", lambda *a: calls.append(("overwrite", *a[1:])))
    base = ["geography", "--input", "i", "--jdbc-url", "jdbc:x"]
    jobs.publish(spark.range(1), jobs.arguments(base))
    jobs.publish(spark.range(1), jobs.arguments([*base, "--table", "t", "--overwrite"]))
    options = {"url": "jdbc:x", "user": "u"}
    assert calls == [("append", "geography", options, 16), ("overwrite", "t", options, 16)]


def test_reference_tables_and_models(spark, tmp_path):
    lines = scratch_path(spark, "lines")
    stations = tables.stations(spark, SF_DIR)
    stations.select(text.fixed_width_line(STATION_FIELDS)).write.text(lines)
    names = ("stations", "some", "clusters", "centers", "report", "geo", "work")
    out = {n: scratch_path(spark, n) for n in names}
    jobs.execute(spark, jobs.arguments(["stations", "--input", lines, "--output", out["stations"]]))
    assert spark.read.parquet(out["stations"]).count() == stations.count()
    jobs.execute(spark, jobs.arguments(
        ["stations", "--input", lines, "--prefix", "03", "--output", out["some"]]))
    assert {r[0][:2] for r in spark.read.parquet(out["some"]).select("station_id").collect()} == {"03"}
    jobs.execute(spark, jobs.arguments(
        ["clusters", "--input", out["stations"], "--k", "3", "--output", out["clusters"],
         "--summary", out["centers"]]))
    clusters = spark.read.parquet(out["clusters"])
    assert clusters.count() == stations.filter("elevation <> -999.9").count()
    assert clusters.select("cluster").distinct().count() == 3
    centers = spark.read.parquet(out["centers"]).collect()
    assert sum(r["size"] for r in centers) == clusters.count()
    features = scratch_path(spark, "features")
    queries()["ml_features"](spark, "/root/testdata/sf0.01").write.parquet(features)
    jobs.execute(spark, jobs.arguments(
        ["regression", "--input", features, "--output", out["report"], "--work", out["work"]]))
    assert spark.read.parquet(f"{out['work']}/cases").count() > 0
    assert spark.read.parquet(out["report"]).first()["rmse"] > 0
    (tmp_path / "geo.csv").write_text('TW,Asia,Taiwan\n"RI,KV",Europe,Serbia\n')
    jobs.execute(spark, jobs.arguments(
        ["geography", "--input", str(tmp_path / "geo.csv"), "--no-header", "--output", out["geo"]]))
    assert spark.read.parquet(out["geo"]).count() == 2


def test_parameters_of_products(spark, inputs):
    base = ["--messages", "m", "--topics", "EZ", "--mode", "static", "--output", "o"]
    dims = ["--stations", inputs["stations"], "--geography", inputs["geography"]]

    def made(name, *options):
        return jobs.product_named(spark, jobs.arguments([name, *base, *dims, *options]))

    product = made("continent_prcp", "--after", "1990", "--continents", "ASIA, EUROPE")
    assert (product.after, product.before) == (1990, 1993)
    product = made("continent_prcp", "--unbounded", "--before", "2000")
    assert (product.after, product.before) == (None, 2000)
    assert made("elevation_snow", "--months", "2, 3").months == (2, 3)
    assert made("station_var_mean", "--months", "1").months == (1,)
    assert made("ml_features").months == (1, 2) and made("ml_features", "--after", "5").after == 5


def test_options_of_sql_tables(spark, monkeypatch):
    sql = ["--jdbc-url", "jdbc:x"]
    product = ["temp_gap", "--messages", "m", "--topics", "EZ", *sql, "--partials", "p"]
    for wrong in (
        product,
        [*product, "--run-id", "r"],
        ["ledger", *product[1:], "--run-id", "r", "--work", "w"],
        ["regression", "--input-table", "t", *sql, "--split-column", "year"],
    ):
        with pytest.raises(SystemExit):
            jobs.arguments(wrong)
    args = jobs.arguments(
        ["regression", "--input-table", "t", *sql, "--split-column", "year", "--split-lower", "1900",
         "--split-upper", "2020", "--split-parts", "7", "--connections", "3"]
    )
    assert jobs.split(args) == jobs.Split("year", "1900", "2020", 7) and args.connections == 3
    calls = []
    monkeypatch.setattr(jobs, "messages", lambda *_: spark.createDataFrame([], "topic string, value string"))
    monkeypatch.setattr(jobs, "run_partials_to_table", lambda *a: calls.append(a[2:6]))
    monkeypatch.setattr(jobs, "finish_table", lambda *a: calls.append(a[2]) or spark.range(1))
    monkeypatch.setattr(jobs, "append_table", lambda *a: calls.append(a[1]))
    jobs.execute(spark, jobs.arguments([*product, "--run-id", "r", "--work", "w"]))
    jobs.execute(spark, jobs.arguments(["temp_gap", *sql, "--partials", "p", "--merge", "--table", "t"]))
    assert calls == [("p", {"url": "jdbc:x"}, "w/checkpoint", "r"), "p", "t"]


def test_folders_per_value(spark):
    out = scratch_path(spark, "folders")
    df = spark.range(30).selectExpr("id % 3 AS k", "id")
    jobs.publish(df, jobs.arguments(["geography", "--input", "i", "--output", out, "--partition-by", "k"]))
    assert spark.read.parquet(f"{out}/k=2").count() == 10


def test_a_kept_model_scores_later(spark):
    rows = queries()["ml_features"](spark, SF_DIR)
    features, model = scratch_path(spark, "features"), scratch_path(spark, "model")
    rows.write.parquet(features)
    outputs = [scratch_path(spark, "output") for _ in range(2)]
    for job, output in zip(("regression", "score"), outputs, strict=True):
        jobs.execute(spark, jobs.arguments([job, "--input", features, "--model", model, "--output", output]))
    scored = spark.read.parquet(outputs[1])
    assert scored.count() == rows.na.drop("any", subset=["snow_avg", "tmax_avg", "tmin_avg"]).count() > 0
    report = spark.read.parquet(outputs[0]).first()
    for r in scored.limit(20).collect():
        want = report["intercept"] + sum(report[f"coef_{f}"] * r[f] for f in ("snow_avg", "tmax_avg", "tmin_avg"))
        assert r["prediction"] == pytest.approx(want, abs=1e-6)
    with pytest.raises(SystemExit):
        jobs.arguments(["score", "--input", features, "--output", "o"])
