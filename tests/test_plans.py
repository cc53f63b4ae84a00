"""What the physical plans must and must not contain."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from __spark_entry__ import entry, queries
from skyledger import registry, session
from skyledger.operators import ranks
from skyledger.operators.ranks import first_rows
from skyledger.session import materialize, scratch_path
from skyledger.sources import tables

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [k for k in sorted(registry.QUERIES) if not k.startswith("stream_")])
def test_no_python_and_no_pairing(spark, key):
    plan = plan_of(queries()[key](spark, SF_DIR))
    for word in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_year_bounds_reach_the_scan(spark):
    for key in ("continent_prcp", "ml_features"):
        plan = queries()[key](spark, SF_DIR)._jdf.queryExecution().toString()
        assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in plan


def test_the_cut_of_a_limit_reaches_the_scan(spark, monkeypatch):
    """Two scans of the readings: the dates, and what lies up to the cut."""
    plans = []
    monkeypatch.setattr(
        ranks, "materialize", lambda df, name: plans.append(df) or materialize(df, name)
    )
    found = queries()["ordered_limit"](spark, "/root/testdata/sf0.01")
    upto = plans[0]._jdf.queryExecution().toString()
    assert upto.count("FileScan") == 1 and "LessThan(l_shipdate" in upto
    assert "lineitem" not in found._jdf.queryExecution().toString()


def test_only_needed_columns_are_read(spark):
    plan = plan_of(queries()["temp_gap"](spark, SF_DIR))
    scan = plan[plan.index("FileScan") :]
    for unused in ("l_orderkey", "l_partkey", "l_extendedprice", "l_linestatus", "l_suppkey"):
        assert unused not in scan


@pytest.mark.parametrize("key", ["continent_prcp", "elevation_snow", "top_country", "station_var_mean"])
def test_readings_are_reduced_before_the_join(spark, key):
    plan = plan_of(queries()[key](spark, SF_DIR))
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "l_shipdate" in line or
                "FileScan" in line and "l_linenumber" in line)
    assert any("partial_sum" in line for line in lines[join:scan])


def test_wide_products_shuffle_once(spark):
    for key in ("ml_features", "bonus_station_month", "monthly_ledger", "pivot_sum_count"):
        assert plan_of(queries()[key](spark, SF_DIR)).count("Exchange") == 1


def test_messages_are_parsed_once(spark):
    plan = plan_of(queries()["clean_readings"](spark, SF_DIR))
    assert plan.count("from_json(") == 1


def test_large_sides_are_not_broadcast(spark):
    """Beyond the threshold, joins shuffle; nothing forces a broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("continent_prcp", "elevation_snow", "fixed_width_inventory"):
            df = queries()[key](spark, SF_DIR)
            df.collect()
            assert "BroadcastExchange" not in plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"year", "gap"}


def test_scratch_follows_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or ""
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(base)
    assert spark.sparkContext.applicationId in first


def test_no_scratch_without_a_shared_folder():
    context = SimpleNamespace(
        master="local[2]", applicationId="app", getCheckpointDir=lambda: None
    )
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session, "x")


def test_scratch_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_folder", lambda _: str(tmp_path / "app"))
    kept = materialize(spark.range(5), "x")
    assert kept.count() == 5 and (tmp_path / "app").exists()
    session.clear_scratch(spark)
    assert not (tmp_path / "app").exists() and tmp_path.exists()


def test_ranks_use_no_single_partition_window(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id % 5 AS v", "cast(id % 11 AS string) AS s")
    plan = first_rows(df, 500, "k", "v", "s")._jdf.queryExecution().toString()
    windows = [x for x in plan.splitlines() if "windowspecdefinition" in x]
    assert windows and all("windowspecdefinition(_p" in x for x in windows)


def test_registry_reads_whole_tables(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    kept = lines.filter("l_discount <> 0").count()
    assert registry.QUERIES["row_count"](spark, SF_DIR).first()["n_rows"] == kept
    assert tables.raw_readings(lines).count() == lines.count()
