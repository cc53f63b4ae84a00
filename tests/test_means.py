from __future__ import annotations

from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.operators.means import (
    mean_state,
    merge_states,
    merge_weighted,
    merge_wide,
    once_per_batch,
    wide_means,
    wide_state,
)

VARIABLES = ("TMAX", "TMIN")
ROWS = st.lists(
    st.tuples(
        st.integers(0, 3),
        st.sampled_from(["a", "b"]),
        st.sampled_from(["TMAX", "TMIN", "WSF2"]),
        st.one_of(st.none(), st.integers(-500, 500)),
    ),
    min_size=1,
    max_size=40,
)
SCHEMA = "batch int, key string, variable string, value int"


def brute_means(rows):
    result = {}
    for _, key, variable, value in rows:
        if variable in VARIABLES:
            sums = result.setdefault(key, {v: [0, 0] for v in VARIABLES})
            if value is not None:
                sums[variable][0] += value
                sums[variable][1] += 1
    return {
        key: tuple(float(Fraction(s, n)) if n else None for s, n in sums.values())
        for key, sums in result.items()
    }


def collected(df):
    return {r["key"]: (r["tmax"], r["tmin"]) for r in df.collect()}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_any_split_merges_to_the_whole(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    names = {"TMAX": "tmax", "TMIN": "tmin"}
    whole = wide_means(wide_state(df, ["key"], VARIABLES), ["key"], names)
    states = wide_state(df, ["batch", "key"], VARIABLES)
    merged = wide_means(merge_wide(states, ["key"], VARIABLES), ["key"], names)
    assert collected(whole) == collected(merged) == brute_means(rows)


def test_wide_state_is_the_pivot(spark):
    rows = [(0, "a", "TMAX", 3), (0, "a", "TMAX", 4), (0, "a", "TMIN", 1), (0, "b", "TMAX", 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    pivot = (
        df.groupBy("key")
        .pivot("variable", list(VARIABLES))
        .agg(F.sum("value").alias("sum"), F.count("value").alias("count"))
        .na.fill(0, ["TMAX_count", "TMIN_count"])
    )
    assert sorted(wide_state(df, ["key"], VARIABLES).collect()) == sorted(pivot.collect())


def test_states_of_a_pivot_merge_too(spark):
    schema = "key string, TMAX_sum long, TMAX_count long, TMIN_sum long, TMIN_count long"
    states = spark.createDataFrame(
        [("a", 10, 4, None, None), ("a", 2, 2, None, 0), ("b", None, None, 5, 1)], schema
    )
    merged = merge_wide(states, ["key"], VARIABLES)
    assert sorted(map(tuple, merged.collect())) == [("a", 12, 6, None, 0), ("b", None, 0, 5, 1)]
    names = {"TMAX": "tmax", "TMIN": "tmin"}
    assert collected(wide_means(merged, ["key"], names)) == {"a": (2.0, None), "b": (None, 5.0)}


def test_replayed_rows_count_once(spark):
    df = spark.createDataFrame(
        [(0, "a", "TMAX", 3), (0, "a", "TMIN", 1), (1, "a", "TMAX", 5), (1, "b", "TMIN", 2)], SCHEMA
    ).withColumnRenamed("batch", "batch_id").withColumn("run_id", F.lit("r"))
    states = wide_state(df, ["run_id", "batch_id", "key"], VARIABLES)
    appended = states.unionByName(states.filter("batch_id = 1"))
    once = once_per_batch(appended, ["key"], VARIABLES)
    assert sorted(merge_wide(once, ["key"], VARIABLES).collect()) == sorted(
        merge_wide(states, ["key"], VARIABLES).collect()
    )


def test_runs_do_not_collapse_into_each_other(spark):
    rows = [("one", 0, "a", "TMAX", 3), ("two", 0, "a", "TMAX", 9)]
    df = spark.createDataFrame(rows, "run_id string, batch_id int, key string, variable string, value int")
    states = wide_state(df, ["run_id", "batch_id", "key"], VARIABLES)
    once = once_per_batch(states, ["key"], VARIABLES)
    assert merge_wide(once, ["key"], VARIABLES).first()["TMAX_sum"] == 12
    for change in ({"run_id": F.lit("r")}, {"run_id": F.lit("r"), "TMAX_sum": F.when(F.col("TMAX_sum") > 3, 1)}):
        with pytest.raises(Exception, match="different states"):
            once_per_batch(states.withColumns(change), ["key"], VARIABLES).collect()


def test_weighted_merge(spark):
    df = spark.createDataFrame(
        [("a", 2.0, 3), ("a", 6.0, 1), ("b", 1.5, 2), ("b", None, 0)], "key string, m double, n long"
    )
    merged = {r["key"]: (r["m"], r["n"]) for r in merge_weighted(df, ["key"], "m", "n").collect()}
    assert merged == {"a": (3.0, 4), "b": (1.5, 2)}


def test_long_states(spark):
    df = spark.createDataFrame([(0, "a", "x", 3), (1, "a", "x", None), (1, "a", "x", 5)], SCHEMA)
    states = mean_state(df, ["batch", "key"], "value")
    assert [tuple(r) for r in merge_states(states, ["key"]).collect()] == [("a", 8, 2)]


@pytest.mark.parametrize("share", [3])
def test_hot_key_is_combined_before_the_shuffle(spark, share):
    n = 30_000
    df = spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % share == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.lit("TMAX").alias("variable"),
        (F.col("id") % 7).cast("int").alias("value"),
    )
    state = wide_state(df, ["key"], ("TMAX",))
    hot = state.filter("key = 'hot'").first()
    values = [i % 7 for i in range(n) if i % share == 0]
    assert (hot["TMAX_sum"], hot["TMAX_count"]) == (sum(values), len(values))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")
