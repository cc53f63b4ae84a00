from __future__ import annotations

import datetime
import random
import statistics

import pytest

from skyledger.operators.ranks import Ranked, first_rows, medians, value_at_rank


def numbers(kind: str) -> list[float | None]:
    draw = random.Random(7)
    match kind:
        case "uniform":
            return [draw.uniform(-1e6, 1e6) for _ in range(4001)]
        case "hot":  # a third of all rows share one value
            return [draw.uniform(0, 1) for _ in range(2000)] + [0.25] * 1000
        case "few":
            return [float(draw.choice([1, 2, 3])) for _ in range(3000)]
        case "wide":  # outliers far from the rest, and neighbours one bit apart
            return [-1.7e308, 1.7e308, -1e300, 1.0, 1.0 + 2**-52] + [draw.expovariate(1) for _ in range(2000)]
        case "nulls":
            return [None] * 50 + [draw.gauss(0, 1) for _ in range(2000)]
    return [5.0]


@pytest.mark.parametrize("kind", ["uniform", "hot", "few", "wide", "nulls", "one"])
def test_ranks_by_brute_force(spark, kind):
    values = numbers(kind)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    known = sorted(v for v in values if v is not None)
    for rank in sorted({0, len(known) // 3, len(known) - 1}):
        value = known[rank]
        want = Ranked(value, sum(v < value for v in known), known.count(value))
        assert value_at_rank(df, "x", rank) == want
    assert value_at_rank(df, "x", len(known)) is None
    assert medians(df, ["x"])["x"] == pytest.approx(statistics.median(known), abs=1e-12)


def test_median_of_nothing(spark):
    assert medians(spark.createDataFrame([(None,)], "x double"), ["x"]) == {"x": None}


@pytest.mark.parametrize("n", [0, 1, 57, 400, 999, 1000, 5000])
def test_first_rows_by_brute_force(spark, n):
    draw = random.Random(n)
    hot = datetime.date(2000, 1, 15)
    rows = [
        (hot if i % 3 == 0 else datetime.date(2000, 1, draw.randint(1, 30)),
         draw.choice("abc"), draw.randint(0, 4))
        for i in range(1000)
    ]
    df = spark.createDataFrame(rows, "d date, s string, v int").repartition(5)
    got = sorted(tuple(r) for r in first_rows(df, n, "d", "s", "v").collect())
    assert got == sorted(rows)[:n]


def test_first_rows_by_lead_alone(spark):
    df = spark.createDataFrame([(i // 10,) for i in range(100)], "k long")
    got = [r["k"] for r in first_rows(df, 33, "k").collect()]
    assert sorted(got) == [i // 10 for i in range(33)]


def test_large_integers(spark):
    values = [2**62 + i for i in range(50)] + [-(2**62)]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    for rank in (0, 1, 25, 50):
        assert value_at_rank(df, "x", rank).value == sorted(values)[rank]


@pytest.mark.parametrize("kind", ["date", "long"])
@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 7, 9])
def test_missing_leads_come_first(spark, kind, n):
    days = [datetime.date(2000, 1, d) for d in (1, 2, 2)] if kind == "date" else [1, 2, 2]
    rows = [(None, "b"), (None, "a"), (None, None), *zip(days, ("x", None, "y"), strict=True)]
    df = spark.createDataFrame(rows, f"k {kind}, s string").repartition(3)
    want = [tuple(r) for r in df.orderBy("k", "s").limit(n).collect()]
    got = [tuple(r) for r in first_rows(df, n, "k", "s").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_medians_of_several_columns_in_one_aggregate_per_round(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(draw.gauss(0, 1), draw.expovariate(1), float("nan") if i % 5 == 0 else 7.0) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = medians(df, ["a", "b", "c"])
    assert found["a"] == pytest.approx(statistics.median(r[0] for r in rows))
    assert found["b"] == pytest.approx(statistics.median(r[1] for r in rows))
    assert found["c"] == 7.0


def test_infinity_has_no_bucket(spark):
    with pytest.raises(ValueError, match="infinite"):
        medians(spark.createDataFrame([(1.0,), (float("inf"),)], "x double"), ["x"])
