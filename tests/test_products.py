from __future__ import annotations

import datetime
import random
from collections import defaultdict

import pytest

from skyledger.plans import products
from skyledger.schemas import CORE_VARIABLES

READING = "station_id string, obs_date date, variable string, value int"
GEO = "fips string, continent string, country string"
STATION = "station_id string, latitude double, longitude double, elevation double"

GEOGRAPHY = [
    ("EZ", "Europe", "Czechia"),
    ("US", "Americas", "US"),
    ("NL", "Americas", "Caribbean Netherlands"),
    ("NL", "Europe", "Netherlands"),
    ("CH", "Asia", "China"),
    ("AS", "Oceania", "Australia"),
]
STATIONS = [
    ("US000000001", 1.0, 2.0, 10.0),
    ("US000000002", 1.0, 2.0, 10.0),
    ("US000000003", 1.0, 2.0, -999.9),
    ("US000000004", 1.0, 2.0, 1850.0),
    ("US000000005", 1.0, 2.0, -4.0),
    ("CH000000001", 1.0, 2.0, None),
    ("CH000000002", 1.0, 2.0, 300.5),
    ("EZ000000001", 1.0, 2.0, 77.0),
]


def make_rows(n=3000):
    """A third of all readings come from one station; others are spread out."""
    draw = random.Random(3)
    names = [s[0] for s in STATIONS] + ["NL000000001", "AS000000001", "QQ000000001"]
    rows = []
    for i in range(n):
        station = "US000000001" if i % 3 == 0 else draw.choice(names)
        day = datetime.date(draw.choice([1956, 1957, 1970, 1971, 1992, 1993]),
                            draw.randint(1, 12), draw.randint(1, 28))
        rows.append((
            station,
            None if i % 50 == 1 else day,
            draw.choice([*CORE_VARIABLES, "WSF2"]),
            None if i % 40 == 2 else draw.randint(-100, 250),
        ))
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame(ROWS, READING).repartition(3).cache()


@pytest.fixture(scope="module")
def dims(spark):
    return spark.createDataFrame(GEOGRAPHY, GEO), spark.createDataFrame(STATIONS, STATION)


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def groups(rows, key):
    found = defaultdict(list)
    for row in rows:
        found[key(row)].append(row[3])
    return found


def brute_temp_gap():
    result = {}
    rows = [r for r in ROWS if r[1] and r[2] in ("TMAX", "TMIN")]
    for year in {r[1].year for r in rows}:
        high = mean([r[3] for r in rows if r[1].year == year and r[2] == "TMAX"])
        low = mean([r[3] for r in rows if r[1].year == year and r[2] == "TMIN"])
        result[year] = None if high is None or low is None else high - low
    return result


def brute_continent():
    joined = [
        (g[1], r[1].year, None, r[3])
        for r in ROWS
        for g in GEOGRAPHY
        if r[1] and r[2] == "PRCP" and r[0][:2] == g[0] and 1956 < r[1].year < 1993
        and g[1] in ("Europe", "Americas", "Asia")
    ]
    return {k: mean(v) for k, v in groups(joined, lambda r: (r[0], r[1])).items()}


ELEVATION = {s[0]: s[3] for s in STATIONS if s[3] is not None and s[3] != -999.9}


def brute_snow(low, high, below):
    rows = [r for r in ROWS if r[1] and r[1].month == 1 and r[2] == "SNOW" and r[0] in ELEVATION]
    means = {k: mean(v) for k, v in groups(rows, lambda r: ELEVATION[r[0]]).items()}
    return {
        e: m
        for e, m in means.items()
        if (low is None or e >= low)
        and (high is None or e < high)
        and (below is None or (m is not None and m < below))
    }


def pairs(df):
    return {tuple(r)[:-1] if len(r) > 2 else r[0]: r[-1] for r in df.collect()}


def test_temp_gap(readings):
    product = products.temp_gap()
    assert pairs(product.compute(readings)) == brute_temp_gap()
    years = [r["year"] for r in product.compute(readings).collect()]
    assert years == sorted(years)


def test_gap_needs_both_sides(spark):
    df = spark.createDataFrame([("EZ1", datetime.date(1980, 1, 1), "TMAX", 3)], READING)
    assert [tuple(r) for r in products.temp_gap().compute(df).collect()] == [(1980, None)]


def test_continent_prcp(readings, dims):
    assert pairs(products.continent_prcp(dims[0]).compute(readings)) == brute_continent()


def test_no_bounds_keep_all_continents(readings, dims):
    got = pairs(products.continent_prcp(dims[0], None, None, None).compute(readings))
    assert {k[0] for k in got} == {"Europe", "Americas", "Asia", "Oceania"}
    assert {k[1] for k in got} == {1956, 1957, 1970, 1971, 1992, 1993}


@pytest.mark.parametrize("bounds", [(0, 1850, 82), (None, None, None)])
def test_elevation_snow(readings, dims, bounds):
    product = products.elevation_snow(dims[1], *bounds)
    assert pairs(product.compute(readings)) == brute_snow(*bounds)


@pytest.mark.parametrize("months", [(), (1,)])
def test_station_var_mean(readings, dims, months):
    got = products.station_var_mean(dims[1], "PRCP", months).compute(readings).collect()
    rows = [r for r in ROWS if r[2] == "PRCP" and r[0] in ELEVATION]
    if months:
        rows = [r for r in rows if r[1] and r[1].month in months]
    want = {
        k: (mean(v), sum(x is not None for x in v))
        for k, v in groups(rows, lambda r: ELEVATION[r[0]]).items()
    }
    assert {r["elevation"]: (r["prcp"], r["prcp_count"]) for r in got} == want


def wide(rows, key, variables):
    result = {}
    for k in {key(r) for r in rows}:
        result[k] = tuple(mean([r[3] for r in rows if key(r) == k and r[2] == v]) for v in variables)
    return result


def test_ml_features(readings):
    got = {tuple(r[:3]): tuple(r[3:]) for r in products.ml_features().compute(readings).collect()}
    variables = ("SNOW", "TMAX", "TMIN", "PRCP")
    rows = [r for r in ROWS if r[1] and r[1].month < 3 and r[1].year > 1970 and r[2] in variables]
    assert got == wide(rows, lambda r: (r[0], r[1].year, r[1].month), variables)


def test_bonus(readings):
    got = {tuple(r[:2]): tuple(r[2:]) for r in products.bonus_station_month().compute(readings).collect()}
    rows = [r for r in ROWS if r[1] and r[1].month < 3 and r[2] in CORE_VARIABLES]
    assert got == wide(rows, lambda r: (r[0], r[1].month), CORE_VARIABLES)


def every_product(dims):
    geography, stations = dims
    return [
        products.temp_gap(),
        products.continent_prcp(geography),
        products.continent_prcp(geography, None, None, None),
        products.elevation_snow(stations),
        products.elevation_snow(stations, None, None, None),
        products.station_var_mean(stations, "PRCP"),
        products.ml_features(),
        products.ml_features(None),
        products.bonus_station_month(),
        products.bonus_station_month(daily=True),
    ]


@pytest.mark.parametrize("i", range(10))
def test_batches_and_ledger_agree_with_one_pass(readings, dims, i):
    product = every_product(dims)[i]
    whole = sorted(product.compute(readings).collect(), key=str)
    assert whole
    parts = readings.randomSplit([1.0, 2.0, 3.0], seed=i)
    states = product.partial(parts[0])
    for part in parts[1:]:
        states = states.unionByName(product.partial(part))
    assert sorted(product.finish(states).collect(), key=str) == whole
    ledger = products.Ledger()
    assert sorted(product.from_ledger(ledger.compute(readings)).collect(), key=str) == whole
    pages = ledger.partial(parts[0])
    for part in parts[1:]:
        pages = pages.unionByName(ledger.partial(part))
    assert sorted(product.from_ledger(pages).collect(), key=str) == whole


def test_top_country(readings, dims):
    joined = [
        (g[2], None, None, r[3]) for r in ROWS for g in GEOGRAPHY if r[2] == "PRCP" and r[0][:2] == g[0]
    ]
    means = {k: mean(v) for k, v in groups(joined, lambda r: r[0]).items()}
    best = min(means.items(), key=lambda kv: (-kv[1], kv[0]))
    assert [tuple(r) for r in products.top_country(readings, dims[0]).collect()] == [best]


def test_top_country_breaks_ties_by_name(spark, dims):
    df = spark.createDataFrame([("US1", None, "PRCP", 4), ("CH1", None, "PRCP", 4)], READING)
    assert products.top_country(df, dims[0]).first()["country"] == "China"


def test_yearly_extremes(spark):
    day = datetime.date(1980, 1, 1)
    df = spark.createDataFrame(
        [("a", day, "TMAX", 3), ("a", day, "TMAX", 9), ("a", day, "TMIN", -2),
         ("a", datetime.date(1981, 1, 1), "TMAX", 5)], READING,
    )
    assert [tuple(r) for r in products.yearly_extremes(df).collect()] == [(1980, 9, -2, 8.0)]


def test_ledger_pages_merge(readings):
    ledger = products.Ledger()
    first, second = readings.randomSplit([1.0, 1.0], seed=2)
    pages = ledger.partial(first).unionByName(ledger.partial(second))
    assert sorted(ledger.finish(pages).collect(), key=str) == sorted(
        ledger.compute(readings).collect(), key=str
    )
