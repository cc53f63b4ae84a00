"""The data products, each declared once and run over tables, streams or a ledger.

A product names its variables, months and years, the grain of its partial
state and the keys of its result. From that follow

* ``partial(readings)``: the state of one table or micro-batch,
* ``merge(states)``, ``finish(states)``: merge states of any number of batches, and
  present them,
* ``compute(readings)``: both in one plan,
* ``from_ledger(ledger)``: the same result from the monthly ledger.

Readings are reduced to the grain before any dimension is joined, so joins see
one row per station or country and period, never one per reading.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import between_years, country_code
from skyledger.operators.geography import join_elevation, join_geography
from skyledger.operators.means import merge_wide, wide_means, wide_state, wide_state_columns
from skyledger.schemas import CORE_VARIABLES

LEDGER_KEYS = ("station_id", "year", "month")

# The bounds of the published products.
CONTINENTS = ("Europe", "Americas", "Asia")
PRCP_AFTER, PRCP_BEFORE = 1956, 1993
SNOW_LOW, SNOW_HIGH, SNOW_BELOW = 0, 1850, 82
SNOW_MONTHS = (1,)
FEATURES_AFTER = 1970
WINTER = (1, 2)

_DERIVED = {
    "fips": lambda: country_code(F.col("station_id")),
    "year": lambda: F.year("obs_date"),
    "month": lambda: F.month("obs_date"),
}


@dataclass(frozen=True)
class Product:
    name: str
    variables: tuple[str, ...]
    grain: tuple[str, ...]
    keys: tuple[str, ...]
    present: Callable[[DataFrame], DataFrame]
    months: tuple[int, ...] = ()
    after: int | None = None
    before: int | None = None
    enrich: Callable[[DataFrame], DataFrame] | None = None

    def _state(self, readings: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        rows = readings.filter(F.col("variable").isin(*self.variables))
        if {"year", "month", "obs_date"} & {*self.grain, *self.keys}:
            rows = rows.filter(F.col("obs_date").isNotNull())
        if self.months:
            rows = rows.filter(F.month("obs_date").isin(*self.months))
        rows = rows.filter(between_years(F.col("obs_date"), self.after, self.before))
        rows = rows.select(
            *[_DERIVED[k]().alias(k) if k in _DERIVED else F.col(k) for k in keys],
            "variable",
            "value",
        )
        return wide_state(rows, keys, self.variables)

    def partial(self, readings: DataFrame) -> DataFrame:
        return self._state(readings, self.grain)

    def combine(self, states: DataFrame) -> DataFrame:
        """Partial states added up: one per key of the grain."""
        return merge_wide(states, self.grain, self.variables)

    def merge(self, states: DataFrame) -> DataFrame:
        """One state per key of the result."""
        if self.enrich is not None:
            states = self.enrich(states)
        known = {c.lower() for c in states.columns}  # a database may spell them in capitals
        for k in self.keys:
            if k not in known:
                states = states.withColumn(k, _DERIVED[k]())
        return merge_wide(states, self.keys, self.variables)

    def finish(self, states: DataFrame) -> DataFrame:
        return self.present(self.merge(states))

    def compute(self, readings: DataFrame) -> DataFrame:
        if self.enrich is None:
            return self.present(self._state(readings, self.keys))
        return self.finish(self.partial(readings))

    def from_ledger(self, ledger: DataFrame) -> DataFrame:
        states = ledger
        if self.months:
            states = states.filter(F.col("month").isin(*self.months))
        if {"year", "month", "obs_date"} & {*self.grain, *self.keys}:
            states = states.filter(F.col("year").isNotNull())
        if self.after is not None:
            states = states.filter(F.col("year") > self.after)
        if self.before is not None:
            states = states.filter(F.col("year") < self.before)
        # Groups that hold none of this product's variables are not its groups.
        states = states.filter(
            " OR ".join(f"{v}_rows > 0" for v in self.variables)
        ).withColumn("fips", country_code(F.col("station_id")))
        if self.enrich is not None:
            states = self.enrich(merge_wide(states, self.grain, self.variables))
        return self.present(merge_wide(states, self.keys, self.variables))


@dataclass(frozen=True)
class Ledger:
    """State of every core variable per station and month, in one scan.

    All products are roll-ups of it, so a set of them costs one pass over the
    readings, or one stream. ``{VAR}_rows`` counts readings with a NULL value
    too, which decide whether a group exists. States of batches need not be
    merged before products are made of them.
    """

    name: str = "monthly_ledger"
    grain: tuple[str, ...] = LEDGER_KEYS

    def partial(self, readings: DataFrame) -> DataFrame:
        rows = readings.filter(F.col("variable").isin(*CORE_VARIABLES)).select(
            "station_id",
            F.year("obs_date").alias("year"),
            F.month("obs_date").alias("month"),
            "variable",
            "value",
        )
        counts = [
            F.count(F.when(F.col("variable") == v, 1)).alias(f"{v}_rows") for v in CORE_VARIABLES
        ]
        return rows.groupBy(*self.grain).agg(*wide_state_columns(CORE_VARIABLES), *counts)

    def finish(self, states: DataFrame) -> DataFrame:
        parts = [f"{v}_{part}" for v in CORE_VARIABLES for part in ("sum", "count")]
        parts += [f"{v}_rows" for v in CORE_VARIABLES]
        return states.groupBy(*self.grain).agg(*[F.sum(c).alias(c) for c in parts])

    def combine(self, states: DataFrame) -> DataFrame:
        return self.finish(states)

    def compute(self, readings: DataFrame) -> DataFrame:
        return self.partial(readings)


def temp_gap() -> Product:
    """Yearly mean TMAX minus mean TMIN."""

    def present(states: DataFrame) -> DataFrame:
        means = wide_means(states, ["year"], {"TMAX": "tmax", "TMIN": "tmin"})
        return means.select("year", (F.col("tmax") - F.col("tmin")).alias("gap")).orderBy("year")

    return Product("temp_gap", ("TMAX", "TMIN"), ("year",), ("year",), present)


def continent_prcp(
    geography: DataFrame,
    continents: tuple[str, ...] | None = CONTINENTS,
    after: int | None = PRCP_AFTER,
    before: int | None = PRCP_BEFORE,
) -> Product:
    """Yearly mean precipitation of the given continents."""

    def enrich(states: DataFrame) -> DataFrame:
        geo = geography
        if continents is not None:
            geo = geo.filter(F.col("continent").isin(*continents))
        return join_geography(states, geo)

    def present(states: DataFrame) -> DataFrame:
        keys = ["continent", "year"]
        return wide_means(states, keys, {"PRCP": "avg_prcp"}).orderBy(*keys)

    return Product(
        "continent_prcp", ("PRCP",), ("fips", "year"), ("continent", "year"), present,
        after=after, before=before, enrich=enrich,
    )


def elevation_snow(
    stations: DataFrame,
    low: float | None = SNOW_LOW,
    high: float | None = SNOW_HIGH,
    below: float | None = SNOW_BELOW,
    months: tuple[int, ...] = SNOW_MONTHS,
) -> Product:
    """Mean January snow per elevation; bounds of None are left out."""

    def enrich(states: DataFrame) -> DataFrame:
        joined = join_elevation(states, stations)
        if low is not None:
            joined = joined.filter(F.col("elevation") >= low)
        if high is not None:
            joined = joined.filter(F.col("elevation") < high)
        return joined

    def present(states: DataFrame) -> DataFrame:
        means = wide_means(states, ["elevation"], {"SNOW": "avg_snow"})
        if below is not None:
            means = means.filter(F.col("avg_snow") < below)
        return means.orderBy(F.col("elevation").asc())

    return Product(
        "elevation_snow", ("SNOW",), ("station_id",), ("elevation",), present,
        months=months, enrich=enrich,
    )


def station_var_mean(
    stations: DataFrame, variable: str, months: tuple[int, ...] = ()
) -> Product:
    """Mean and weight of any one variable per known elevation."""

    def present(states: DataFrame) -> DataFrame:
        weight = F.col(f"{variable}_count").alias(f"{variable.lower()}_count")
        mean = wide_means(states, ["elevation", weight], {variable: variable.lower()})
        return mean.select("elevation", variable.lower(), f"{variable.lower()}_count").orderBy(
            F.col("elevation").asc()
        )

    return Product(
        f"station_{variable.lower()}_mean", (variable,), ("station_id",), ("elevation",), present,
        months=months, enrich=lambda states: join_elevation(states, stations),
    )


def ml_features(after: int | None = FEATURES_AFTER, months: tuple[int, ...] = WINTER) -> Product:
    """Winter means of four variables per station, year and month."""
    names = {"SNOW": "snow_avg", "TMAX": "tmax_avg", "TMIN": "tmin_avg", "PRCP": "prcp_avg"}
    return Product(
        "ml_features", tuple(names), LEDGER_KEYS, LEDGER_KEYS,
        lambda states: wide_means(states, LEDGER_KEYS, names),
        months=months, after=after,
    )


def bonus_station_month(daily: bool = False, months: tuple[int, ...] = WINTER) -> Product:
    """Winter means of the five core variables per station and month.

    Partial states are as coarse as the result, unless ``daily`` ones are wanted
    as a table of their own.
    """
    keys = ("station_id", "month")
    names = {v: f"{v.lower()}_avg" for v in CORE_VARIABLES}
    return Product(
        "bonus_station_month", CORE_VARIABLES, ("station_id", "obs_date") if daily else keys, keys,
        lambda states: wide_means(states, keys, names),
        months=months,
    )


def top_country(readings: DataFrame, geography: DataFrame, variable: str = "PRCP") -> DataFrame:
    """The country with the highest mean; the smaller name on a tie."""
    product = Product(
        "top_country", (variable,), ("fips",), ("country",),
        lambda states: wide_means(states, ["country"], {variable: "mean"}),
        enrich=lambda states: join_geography(states, geography),
    )
    return (
        product.compute(readings)
        .filter(F.col("mean").isNotNull())
        .orderBy(F.col("mean").desc(), "country")
        .limit(1)
    )


def yearly_extremes(readings: DataFrame) -> DataFrame:
    """Highest TMAX, lowest TMIN and the gap of the means, where both exist."""
    tmax = F.when(F.col("variable") == "TMAX", F.col("value"))
    tmin = F.when(F.col("variable") == "TMIN", F.col("value"))
    return (
        readings.filter(F.col("variable").isin("TMAX", "TMIN") & F.col("obs_date").isNotNull())
        .groupBy(F.year("obs_date").alias("year"))
        .agg(
            F.max(tmax).alias("max_tmax"),
            F.min(tmin).alias("min_tmin"),
            (F.avg(tmax) - F.avg(tmin)).alias("gap"),
        )
        .filter(F.col("max_tmax").isNotNull() & F.col("min_tmin").isNotNull())
        .orderBy("year")
    )
