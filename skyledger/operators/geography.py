"""Joins with the geography and station tables.

No join is hinted: Catalyst broadcasts a side whose size it knows to be under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, with AQE
splitting skewed partitions. The plans reduce readings to states before they
join, so a station or country that owns most of the readings is one row here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import country_code, known_elevation


def with_country_code(df: DataFrame) -> DataFrame:
    return df.withColumn("fips", country_code(F.col("station_id")))


def join_geography(df: DataFrame, geography: DataFrame) -> DataFrame:
    """Inner join on ``fips``; a code listed twice doubles its rows."""
    return df.join(geography.select("fips", "continent", "country"), "fips")


def join_elevation(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Inner join on ``station_id`` with the known elevations."""
    known = stations.select(
        "station_id", known_elevation(F.col("elevation")).alias("elevation")
    ).filter(F.col("elevation").isNotNull())
    return df.join(known, "station_id")


def split_codes(geography: DataFrame) -> DataFrame:
    """One row per code where a cell lists several ("RI,KV"); blanks go."""
    return (
        geography.withColumn("fips", F.explode(F.split("fips", ",")))
        .withColumn("fips", F.trim("fips"))
        .filter(F.col("fips") != "")
    )


def one_row_per_code(geography: DataFrame) -> DataFrame:
    """Keep the row with the smallest country name of each code."""
    return (
        geography.groupBy("fips")
        .agg(F.min(F.struct("country", "continent")).alias("first"))
        .select("fips", "first.continent", "first.country")
    )
