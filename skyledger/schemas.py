"""Schemas and constants of the weather-station domain."""

from __future__ import annotations

from pyspark.sql import types as T

# The message schema of one reading.
READING = T.StructType(
    [
        T.StructField("StationId", T.StringType(), False),
        T.StructField("Date", T.IntegerType(), False),
        T.StructField("Variable", T.StringType(), False),
        T.StructField("Value", T.IntegerType(), False),
        T.StructField("M_Flag", T.StringType(), True),
        T.StructField("Q_Flag", T.StringType(), True),
        T.StructField("S_Flag", T.StringType(), True),
        T.StructField("ObsTime", T.StringType(), True),
    ]
)

# The variables the products are built from.
CORE_VARIABLES = ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")

# Fixed value: the elevation that stands for "unknown" in station lists.
UNKNOWN_ELEVATION = -999.9

GEOGRAPHY = T.StructType(
    [
        T.StructField("fips", T.StringType()),
        T.StructField("continent", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

# Fields of the fixed-width lists as (name, start, end, type),
# offsets 0-based and half-open. Longitude starts at 21 so that a minus sign
# in that column is not lost.
STATION_FIELDS = (
    ("station_id", 0, 11, "string"),
    ("latitude", 12, 20, "double"),
    ("longitude", 21, 30, "double"),
    ("elevation", 31, 37, "double"),
    ("state", 38, 40, "string"),
    ("name", 41, 71, "string"),
    ("gsn_flag", 72, 75, "string"),
    ("hcn_crn_flag", 76, 79, "string"),
    ("wmo_id", 80, 85, "string"),
)
INVENTORY_FIELDS = (
    ("station_id", 0, 11, "string"),
    ("latitude", 12, 20, "double"),
    ("longitude", 21, 30, "double"),
    ("variable", 31, 35, "string"),
    ("first_year", 36, 40, "bigint"),
    ("last_year", 41, 45, "bigint"),
)
ALTITUDE_FIELDS = (
    ("station_id", 0, 12, "string"),
    ("altitude", 31, 37, "double"),
)
