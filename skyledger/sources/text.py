"""Fixed-width station lists and the geography CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.columns import known_elevation, without_blanks
from skyledger.schemas import (
    ALTITUDE_FIELDS,
    GEOGRAPHY,
    INVENTORY_FIELDS,
    STATION_FIELDS,
)

Field = tuple[str, int, int, str]


def read_fixed_width(spark: SparkSession, path: str, fields: Sequence[Field]) -> DataFrame:
    """Cut every line, the first included, at the given offsets.

    Blank or unreadable fields, and fields past the end of a line, are NULL.
    """
    columns = []
    for name, start, end, kind in fields:
        text = F.trim(F.substring("value", start + 1, end - start))
        text = F.when(text != "", text)
        columns.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    return spark.read.text(path).select(*columns)


def fixed_width_line(fields: Sequence[Field]) -> Column:
    """The line that ``read_fixed_width`` reads back to the columns of ``fields``.

    A value that is wider than its field fails the write.
    """
    parts: list[Column] = []
    position = 0
    for name, start, end, kind in fields:
        if start > position:
            parts.append(F.lit(" " * (start - position)))
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        pad = F.rpad if kind == "string" else F.lpad
        problem = F.concat(F.lit(f"{name} is wider than {end - start}: "), text)
        fits = F.length(text) <= end - start
        parts.append(F.when(fits, pad(text, end - start, " ")).otherwise(F.raise_error(problem)))
        position = end
    return F.concat(*parts).alias("value")


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    stations = read_fixed_width(spark, path, STATION_FIELDS)
    return stations.withColumn("elevation", known_elevation(F.col("elevation")))


def read_altitudes(spark: SparkSession, path: str) -> DataFrame:
    """Just id and altitude, with blanks inside the id removed."""
    rows = read_fixed_width(spark, path, ALTITUDE_FIELDS)
    return rows.withColumn("station_id", without_blanks(F.col("station_id")))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, INVENTORY_FIELDS)


def read_geography(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return spark.read.schema(GEOGRAPHY).option("header", header).csv(path)
