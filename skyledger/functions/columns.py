"""Column functions of the domain. All of them stay in generated JVM code."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.schemas import UNKNOWN_ELEVATION


def country_code(station_id: Column) -> Column:
    """The first two characters of a station id."""
    return F.substring(station_id, 1, 2)


def parse_day(day: Column) -> Column:
    """An int ``yyyyMMdd`` as a date; NULL when there is no such day."""
    return F.try_to_date(day.cast("string"), "yyyyMMdd")


def ratio(total: Column, n: Column) -> Column:
    """``total / n``; NULL for an empty group."""
    return F.try_divide(total, n)


def known_elevation(elevation: Column) -> Column:
    return F.nullif(elevation.cast("double"), F.lit(UNKNOWN_ELEVATION))


def without_blanks(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def between_years(day: Column, after: int | None, before: int | None) -> Column:
    """``after < year < before``, as a date range the scan can push down."""
    condition = F.lit(True)
    if after is not None:
        condition = condition & (day >= F.lit(datetime.date(after + 1, 1, 1)))
    if before is not None:
        condition = condition & (day < F.lit(datetime.date(before, 1, 1)))
    return condition
