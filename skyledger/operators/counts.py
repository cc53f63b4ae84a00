"""Exact medians of groups from mergeable states.

A state counts every value of a group. States of any split of the input add up, so medians
can be read whenever they are wanted; a state is as large as its group has different values,
which for readings in whole tenths has a bound that does not depend on their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(rows: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """``n`` of each value per group; NULLs are no values."""
    known = rows.filter(F.col(value).isNotNull())
    return known.groupBy(*keys, value).agg(F.count("*").alias("n"))


def merge_counts(counts: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    return counts.groupBy(*keys, value).agg(F.sum("n").alias("n"))


def medians_of(counts: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """The median of every group, between the two middle values of an even number, and ``n``."""
    return counts.groupBy(*keys).agg(
        F.percentile(value, 0.5, F.col("n")).alias("median"), F.sum("n").alias("n")
    )
