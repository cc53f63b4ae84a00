"""Mergeable means.

The mean of a group is kept as (sum, count) until the very end, so states of
any split of the input merge to the exact mean. Wide states hold one
``{VAR}_sum, {VAR}_count`` pair per variable. They are conditional aggregates:
one map-side-combined hash aggregation and one shuffle, also on streams, where
a pivot would need two aggregations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import ratio


def wide_state_columns(variables: Sequence[str]) -> list[Column]:
    columns = []
    for v in variables:
        value = F.when(F.col("variable") == v, F.col("value"))
        columns.append(F.sum(value).alias(f"{v}_sum"))
        columns.append(F.count(value).alias(f"{v}_count"))
    return columns


def wide_state(readings: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """One row per key with the state of every variable.

    A variable without readings has sum NULL and count 0.
    """
    return (
        readings.filter(F.col("variable").isin(*variables))
        .groupBy(*keys)
        .agg(*wide_state_columns(variables))
    )


def merge_wide(states: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Add up states. Missing counts, as a pivot leaves them, count as 0."""
    columns = []
    for v in variables:
        columns.append(F.sum(f"{v}_sum").alias(f"{v}_sum"))
        columns.append(F.coalesce(F.sum(f"{v}_count"), F.lit(0)).alias(f"{v}_count"))
    return states.groupBy(*keys).agg(*columns)


def wide_means(states: DataFrame, keys: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Divide once. ``names`` maps a variable to the name of its mean."""
    return states.select(
        *keys,
        *[ratio(F.col(f"{v}_sum"), F.col(f"{v}_count")).alias(n) for v, n in names.items()],
    )


def once_per_batch(states: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Undo replays: rows that repeat a (run, batch, key) are the same state again.

    Needed for append-only targets; partitions overwritten per batch have no
    repeats. Two different states of one (run, batch, key) are an error: another run
    has used the name of this one.
    """
    columns = []
    for name in (f"{v}_{part}" for v in variables for part in ("sum", "count")):
        low, high, known = F.min(name), F.max(name), F.count(name)
        same = low.eqNullSafe(high) & known.isin(F.lit(0), F.count("*"))
        problem = F.lit(f"different states of {name} for one run, batch and key")
        columns.append(F.when(same, high).otherwise(F.raise_error(problem)).alias(name))
    return states.groupBy("run_id", "batch_id", *keys).agg(*columns)


def mean_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Long form: ``total, n`` per key."""
    return df.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(value).alias("n"))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return states.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def merge_weighted(averages: DataFrame, keys: Sequence[str], mean: str, weight: str) -> DataFrame:
    """Merge per-batch means by their weights: sum(mean * weight) / sum(weight)."""
    return (
        averages.filter(F.col(weight) > 0)
        .groupBy(*keys)
        .agg(
            ratio(F.sum(F.col(mean) * F.col(weight)), F.sum(weight)).alias(mean),
            F.sum(weight).alias(weight),
        )
    )
