"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, *columns: str, fmt: str = "parquet") -> None:
    """One folder per value, for row-level data.

    The rebalance gathers each value into few files, and AQE splits the
    partition of a value that owns much of the data over many tasks.
    """
    balanced = df.hint("rebalance", *[F.col(c) for c in columns])
    balanced.write.mode("overwrite").format(fmt).partitionBy(*columns).save(path)


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Write the folders of the values that ``df`` has; the folders of other values stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*columns).parquet(path)


def write_ranges(df: DataFrame, path: str, column: str, ranges: int = 4) -> None:
    """One folder per value, range-partitioned first; for small result tables."""
    (
        df.repartitionByRange(ranges, column)
        .write.mode("overwrite")
        .partitionBy(column)
        .parquet(path)
    )


def write_single_csv(df: DataFrame, path: str) -> None:
    """A single file with a header; for final results of a few rows."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
