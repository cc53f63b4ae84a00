"""SQL tables over JDBC. The caller passes url, user and password."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Connections of a write, unless the caller says otherwise.
CONNECTIONS = 16


@dataclass(frozen=True)
class Split:
    """Read ``parts`` ranges of a numeric, date or timestamp column in parallel."""

    column: str
    lower: str
    upper: str
    parts: int


def read_options(table: str, connection: dict[str, str], split: Split | None) -> dict[str, str]:
    options = {**connection, "dbtable": table}
    if split is not None:
        options.update(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.parts),
        )
    return options


def write_options(table: str, connection: dict[str, str], connections: int) -> dict[str, str]:
    return {
        "batchsize": "10000",
        "numPartitions": str(connections),
        **connection,
        "dbtable": table,
    }


def read_table(
    spark: SparkSession, table: str, connection: dict[str, str], split: Split | None = None
) -> DataFrame:
    """Filters and column selections on the result run in the database."""
    return spark.read.format("jdbc").options(**read_options(table, connection, split)).load()


def append_table(
    df: DataFrame, table: str, connection: dict[str, str], connections: int = CONNECTIONS
) -> None:
    options = write_options(table, connection, connections)
    df.write.format("jdbc").mode("append").options(**options).save()


def overwrite_table(
    df: DataFrame, table: str, connection: dict[str, str], connections: int = CONNECTIONS
) -> None:
    """Replace the rows and keep the table definition."""
    options = {**write_options(table, connection, connections), "truncate": "true"}
    df.write.format("jdbc").mode("overwrite").options(**options).save()
