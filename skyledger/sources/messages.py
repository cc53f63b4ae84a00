"""Reading messages by topic, one topic per country, bounded or as a stream.

Both readers return ``topic`` and ``value``; a topic list is at once a union of
topics and a country filter. The broker reader needs Spark's Kafka connector on
the class path.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_FILE = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("topic", T.StringType())]
)


def topic_list(topics: str | Sequence[str]) -> list[str]:
    """Accepts a list or text such as ``"EZ, US, CH"``."""
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    return [n.strip() for n in names if n.strip()]


def broker_options(
    servers: str, topics: str | Sequence[str], per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topic_list(topics)),
        "startingOffsets": "earliest",
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_broker(
    spark: SparkSession,
    servers: str,
    topics: str | Sequence[str],
    stream: bool = False,
    per_trigger: int | None = None,
    **extra: str,
) -> DataFrame:
    options = {**broker_options(servers, topics, per_trigger if stream else None), **extra}
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load().select("topic", "value")


def read_topic_files(
    spark: SparkSession,
    path: str,
    topics: str | Sequence[str] | None = None,
    stream: bool = False,
    files_per_trigger: int | None = None,
    report: bool = False,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Text files under ``topic=<name>`` folders; files of other topics are not read.

    A micro-batch has at most so many files, or so many bytes (but at least one file).

    A topic without messages is an error for a table, or a warning with ``report``. A
    stream may wait for it.
    """
    reader = (spark.readStream if stream else spark.read).schema(MESSAGE_FILE)
    if stream and files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if stream and bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    rows = reader.text(path).select("topic", "value")
    if topics is None:
        return rows
    names = topic_list(topics)
    if not stream and (absent := [n for n in names if rows.filter(F.col("topic") == n).isEmpty()]):
        problem = f"no messages of {', '.join(absent)} under {path}"
        if not report:
            raise ValueError(problem)
        warnings.warn(problem, stacklevel=2)
    return rows.filter(F.col("topic").isin(*names))
