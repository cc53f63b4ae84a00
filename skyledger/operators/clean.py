"""From raw messages to clean readings, for tables and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.columns import parse_day
from skyledger.schemas import READING

CLEAN_FIELDS = ("StationId", "Date", "Variable", "Value", "Q_Flag")


def parse_messages(messages: DataFrame, schema: T.StructType = READING) -> DataFrame:
    """JSON text or bytes in ``value`` to one column per field of ``schema``.

    The fields come out of a generator, because filters on them would otherwise
    move below the projection and parse the text once more per condition.
    """
    text = F.col("value").cast("string")
    return messages.select(F.inline(F.array(F.from_json(text, schema))))


def clean(raw: DataFrame) -> DataFrame:
    """Unflagged readings as ``station_id, obs_date, variable, value``.

    A line that is not JSON parses to a row of NULLs, which would pass the
    quality test, so rows without station or variable are dropped as well.
    """
    return raw.filter(
        F.col("Q_Flag").isNull() & F.col("StationId").isNotNull() & F.col("Variable").isNotNull()
    ).select(
        F.col("StationId").alias("station_id"),
        parse_day(F.col("Date")).alias("obs_date"),
        F.col("Variable").alias("variable"),
        F.col("Value").alias("value"),
    )


def sorted_messages(messages: DataFrame) -> DataFrame:
    """Every message with what becomes of it in ``status``, and its reading.

    ``unparsable``: not JSON, or without station or variable; ``flagged``: it failed a quality
    test; ``kept``: the rows of ``clean_messages``. The text stays in ``message`` for those
    that are not kept. Each message is parsed once.
    """
    fields = T.StructType([READING[f] for f in CLEAN_FIELDS])
    text = F.col("value").cast("string")
    found = F.struct(text.alias("message"), F.from_json(text, fields).alias("reading"))
    parsed = messages.select(F.inline(F.array(found))).select("message", "reading.*")
    unparsable = F.col("StationId").isNull() | F.col("Variable").isNull()
    status = F.when(unparsable, "unparsable").when(F.col("Q_Flag").isNotNull(), "flagged").otherwise("kept")
    kept = status == "kept"
    return parsed.select(
        status.alias("status"),
        F.when(~kept, F.col("message")).alias("message"),
        *[F.when(kept, c).alias(n) for n, c in (
            ("station_id", F.col("StationId")),
            ("obs_date", parse_day(F.col("Date"))),
            ("variable", F.col("Variable")),
            ("value", F.col("Value")),
        )],
    )


def clean_messages(messages: DataFrame) -> DataFrame:
    """Parse just the fields that cleaning needs, and clean."""
    return clean(parse_messages(messages, T.StructType([READING[f] for f in CLEAN_FIELDS])))
