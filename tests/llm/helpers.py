"""Small tables for the tests of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Texts that every operator must take: missing, empty, blank, without letters, short, repeated.
ODD = [
    (None, "a row without an id"),
    (101, None),
    (102, ""),
    (103, " \t\n\r\n "),
    (104, "12 34 !!"),
    (105, "one"),
    (106, "two words"),
    (107, "KKelvin Été straße \U0001f600\U0001f600 café́ ½ Ⅷ"),
    (108, "the same row"),
    (108, "the same row"),
    (108, "the same id"),
    (109, "x" * 3000 + " " * 3000 + "é" * 3000),
    (110, "la la la la la la la la la la la la la la la la la la la la la la\n" * 60),
]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``rows`` of (doc_id, text) with columns whose names operators might use themselves."""
    made = [(i, t, "en", n, "x") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        made, "doc_id long, text string, lang string, key int, fingerprint string"
    ).repartition(3)
