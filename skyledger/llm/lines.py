"""Line dedup by overlapping windows of three lines.

A window is three consecutive lines that hold a word; lines without one stand
between them unnoticed. Of all places where a window stands, in the order of the
documents, the first one stays and the others are removed, whatever other windows
they overlap with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import digest, materialize

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _filled(lines: Column) -> Column:
    """The lines that hold a word, with their places."""
    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    return F.filter(numbered, lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"))


def occurrences(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest``, ``at``, ``window``: every window of every text.

    ``at`` counts the lines that hold a word. A window is known by its MD5.
    """
    rows = docs.select(
        "doc_id", digest(F.col("text")).alias("digest"), _filled(_lines(F.col("text"))).alias("f")
    ).filter(F.size("f") >= WINDOW)

    def window(i: Column) -> Column:
        parts = [F.get(F.col("f"), i + k)["line"] for k in range(WINDOW)]
        return F.struct(i.alias("at"), F.unhex(F.md5(F.concat_ws("\n", *parts))).alias("window"))

    places = F.sequence(F.lit(0), F.size("f") - WINDOW)
    found = rows.select("doc_id", "digest", F.explode(F.transform(places, window)).alias("w"))
    return found.select("doc_id", F.unhex("digest").alias("digest"), "w.at", "w.window")


def covered(places: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` and ``lines``: which lines later occurrences cover, merged.

    The first occurrence is that of the smallest ``doc_id`` (NULL last), then of the
    smallest digest of the text, then the first in the text. Rows that agree in id and
    text are one document. A later occurrence that overlaps the first one of its
    window covers only what lies behind that.
    """
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "at")
    ends = places.groupBy("window").agg(F.min(order).alias("first"), F.max(order).alias("final"))
    repeated = ends.filter(F.col("first") != F.col("final")).select("window", "first")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("digest") == F.col("first.digest")
    )
    begin = F.when(same, F.greatest("at", F.col("first.at") + WINDOW)).otherwise(F.col("at"))
    later = (
        places.join(repeated, "window")
        .filter(~(same & (F.col("at") == F.col("first.at"))))
        .withColumn("begin", begin)
        .filter(F.col("begin") < F.col("at") + WINDOW)
    )
    lines = later.select(
        "doc_id",
        "digest",
        F.explode(F.sequence("begin", F.col("at") + WINDOW - 1)).alias("line"),
    )
    return lines.groupBy("doc_id", "digest").agg(F.collect_set("line").alias("lines"))


def remove_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, ``text`` without repeated windows, and two counts.

    ``__n_lines`` counts the lines that hold a word, ``__n_removed`` those of them that
    went. Texts that lose no line, NULL among them, stay as they are; a text can lose
    all its lines. Texts of fewer than three lines have no window.
    """
    gone = covered(materialize(occurrences(docs), "windows")).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("lines").alias("__gone")
    )
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("__row"),
        docs["doc_id"].alias("__doc"),
        F.unhex(digest(docs["text"])).alias("__of"),
    )
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__digest"))
    joined = rows.join(gone, same, "left").select("__row", "__gone")
    lines = joined.withColumn("__lines", _lines(F.col("__row.text")))
    filled = lines.withColumn("__filled", _filled(F.col("__lines")))
    out = F.transform("__gone", lambda k: F.get(F.col("__filled"), k)["i"])
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), out)
    text = F.concat_ws("\n", F.transform(left, lambda i: F.get(F.col("__lines"), i)))
    text = F.when(F.col("__gone").isNull(), F.col("__row.text")).otherwise(text)
    columns = [
        text.alias(c) if c == "text" else F.col("__row").getField(c).alias(c) for c in docs.columns
    ]
    counts = [
        F.size("__filled").cast("long").alias("__n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("__n_removed"),
    ]
    return filled.select(*columns, *counts)
