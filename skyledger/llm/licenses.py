"""License scans: phrases by place, and templates by an exact set-similarity join.

A block is a window of consecutive words, over line ends and whatever else stands between
words, at most ``STRETCH`` times as long as the template. A template is found in a block that
has at least ``THRESHOLD`` of the template's different words, the template's own words (by
which it differs from others) among them. Words are ordered by how few texts have them; a
block that has enough of a template has one of the first words of the template in that order.
So only the surroundings of such a word are joined with templates, filtered by how many words
they can share at all and by position, and verified window by window.

A NULL or empty text has no words and no labels. Texts of any length are scanned whole, and no
more than the surroundings of a word are held for each place. Repeated rows come back as many
as they are.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import digest, materialize

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
THRESHOLD = 0.8

# The phrases of the contract.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: The words of a block, as a multiple of those of the template.
STRETCH = 1.25

# Sentences by which licenses are granted or named, and the words of each that a
# block must have.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2 0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this "
        "file except in compliance with the License.",
        "apache 2 0",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu general 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation",
        "gnu general",
    ),
    ("mit", "Released under the MIT License.", "mit"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without "
        "restriction",
        "charge restriction",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", "cc by nc"),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "creative commons attribution",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "redistribution binary",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "mozilla 2",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted",
        "fee",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain.",
        "unencumbered public domain",
    ),
]


@dataclass(frozen=True)
class Template:
    label: str
    words: list[str]  # each once
    own: list[str]
    need: int  # the least number of its words in a block
    length: int  # of a block, in words


def words(text: Column) -> Column:
    """The words of a text, with A to Z in lower case; none for NULL."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lower, SEPARATORS, -1), "")


def words_of(text: str) -> list[str]:
    lower = text.translate(str.maketrans(UPPER, UPPER.lower()))
    return [w for w in re.split(SEPARATORS, lower) if w]


def templates() -> list[Template]:
    found = []
    for label, text, own in TEMPLATES:
        all_words = words_of(text)
        different = sorted(set(all_words))
        need = math.ceil(THRESHOLD * len(different) - 1e-9)
        found.append(Template(label, different, own.split(), need, math.ceil(STRETCH * len(all_words))))
    return found


def vocabulary() -> list[str]:
    return sorted({w for t in templates() for w in t.words})


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_order(docs: DataFrame) -> dict[str, int]:
    """The words of all templates from the rarest, counted over all texts of ``docs``.

    The driver gets a row for each word of the templates at most.
    """
    known = vocabulary()
    found = docs.select(F.explode(F.array_intersect(words(F.col("text")), _strings(known))).alias("w"))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}
    ranked = sorted(known, key=lambda w: (counts.get(w, 0), w))
    return {w: i for i, w in enumerate(ranked)}


def _prefixes(spark: SparkSession, order: dict[str, int]) -> DataFrame:
    """An index of the first words of each template in ``order``, a row for each word."""
    rows = []
    for number, t in enumerate(templates()):
        ranked = sorted(t.words, key=order.get)
        for place, word in enumerate(ranked[: len(ranked) - t.need + 1]):
            rows.append((word, number, t.label, place, ranked, t.own, t.need, t.length))
    return spark.createDataFrame(
        rows,
        "word string, template int, label string, place int, words array<string>, own array<string>,"
        " need int, length int",
    )


def _places(phrases: list[str]) -> Column:
    """The places in the column ``w`` at which one of ``phrases`` stands."""

    def stands(i: Column) -> Column:
        either = F.lit(False)
        for phrase in phrases:
            here = F.lit(True)
            for k, word in enumerate(phrase.split()):
                here = here & (F.coalesce(F.get(F.col("w"), i + k), F.lit("")) == word)
            either = either | here
        return either

    last = {phrase.split()[-1] for phrase in phrases}
    some = F.arrays_overlap("w", _strings(sorted(last)))
    return F.when(some, F.filter(F.sequence(F.lit(0), F.size("w") - 1), stands)).otherwise(
        F.array().cast("array<int>")
    )


def block_matches(texts: DataFrame, order: dict[str, int]) -> DataFrame:
    """``texts`` (any columns, and the words ``w``) joined with the templates that they contain.

    Instead of ``w`` they get ``template``, ``label`` and ``score``, the largest share of the
    template's words in a block around some place of one of its first words.
    """
    index = _prefixes(texts.sparkSession, order)
    reach = max(t.length for t in templates())
    firsts = _strings(sorted({r["word"] for r in index.select("word").distinct().collect()}))
    kept = [c for c in texts.columns if c != "w"]
    some = texts.filter(F.arrays_overlap("w", firsts))
    places = F.filter(
        F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.array_contains(firsts, F.get(F.col("w"), i))
    )
    at = some.select(*kept, "w", F.explode(places).alias("__at"))
    low = F.greatest(F.col("__at") - F.lit(reach - 1), F.lit(0))
    around = at.select(
        *kept,
        F.get(F.col("w"), F.col("__at")).alias("__word"),
        F.slice("w", low + 1, F.col("__at") - low + F.lit(reach)).alias("__w"),
        (F.col("__at") - low).alias("__at"),
    )
    index = index.select(*[F.col(c).alias(f"__t_{c}") for c in index.columns])
    joined = around.join(index, F.col("__word") == F.col("__t_word"))
    # What a block around the word has at most: the surroundings' words; and as this is the first
    # of the template's words in order there, only those that follow it in the template.
    shared = F.array_intersect("__t_words", "__w")
    joined = joined.withColumn("__shared", shared).filter(
        (F.size("__shared") >= F.col("__t_need")) & (F.size(F.array_except("__t_own", "__shared")) == 0)
    )
    starts = F.sequence(F.greatest(F.col("__at") - F.col("__t_length") + 1, F.lit(0)), F.col("__at"))
    # A block may begin with a word of the template, else a later one has as many.
    starts = F.filter(starts, lambda i: F.array_contains(F.col("__shared"), F.get(F.col("__w"), i)))

    def shares(i: Column) -> Column:
        block = F.slice("__w", i + 1, F.col("__t_length"))
        found = F.array_intersect("__shared", block)
        enough = (F.size(found) >= F.col("__t_need")) & (F.size(F.array_except("__t_own", found)) == 0)
        return F.when(enough, F.size(found)).otherwise(0)

    verified = joined.withColumn("__most", F.array_max(F.transform(starts, shares))).filter(F.col("__most") > 0)
    return verified.select(
        *kept,
        F.col("__t_template").alias("template"),
        F.col("__t_label").alias("label"),
        (F.col("__most") / F.size("__t_words")).alias("score"),
    )


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, word count, phrase places, labels and score of every text.

    A NULL text has no words and no labels. Rows that agree in id and text are
    scanned as one and come back as many as they are. ``score`` is 1 where a phrase
    stands, else the largest share of a template's words in a block, else 0.
    """
    docs = docs.select("doc_id", "text")
    order = word_order(docs)
    firsts = _strings(sorted({
        w for t in templates() for w in sorted(t.words, key=order.get)[: len(t.words) - t.need + 1]
    }))
    rows = docs.withColumn("w", words(F.col("text")))
    labels = [F.when(F.size(_places([p])) > 0, F.lit(label)) for p, label in PHRASES.items()]
    rows = rows.select(
        "doc_id",
        digest(F.col("text")).alias("digest"),
        F.size("w").cast("long").alias("n_words"),
        _places(list(PHRASES)).alias("places"),
        F.array_compact(F.array(*labels)).alias("base"),
        F.when(F.arrays_overlap("w", firsts), F.col("w")).alias("w"),
    )
    rows = materialize(rows, "scanned")
    some = rows.filter(F.col("w").isNotNull()).select("doc_id", "digest", "w")
    found = block_matches(some, order).groupBy("doc_id", "digest").agg(
        F.collect_set("label").alias("found"), F.max("score").alias("best")
    )
    found = found.select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "found", "best"
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))
    none = F.array().cast("array<string>")
    all_labels = F.array_union("base", F.coalesce("found", none))
    return rows.drop("w").join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(all_labels)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0))
        .otherwise(F.coalesce("best", F.lit(0.0)))
        .alias("score"),
    )
