"""The corpus pipeline: documents in, encoded clean documents out.

Each stage takes the documents that its predecessor kept and returns a table with
the columns of ``documents``; the last returns ids and digests. ``run`` writes what a
stage returns as Parquet and reads it again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, copies, decontam, langid, lines
from skyledger.llm.common import materialize, read_table

#: The least share of a text's words that its language must have.
LEAST_SHARE = 0.5
#: Benchmark items of fewer words are passed over: texts hold them by chance. ``decontam.too_short``
#: lists them.
LEAST_ITEM_WORDS = 8


def with_text(names: list[str], text: Column) -> list[Column]:
    """The columns ``names`` with another text, and its length where they have ``n_chars``."""
    columns = []
    for name in names:
        if name == "text":
            columns.append(text.alias(name))
        elif name == "n_chars":
            columns.append(F.length(text).cast("long").alias(name))
        else:
            columns.append(F.col(name))
    return columns


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; an unknown ``lang`` becomes what is found.

    Texts without a letter go, and those of which no language has ``LEAST_SHARE`` of the
    words. The model learns from the labelled documents that are not held out.
    """
    model = langid.trained_on_rest(docs)
    found = langid.identify(docs, model, keep_text=True)
    kept = found.filter((F.col("__lang") != langid.UNDETERMINED) & (F.col("__score") >= LEAST_SHARE))
    lang = F.coalesce("lang", "__lang").alias("lang")
    return kept.select(*[lang if c == "lang" else F.col(c) for c in docs.columns])


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later occurrences of three lines; those that lose all lines go."""
    found = lines.remove_repeated(docs)
    kept = found.filter((F.col("__n_removed") == 0) | (F.col("__n_removed") < F.col("__n_lines")))
    return kept.select(*with_text(docs.columns, F.col("text")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    Near copies share four fifths of their five-word shingles. Texts that are NULL or have no
    words are copies of each other. A row without an id stays only where no other of its group
    has one; of rows that agree in id and text one stays.
    """
    return copies.keep_one(docs)


def benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item of ``LEAST_ITEM_WORDS`` words or more.

    Texts that are NULL or empty have none and stay, as do repeated rows and those without an id.
    """
    benchmark = read_table(spark, sf_dir, "benchmark")
    found = decontam.scan(docs, benchmark, keep_text=True, least_words=LEAST_ITEM_WORDS)
    return found.filter(F.size("__leaks") == 0).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids, and digests of the ids and of what they decode to.

    A NULL text counts as empty and has no ids. Each row gives one, repeated ones too; columns
    other than ``doc_id`` and ``text`` end here.
    """
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        F.size("__ids").cast("long").alias("n_tokens"),
        F.col("__ids").alias("ids"),
        F.col("__ids_sha256").alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("__ids"), path), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", languages),
    ("line dedup", repeated_lines),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_copies),
    ("byte-level BPE", encoded),
]

#: No SQL: language ID is a trained model. The tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage gives for the table of documents."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
