"""Helpers that several operators share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyledger.session import materialize, scratch_path

__all__ = ["materialize", "scratch_path"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(text: Column) -> Column:
    """MD5 of a text in hex; that of the empty text for NULL."""
    return F.md5(F.coalesce(text.cast("binary"), F.lit(b"")))


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """``name`` of ``df``, whatever its case, or NULL where ``df`` has no such column."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcasts ``value``, of bounded size, with its classes; a task calls what it gets for it."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)


def map_texts(
    df: DataFrame,
    per_text: Callable[[bytes], tuple],
    fields: str,
    column: str = "text",
) -> DataFrame:
    """The columns of ``df`` except ``column``, and ``fields`` that ``per_text`` makes of it.

    ``per_text`` gets the UTF-8 bytes of a whole text, empty for NULL. It runs in
    tasks over Arrow batches; rows stay in their partition.
    """
    kept = [f for f in df.schema.fields if f.name != column]
    made = T._parse_datatype_string(fields)
    names = [f.name for f in made.fields]
    kinds = [to_arrow_type(f.dataType) for f in made.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
            rows = [per_text(text.as_py() or b"") for text in texts]
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            arrays += [pa.array([row[i] for row in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                arrays, names=[*(f.name for f in kept), *names]
            )

    return df.mapInArrow(run, T.StructType([*kept, *made.fields]))


def blocks_of_words(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of ``data`` between ASCII blanks, in lists of about ``size`` bytes."""
    start = 0
    while start < len(data):
        end = start + size
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end].split()
        start = end
