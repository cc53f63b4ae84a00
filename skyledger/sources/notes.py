"""Small text files in shared folders, which the driver writes without a Spark job."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """A path and its file system, as Spark knows it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A new file. It is written under another name first, so that nobody reads half of it."""
    folder, _, name = path.rpartition("/")
    target, system = _open(spark, path)
    draft, _ = _open(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(target) or not system.rename(draft, target):
        system.delete(draft, False)
        raise FileExistsError(path)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a file; None if it is not there."""
    target, system = _open(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Files and folders of a folder, without hidden ones, in order."""
    target, system = _open(spark, folder)
    if not system.exists(target):
        return []
    names = (status.getPath().getName() for status in system.listStatus(target))
    return sorted(n for n in names if not n.startswith((".", "_")))


def bytes_of(spark: SparkSession, path: str) -> int:
    target, system = _open(spark, path)
    return system.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    target, system = _open(spark, path)
    system.delete(target, True)
