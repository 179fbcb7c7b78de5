"""Folders and small text files on the file system that a path names, without a Spark job."""

from __future__ import annotations

import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[Any, Any]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _open(spark, path)
    return files.exists(at)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it isn't there."""
    files, at = _open(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, at = _open(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not be there yet, whole or not at all; whoever comes second gets a FileExistsError."""
    files, at = _open(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    # unlike a file system's own rename, that of a file context never replaces
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(at), options)
    except Py4JJavaError as e:
        files.delete(draft, False)
        if files.exists(at):
            raise FileExistsError(path) from e
        raise


def delete(spark: SparkSession, path: str) -> None:
    files, at = _open(spark, path)
    files.delete(at, True)


class Versions:
    """Numbered versions of a small dataset, a folder each; one counts once it is whole."""

    def __init__(self, spark: SparkSession, folder: str, kept: int = 8):
        self.spark, self.folder, self.kept = spark, folder, kept

    def numbers(self) -> list[int]:
        found = [n for n in children(self.spark, self.folder) if n.startswith("version=")]
        return [int(n[8:]) for n in found if exists(self.spark, f"{self.folder}/{n}/_SUCCESS")]

    def newest(self) -> int | None:
        return max(self.numbers(), default=None)

    def path(self, number: int) -> str:
        return f"{self.folder}/version={number:012d}"

    def write(self, rows, number: int) -> None:
        """Write a version, replacing what an attempt at it left, and drop old ones."""
        rows.write.mode("overwrite").parquet(self.path(number))
        for old in sorted(self.numbers())[: -self.kept]:
            delete(self.spark, self.path(old))
