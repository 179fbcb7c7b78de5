"""Live event envelopes, one JSON object per line, as a stream or a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..model.payloads import ENVELOPE


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).json(path)


def stream_envelopes(
    spark: SparkSession, path: str, *, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """Unbounded source over a folder that event files are dropped into.

    ``max_files`` or ``max_bytes`` bound one micro-batch.
    """
    reader = spark.readStream.schema(ENVELOPE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)
