"""Landed Parquet datasets and the files they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model.specs import TableSpec


def read_landed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A partitioned dataset; partition folders become columns and prune."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_named(spark: SparkSession, root: str, suffix: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files below ``root`` whose file name ends in ``suffix``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").parquet(root)


def load_bronze(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The declared columns of a landed dataset, in declared order and type."""
    return read_landed(spark, path, spec.struct()).select(spec.names)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``; only the listing is read, never the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(
        F.col("path").alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        F.lit(False).alias("is_dir"),
    )
