"""Counts and summaries over tables, files, runs and the chat workspace."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.landed import list_files
from .tables import list_tables, list_views


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """``name, type, rows`` of each frame; a Parquet count reads footers only."""
    counts = [
        t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), F.lit("table").alias("type"), "rows")
        for n, t in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def family_stats(spark: SparkSession, family: str) -> DataFrame:
    """Rows and column count of the family's tables that exist."""
    names = list_tables(spark, f"bronze_{family}_")
    if not names:
        return spark.createDataFrame([], "name string, type string, rows long, columns int")
    frames = {n: spark.table(n) for n in names}
    widths = F.create_map(*[F.lit(x) for n, t in frames.items() for x in (n, len(t.columns))])
    return table_stats(frames).withColumn("columns", widths[F.col("name")].cast("int"))


def overview(spark: SparkSession) -> DataFrame:
    """All tables with their rows, then all views without."""
    views = spark.createDataFrame([(v, "view", None) for v in list_views(spark)], "name string, type string, rows long")
    names = list_tables(spark)
    return table_stats({n: spark.table(n) for n in names}).unionAll(views) if names else views


def storage_stats(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Files, bytes and megabytes below each named root."""

    def one(dataset: str, root: str) -> DataFrame:
        size = F.coalesce(F.sum("size"), F.lit(0))
        return (
            list_files(spark, root)
            .agg(F.count(F.lit(1)).alias("total_objects"), size.alias("total_size_bytes"))
            .select(
                F.lit(dataset).alias("dataset"), "total_objects", "total_size_bytes",
                F.round(F.col("total_size_bytes") / (1024 * 1024), 2).alias("total_size_mb"),
            )
        )

    return reduce(DataFrame.unionAll, [one(d, r) for d, r in roots.items()])


def run_summary(report: DataFrame, status: str = "status", records: str = "records") -> DataFrame:
    """One row: runs in total and by status, and the records they moved."""

    def ended(as_: str) -> Column:
        return F.count_if(F.col(status) == as_).alias(as_)

    return report.agg(
        F.count(F.lit(1)).alias("total"),
        *[ended(s) for s in ("completed", "failed", "running", "pending", "paused")],
        F.coalesce(F.sum(records), F.lit(0)).alias("total_records"),
    )


def describe_dataset(rows: DataFrame, name: str, files: bool = True) -> DataFrame:
    """One row per column, with the dataset's rows, columns and (for file scans) files."""
    parts = F.count_distinct("_metadata.file_path") if files else F.lit(None).cast("long")
    stats = rows.agg(F.count(F.lit(1)).alias("num_rows"), parts.alias("num_files"))
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable"),
            )
            for i, f in enumerate(rows.schema.fields, 1)
        ]
    )
    return stats.select(
        F.lit(name).alias("dataset"), "num_rows", F.lit(len(rows.columns)).alias("num_columns"), "num_files",
        F.inline(columns),
    )


def channel_counts(messages: DataFrame, channels: DataFrame) -> DataFrame:
    """Messages per channel; a channel without messages counts 0."""
    counts = messages.groupBy("channel_id").agg(F.count(F.lit(1)).alias("message_count"))
    named = channels.select(F.col("id").alias("channel_id"), "name")
    return named.join(counts, "channel_id", "left").select(
        "channel_id", "name", F.coalesce("message_count", F.lit(0).cast("long")).alias("message_count")
    )


def workspace_totals(channels: DataFrame, users: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per kind of object: ``channels``, ``users``, ``messages``."""
    return table_stats({"channels": channels, "users": users, "messages": messages}).select("name", "rows")
