"""The live path: event files to deduplicated rows, marks and counters, exactly once."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model.specs import CHAT
from ..operators.events import MESSAGE_EVENT, classify_events, drop_handshake, event_kind
from ..operators.files import exists
from ..operators.incremental import high_water_marks, latest_per_key
from ..sources.events import stream_envelopes

EVENTS = CHAT["realtime_events"]
MARKS_SCHEMA = "channel_id string, mark string"
COUNTS_SCHEMA = "event_type string, events long"
#: How many versions of totals stay readable after they were replaced.
KEPT_VERSIONS = 32


def drop_repeats(events: DataFrame, horizon: str | None) -> DataFrame:
    """Each ``envelope_id`` once; events without one are all kept.

    The watermark runs on arrival time, which never moves backwards, so it bounds the ids
    held in state without ever dropping an event as late. ``horizon`` is how long after an
    event its redelivery is still recognised; None keeps every id for good.
    """
    # An event without an id gets one of its own: it repeats nothing.
    keyed = events.withColumn(
        "_id", F.when(F.col("envelope_id") != "", F.col("envelope_id")).otherwise(F.concat(F.lit("~"), F.uuid()))
    )
    if horizon is None:
        return keyed.dropDuplicates(["_id"]).drop("_id")
    arrived = keyed.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", horizon)
    return arrived.dropDuplicatesWithinWatermark(["_id"]).drop("_id", "_arrived")


def _trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def _envelopes(spark: SparkSession, source: str | DataFrame, **bounds) -> DataFrame:
    return source if isinstance(source, DataFrame) else stream_envelopes(spark, source, **bounds)


def start_event_stream(
    spark: SparkSession,
    source: str | DataFrame,
    sink: str,
    checkpoint: str,
    *,
    load_date: Column | None = None,
    interval: str | None = "10 seconds",
    max_files: int | None = 1000,
    max_bytes: str | None = None,
    horizon: str | None = "1 day",
) -> StreamingQuery:
    """Classify, deduplicate and land live events.

    ``source`` is a folder of event files, or a streaming frame of envelopes from elsewhere,
    such as parsed message-queue values.

    A batch starts every ``interval`` and takes at most ``max_files`` or ``max_bytes``; with
    no interval the query drains what is there and ends. Stopping the query and starting it
    again on the same ``checkpoint`` is pause and resume.

    A batch is written as ``events/processing_date=<day>/run=<query>/batch_id=<n>``, replacing
    what an earlier attempt at it left, and then the marks of all channels so far. The query's
    id lives in its checkpoint, so a new checkpoint on the same sink adds to it.
    """
    day = load_date if load_date is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    envelopes = _envelopes(spark, source, max_files=max_files, max_bytes=max_bytes)
    events = drop_repeats(classify_events(envelopes, day), horizon)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = _run(batch.sparkSession), batch_id
        rows = batch.hint("rebalance", "channel_id", "message_ts").withColumns({"run": F.lit(own[0]), "batch_id": F.lit(batch_id)})
        rows = rows.sortWithinPartitions("processing_date", "channel_id")
        seen = Observation()
        days = F.collect_set("processing_date").alias("days")  # a batch is of a day or a few
        _overwrite(rows.observe(seen, days), f"{sink}/events", "processing_date", "run", "batch_id")
        landed = _landed(spark, sink, [f"processing_date={_folder(d)}/run={own[0]}/batch_id={batch_id}" for d in seen.get["days"]])
        messages = landed.where((F.col("event_type") == MESSAGE_EVENT) & (F.col("channel_id") != ""))
        marks = high_water_marks(messages, "channel_id", "message_ts")
        before = _totals(spark, f"{sink}/marks", MARKS_SCHEMA, but=own)
        merged = high_water_marks(marks.unionByName(before), "channel_id", "mark")
        _write_version(merged, f"{sink}/marks", own)

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def start_event_counters(
    spark: SparkSession,
    source: str | DataFrame,
    sink: str,
    checkpoint: str,
    *,
    interval: str | None = "10 seconds",
    max_files: int | None = 1000,
    max_bytes: str | None = None,
) -> StreamingQuery:
    """Running number of events by type, unknown types included, greetings not.

    Counted as received, redeliveries too. Each batch writes all totals.
    """
    envelopes = drop_handshake(_envelopes(spark, source, max_files=max_files, max_bytes=max_bytes))
    totals = envelopes.groupBy(event_kind().alias("event_type")).agg(F.count(F.lit(1)).alias("events"))

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_version(batch, sink, (_run(batch.sparkSession), batch_id))

    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def _run(spark: SparkSession) -> str:
    """Id of the streaming query whose batch this thread writes."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _overwrite(rows: DataFrame, folder: str, *by: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(folder)


def _folder(day: str) -> str:
    """A day as its folder is named; anything but digits and dashes would be written otherwise."""
    if not re.fullmatch("[0-9-]+", day):
        raise ValueError(f"a load date is digits and dashes, not {day!r}")
    return day


def _landed(spark: SparkSession, sink: str, folders: list[str] | None = None) -> DataFrame:
    """Landed events; of these folders only, without a look at any other."""
    schema = EVENTS.struct().add("run", "string").add("batch_id", "long")
    if folders is None:
        return spark.read.schema(schema).parquet(f"{sink}/events")
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{sink}/events").parquet(*[f"{sink}/events/{f}" for f in folders])


def read_days(spark: SparkSession, sink: str, days: list[str]) -> DataFrame:
    """Landed live events of some days, one row per envelope within them; lists no other day's folders."""
    there = [f"processing_date={_folder(d)}" for d in days]
    there = [f for f in there if exists(spark, f"{sink}/events/{f}")]
    return latest_per_key(_landed(spark, sink, there).select(EVENTS.names), ["envelope_id"], [])


def read_events(spark: SparkSession, sink: str) -> DataFrame:
    """All landed live events, one row per envelope, in the shape of the live events table.

    The stream drops redeliveries within its horizon; later ones are dropped here.
    """
    return latest_per_key(_landed(spark, sink).select(EVENTS.names), ["envelope_id"], [])


def read_marks(spark: SparkSession, sink: str) -> DataFrame:
    """Highest message time per channel over all batches."""
    return _totals(spark, f"{sink}/marks", MARKS_SCHEMA)


def read_counters(spark: SparkSession, sink: str) -> DataFrame:
    """The totals as of the newest batch."""
    return _totals(spark, sink, COUNTS_SCHEMA)


# Totals are kept as numbered versions, a folder each, named by the batch that wrote it. A frame
# reads one version; it stays until 32 newer ones are there, and reading it later is an error.


def _versions(spark: SparkSession, folder: str) -> list[tuple[int, str, int, str]]:
    """Number, run, batch and path of the versions that are complete, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = []
    for status in files.listStatus(path):
        at = status.getPath()
        parts = at.getName().split(".")
        if len(parts) == 3 and files.exists(spark._jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")):
            found.append((int(parts[0]), parts[1], int(parts[2]), at.toString()))
    return sorted(found)


def _totals(spark: SparkSession, folder: str, schema: str, but: tuple[str, int] | None = None) -> DataFrame:
    """The newest version, but not that of the batch ``but``, which is being repeated."""
    held = [v for v in _versions(spark, folder) if v[1:3] != but]
    return spark.read.schema(schema).parquet(held[-1][3]) if held else spark.createDataFrame([], schema)


def _write_version(totals: DataFrame, folder: str, own: tuple[str, int]) -> None:
    spark = totals.sparkSession
    held = _versions(spark, folder)
    number = held[-1][0] + 1 if held else 0
    totals.hint("rebalance").write.mode("overwrite").parquet(f"{folder}/{number:012d}.{own[0]}.{own[1]}")
    for _, _, _, old in held[:-KEPT_VERSIONS]:
        path = spark._jvm.org.apache.hadoop.fs.Path(old)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def counter_totals(counters: DataFrame) -> DataFrame:
    """One row: events in total and message events."""
    messages = F.sum(F.when(F.col("event_type") == MESSAGE_EVENT, F.col("events")).otherwise(0))
    return counters.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
        F.coalesce(messages, F.lit(0)).alias("total_messages"),
    )


def count_flushes(spark: SparkSession, sink: str) -> int:
    """Number of batches that landed events; reads folder names only."""
    return _landed(spark, sink).select("run", "batch_id").distinct().count()
