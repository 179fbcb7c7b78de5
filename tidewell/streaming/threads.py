"""Live thread replies with their parents: a stream-stream join with bounded state on both sides.

A reply and the message it answers come as separate events, in any order and minutes apart. Replies
wait for their parent for ``wait`` after they arrived, parents are held for ``keep``. A reply that
finds no parent in that time is not lost: it goes to a side output, to be looked up in the landed
history with :func:`settle_orphans`, which has the parents older than ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import epoch, is_blank
from ..operators.events import MESSAGE_EVENT, classify_events
from ..operators.files import exists
from ..operators.incremental import latest_per_key
from ..operators.joins import join_on
from .events import _envelopes, _overwrite, _run, _trigger

#: A reply's own columns, and those of its parent.
REPLY = ["channel_id", "message_ts", "thread_ts", "user_id", "text", "envelope_id"]
PARENT = ["parent_user_id", "parent_text"]
#: Where a reply's parent was found: in the live feed, in the history, or not at all.
MATCHED, SETTLED, ORPHAN = "matched", "history", "orphan"
SCHEMA = ", ".join(f"{c} string" for c in [*REPLY, *PARENT, "outcome", "run"]) + ", batch_id long"


def is_reply() -> Column:
    """Whether a message event answers another; a thread's first message may name itself."""
    own = epoch(F.col("message_ts")).eqNullSafe(epoch(F.col("thread_ts")))
    return ~is_blank(F.col("thread_ts")) & ~own


def join_threads(events: DataFrame, *, keep: str, wait: str, parts: int = 8) -> DataFrame:
    """Replies with their parents; without one when none arrived in time.

    ``events`` are classified events with the time ``arrived``, which must not run backwards from
    one batch to the next. Its watermark therefore never drops an event as late; it only tells
    which rows of the state can go.

    The replies of a thread are dealt to ``parts`` keys and its one parent goes to each, so a
    thread that holds a large part of the feed is joined by as many tasks.
    """
    messages = events.where(F.col("event_type") == MESSAGE_EVENT).withWatermark("arrived", "0 seconds")
    # The condition names the watermark's column to stay above it: both sides then see the times
    # of all messages, and a batch with replies only lets parents go as well.
    there = F.col("arrived").isNotNull()
    replies = messages.where(F.when(there, is_reply())).select(
        *REPLY, "arrived", F.pmod(F.xxhash64("message_ts", "envelope_id"), F.lit(parts)).cast("int").alias("_part")
    )
    parents = messages.where(F.when(there, ~is_reply())).select(
        F.col("channel_id").alias("_channel"),
        F.col("message_ts").alias("_ts"),
        F.col("user_id").alias("parent_user_id"),
        F.col("text").alias("parent_text"),
        F.col("arrived").alias("_since"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_of"),
    )
    same = (F.col("channel_id") == F.col("_channel")) & (F.col("thread_ts") == F.col("_ts")) & (F.col("_part") == F.col("_of"))
    in_time = F.expr(f"_since >= arrived - interval {keep} AND _since <= arrived + interval {wait}")
    outcome = F.when(F.col("_ts").isNotNull(), MATCHED).otherwise(ORPHAN).alias("outcome")
    return replies.join(parents, same & in_time, "left_outer").select(*REPLY, *PARENT, outcome)


def start_thread_stream(
    spark: SparkSession,
    source: str | DataFrame,
    sink: str,
    checkpoint: str,
    *,
    keep: str = "1 day",
    wait: str = "10 minutes",
    parts: int = 8,
    clock: Column | None = None,
    interval: str | None = "10 seconds",
    max_files: int | None = 1000,
    max_bytes: str | None = None,
) -> StreamingQuery:
    """Land live replies with their parents, and those that waited in vain, apart.

    ``clock`` is when an event arrived, over the columns of classified events; by default the time
    of its batch. Events for which it is null take no part. A batch replaces what an earlier attempt at it left, as the event landing does.
    Redelivered events are joined again and are one row when read.
    """
    envelopes = _envelopes(spark, source, max_files=max_files, max_bytes=max_bytes)
    arrived = F.current_timestamp() if clock is None else clock
    events = classify_events(envelopes, F.lit("")).withColumn("arrived", arrived)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"run": F.lit(_run(batch.sparkSession)), "batch_id": F.lit(batch_id)})
        _overwrite(rows.hint("rebalance", "outcome"), sink, "outcome", "run", "batch_id")

    return (
        join_threads(events, keep=keep, wait=wait, parts=parts)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def read_thread_replies(spark: SparkSession, sink: str) -> DataFrame:
    """Live replies, each once, with ``outcome``; one that was matched at any delivery is matched."""
    if not exists(spark, sink):
        return spark.createDataFrame([], SCHEMA).select(*REPLY, *PARENT, "outcome")
    rows = spark.read.schema(SCHEMA).parquet(sink).select(*REPLY, *PARENT, "outcome")
    found = rows.withColumn("_found", (F.col("outcome") == MATCHED).cast("int"))
    return latest_per_key(found, ["channel_id", "message_ts"], ["_found"]).drop("_found")


def settle_orphans(replies: DataFrame, history: DataFrame) -> DataFrame:
    """Give orphans the parents that the message history has; the rest stay orphans.

    ``history`` has the columns of the messages table. Matched replies pass as they are and are
    not joined.
    """
    orphans = replies.where(F.col("outcome") == ORPHAN).drop(*PARENT, "outcome")
    parents = history.where(~is_reply()).select(
        "channel_id", F.col("message_ts").alias("thread_ts"), F.col("user_id").alias("parent_user_id"),
        F.col("text").alias("parent_text"), F.lit(SETTLED).alias("outcome"),
    )
    parents = latest_per_key(parents, ["channel_id", "thread_ts"], [])
    settled = join_on(orphans, parents, ["channel_id", "thread_ts"], "left").withColumn("outcome", F.coalesce("outcome", F.lit(ORPHAN)))
    return replies.where(F.col("outcome") == MATCHED).unionByName(settled)
