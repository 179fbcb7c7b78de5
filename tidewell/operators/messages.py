"""Chat history: thread replies, normalised messages, and history joined with the live feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import epoch, is_blank, json_text, list_size, or_blank
from ..model.payloads import MESSAGE
from ..model.specs import INT
from .coerce import coerce_column
from .events import MESSAGE_EVENT
from .incremental import latest_per_key
from .joins import join_on


# Where a message came from, and the text of no reactions.
HISTORY_MODE = "historical"
NO_REACTIONS = "[]"


def is_threaded(reply_count: str = "reply_count", thread_ts: str = "thread_ts") -> Column:
    return (F.col(reply_count) > 0) & ~is_blank(F.col(thread_ts))


def _count(rows: DataFrame, name: str) -> Column:
    """A number of a raw or normalised message; 0 for what is none."""
    if name not in rows.columns:
        return F.lit(0)
    return F.coalesce(coerce_column(F.col(name), rows.schema[name].dataType, INT), F.lit(0))


def thread_replies(messages: DataFrame, replies: DataFrame) -> DataFrame:
    """Replies to the threaded messages, without the parent each thread repeats.

    Both frames need ``channel_id``; ``messages`` may be raw or normalised. A semi join: the
    reply side is never multiplied, and AQE splits the replies of one huge thread over many
    tasks.
    """
    parents = messages.select("channel_id", "thread_ts", _count(messages, "reply_count").alias("reply_count"))
    parents = parents.where(is_threaded()).select("channel_id", "thread_ts")
    # A reply without a readable time is no parent either.
    own = replies.where(~epoch(F.col("ts")).eqNullSafe(epoch(F.col("thread_ts"))))
    return join_on(own, parents, ["channel_id", "thread_ts"], "left_semi").select(replies.columns)


def with_replies(messages: DataFrame, replies: DataFrame) -> DataFrame:
    """Messages and the replies of their threads; fields a reply lacks are null."""
    return messages.unionByName(thread_replies(messages, replies), allowMissingColumns=True)


def _with_names(rows: DataFrame, channels: DataFrame) -> DataFrame:
    names = channels.select(F.col("id").alias("channel_id"), F.col("name").alias("channel_name"))
    return join_on(rows, names, ["channel_id"], "left")


def normalize_messages(messages: DataFrame, load_date: Column, channels: DataFrame | None = None) -> DataFrame:
    """The columns of the messages table, defaults filled in.

    ``messages`` has ``channel_id`` and raw message fields. The name comes from ``channels``
    (``id``, ``name``) or from a ``channel_name`` column.
    """
    if channels is not None:
        messages = _with_names(messages, channels)
    have = set(messages.columns)

    def field(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast(MESSAGE[name].dataType)

    return messages.select(
        "channel_id",
        (or_blank(F.col("channel_name")) if "channel_name" in have else F.lit("")).alias("channel_name"),
        or_blank(field("ts")).alias("message_ts"),
        or_blank(field("user")).alias("user_id"),
        or_blank(field("text")).alias("text"),
        or_blank(field("thread_ts")).alias("thread_ts"),
        _count(messages, "reply_count").alias("reply_count"),
        F.coalesce(json_text(field("reactions")), F.lit(NO_REACTIONS)).alias("reactions"),
        (list_size(field("files")) > 0).cast("int").alias("has_files"),
        list_size(field("files")).alias("file_count"),
        or_blank(field("team")).alias("team"),
        or_blank(field("subtype")).alias("subtype"),
        load_date.alias("processing_date"),
        F.lit(HISTORY_MODE).alias("ingestion_mode"),
    )


def live_messages(events: DataFrame, channels: DataFrame | None = None) -> DataFrame:
    """Message events of the live feed in the shape of the messages table."""
    rows = events.where(F.col("event_type") == MESSAGE_EVENT)
    if channels is not None:
        rows = _with_names(rows, channels)
    else:
        rows = rows.withColumn("channel_name", F.lit(""))
    return rows.select(
        "channel_id", or_blank(F.col("channel_name")).alias("channel_name"), "message_ts", "user_id", "text", "thread_ts",
        F.lit(0).alias("reply_count"),
        F.lit(NO_REACTIONS).alias("reactions"),
        F.lit(0).alias("has_files"),
        F.lit(0).alias("file_count"),
        "team", "subtype", "processing_date", "ingestion_mode",
    )


def unify_messages(history: DataFrame, live: DataFrame) -> DataFrame:
    """History and live messages, each message once; the history row is the fuller one."""
    both = history.unionByName(live)
    preferred = (F.col("ingestion_mode") == HISTORY_MODE).cast("int")
    rows = both.withColumn("_preferred", preferred)
    return latest_per_key(rows, ["channel_id", "message_ts"], ["_preferred", "processing_date"]).drop("_preferred")


def with_reactions(messages: DataFrame) -> DataFrame:
    """Messages that have reactions."""
    return messages.where(list_size(F.col("reactions")) > 0)
