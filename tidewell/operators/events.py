"""Live events: three envelope shapes to one row shape. Works on batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import or_blank

# The event types that become rows, the greeting, and the texts that rows get.
MESSAGE_EVENT, REACTION_EVENT, JOIN_EVENT = "message", "reaction_added", "member_joined_channel"
HANDSHAKE = "hello"
JOIN_TEXT = "joined channel"
REACTION_SUBTYPE, JOIN_SUBTYPE = "reaction", "member_join"
LIVE_MODE = "realtime"


def drop_handshake(envelopes: DataFrame) -> DataFrame:
    """Envelopes other than the greeting a connection starts with."""
    return envelopes.where(F.coalesce(F.col("type"), F.lit("")) != HANDSHAKE)


def event_kind() -> Column:
    """Event type to count by; a line that is no event at all counts as malformed."""
    kind = F.col("payload.event.type")
    broken = kind.isNull() & F.col("_corrupt_record").isNotNull()
    return F.when(broken, "malformed").otherwise(F.coalesce(kind, F.lit("unknown")))


def malformed_events(envelopes: DataFrame) -> DataFrame:
    """The lines that are no events, to be looked into; the live feed goes on without them."""
    return envelopes.where(event_kind() == "malformed").select(F.col("_corrupt_record").alias("line"))


def classify_events(envelopes: DataFrame, load_date: Column) -> DataFrame:
    """The columns of the live events table; types other than the three are dropped."""
    event = "payload.event"
    kind = F.col(f"{event}.type")
    is_message, is_reaction = kind == MESSAGE_EVENT, kind == REACTION_EVENT

    def by_kind(message: Column, reaction: Column, join: Column) -> Column:
        return or_blank(F.when(is_message, message).when(is_reaction, reaction).otherwise(join))

    def of(name: str) -> Column:
        return F.col(f"{event}.{name}")

    none = F.lit("")
    known = drop_handshake(envelopes).where(kind.isin(MESSAGE_EVENT, REACTION_EVENT, JOIN_EVENT))
    return known.select(
        kind.alias("event_type"),
        by_kind(of("channel"), of("item.channel"), of("channel")).alias("channel_id"),
        or_blank(of("user")).alias("user_id"),
        by_kind(
            of("text"), F.concat(F.lit(":"), or_blank(of("reaction")), F.lit(":")), F.lit(JOIN_TEXT)
        ).alias("text"),
        by_kind(of("ts"), of("item.ts"), of("event_ts")).alias("message_ts"),
        by_kind(of("thread_ts"), none, none).alias("thread_ts"),
        by_kind(of("team"), none, of("team")).alias("team"),
        by_kind(of("channel_type"), none, of("channel_type")).alias("channel_type"),
        by_kind(of("subtype"), F.lit(REACTION_SUBTYPE), F.lit(JOIN_SUBTYPE)).alias("subtype"),
        by_kind(F.col("payload.event_time"), of("event_ts"), of("event_ts")).alias("event_time"),
        load_date.alias("processing_date"),
        F.lit(LIVE_MODE).alias("ingestion_mode"),
        or_blank(F.col("envelope_id")).alias("envelope_id"),
    )
