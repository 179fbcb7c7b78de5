"""Live replies joined with their parents, over the given conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators.messages import normalize_messages
from tidewell.session import scratch
from tidewell.streaming import read_thread_replies, settle_orphans, start_thread_stream

from . import adapters as a

#: When the events of a wave arrive; the last two only let the state go.
CLOCK = (0, 300, 7_200, 90_000, 180_000)


def _envelopes(spark, sf_dir):
    """First turns as parents in wave 1, 2 or 3 and later turns as replies in wave 1 (redelivered in 3), 2 or 3."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn")
    stamp = F.concat(conv, F.lit("."), F.lpad(turn.cast("string"), 6, "0"))
    rows = a.load(spark, sf_dir, "conversations").where("turn >= 0")
    waves = F.when(turn == 0, F.array((F.col("conv_id") % 3 + 1).cast("int"))).when(
        turn == 1, F.array(F.lit(1), F.lit(3))
    ).otherwise(F.array(F.least(turn, F.lit(3)).cast("int")))
    event = F.struct(
        F.lit("message").alias("type"),
        F.concat(F.lit("C"), conv).alias("channel"),
        F.col("role").alias("user"),
        F.col("text"),
        stamp.alias("ts"),
        F.when(turn > 0, F.concat(conv, F.lit(".000000"))).alias("thread_ts"),
    )
    at = F.element_at(F.array(*[F.lit(1_700_000_000 + c).cast("long") for c in CLOCK]), F.col("wave"))
    payload = F.struct(F.lit("event_callback").alias("type"), at.alias("event_time"), event.alias("event"))
    envelope = F.struct(F.lit("events_api").alias("type"), F.concat(F.lit("m-"), stamp).alias("envelope_id"), payload.alias("payload"))
    return rows.withColumn("wave", F.explode(waves)).select("wave", F.to_json(envelope).alias("value"))


def live_thread_replies(spark, sf_dir):
    """Replies in three waves with a restart after each; orphans looked up in a history of every other thread."""
    root = scratch(spark, "threads")
    envelopes = _envelopes(spark, sf_dir)
    clock = F.timestamp_seconds(F.col("event_time").cast("long"))
    for wave, seconds in enumerate(CLOCK, 1):
        tick = '{"type":"events_api","payload":{"event_time":%d,"event":{"type":"message","channel":"tick","ts":"%d"}}}'
        closing = a.load(spark, sf_dir, "region").select(F.lit(tick % (1_700_000_000 + seconds, seconds)).alias("value"))
        a.write_texts(envelopes.where(F.col("wave") == wave).select("value").unionAll(closing), f"{root}/in")
        options = {"keep": "1 hour", "wait": "10 minutes", "clock": clock, "interval": None, "max_files": None}
        start_thread_stream(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", **options).awaitTermination()
    first = a.raw_conversations(spark, sf_dir).where(F.col("ts").endswith(".000000") & (F.split("ts", "[.]")[0].cast("long") % 2 == 0))
    replies = settle_orphans(read_thread_replies(spark, f"{root}/out"), normalize_messages(first, F.lit(a.LOAD_DATE)))
    return replies.drop("envelope_id")


QUERIES = {"live_thread_replies": live_thread_replies}

ORACLE = {
    "live_thread_replies": """
        WITH reply AS (
            SELECT conv_id, turn, COALESCE(MAX(role), '') AS role, COALESCE(MAX(text), '') AS text FROM conversations WHERE turn > 0 GROUP BY ALL),
        parent AS (SELECT conv_id, COALESCE(MAX(role), '') AS role, COALESCE(MAX(text), '') AS text FROM conversations WHERE turn = 0 GROUP BY ALL),
        told AS (
            SELECT r.*, p.role AS p_role, p.text AS p_text,
                   CASE WHEN p.conv_id IS NULL THEN 'orphan'
                        WHEN CASE WHEN r.conv_id % 3 < 2 THEN turn <= 2 ELSE turn <> 2 END THEN 'matched'  -- turn 1 comes again with wave 3
                        WHEN r.conv_id % 2 = 0 THEN 'history' ELSE 'orphan' END AS outcome
            FROM reply r LEFT JOIN parent p USING (conv_id))
        SELECT 'C' || conv_id::VARCHAR AS channel_id, conv_id::VARCHAR || '.' || lpad(turn::VARCHAR, 6, '0') AS message_ts,
               conv_id::VARCHAR || '.000000' AS thread_ts, role AS user_id, text,
               CASE WHEN outcome <> 'orphan' THEN p_role END AS parent_user_id,
               CASE WHEN outcome <> 'orphan' THEN p_text END AS parent_text, outcome
        FROM told""",
}
