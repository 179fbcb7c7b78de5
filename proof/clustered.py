"""Reads of one channel, of one day and of both from messages laid out by channel and time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators.clustered import ClusteredTable
from tidewell.session import scratch

from . import adapters as a

#: The eleventh day, in seconds since the first.
SINCE, UNTIL = "864000", "950399.999999"


def channel_day_read(spark, sf_dir):
    """All events as messages in three appends, of which two were ordered as one; read by channel, by day and by both."""
    rows = a.load(spark, sf_dir, "events").select("event_id", a.channel_of().alias("channel_id"), a.seconds_text().alias("message_ts"))
    table = ClusteredTable(spark, scratch(spark, "clustered"), rows.schema, at="message_ts", rows_per_file=100_000)
    for k in range(3):
        table.append(rows.where(F.col("event_id") % 3 == k))
        if k == 1:
            table.compact()
            table.vacuum()
    reads = {"channel": ("C3", None, None), "day": (None, SINCE, UNTIL), "both": ("C3", SINCE, UNTIL), "since": ("C5", SINCE, None)}
    found = [table.read(*bounds).withColumn("read", F.lit(name)) for name, bounds in reads.items()]
    return found[0].unionAll(found[1]).unionAll(found[2]).unionAll(found[3])


QUERIES = {"channel_day_read": channel_day_read}


def oracle(channel: str, ts: str) -> dict[str, str]:
    """The SQL, given that of the channel and of the time text."""
    day = f"CAST({ts} AS DECIMAL(28,9)) BETWEEN {SINCE} AND {UNTIL}"
    wheres = {
        "channel": f"{channel} = 'C3'",
        "day": day,
        "both": f"{channel} = 'C3' AND {day}",
        "since": f"{channel} = 'C5' AND CAST({ts} AS DECIMAL(28,9)) >= {SINCE}",
    }
    parts = [f"SELECT event_id, {channel} AS channel_id, {ts} AS message_ts, '{k}' AS read FROM events WHERE {w}" for k, w in wheres.items()]
    return {"channel_day_read": " UNION ALL ".join(parts)}
