"""Live replies joined with their parents."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_raw import envelope
from tidewell.plans.ingest import Lake
from tidewell.plans.live import LiveFeed
from tidewell.streaming import read_thread_replies, settle_orphans, start_thread_stream


def message(ts, at, thread=None, channel="C1", user="U"):
    return envelope("message", f"{channel}-{ts}", at, channel=channel, user=user, text=f"t{ts}", ts=ts, thread_ts=thread)


@pytest.fixture
def wave(spark, write_lines, tmp_path):
    """Write a wave of events and drain the stream, which starts anew each time."""
    done = []
    clock = F.timestamp_seconds(F.col("event_time").try_cast("long"))

    def run(*events, **options):
        source = write_lines("in", list(events), f"{len(done)}.json")
        options = {"clock": clock, "keep": "1 hour", "wait": "10 minutes", "interval": None, "max_files": None} | options
        query = start_thread_stream(spark, source, str(tmp_path / "out"), str(tmp_path / "check"), **options)
        query.awaitTermination()
        done.append(query)
        return query

    return run


def outcomes(spark, tmp_path):
    found = read_thread_replies(spark, str(tmp_path / "out"))
    return rows(found.select("channel_id", "message_ts", "parent_text", "outcome"), "channel_id", "message_ts")


def test_either_order_over_restarts(spark, wave, tmp_path):
    assert outcomes(spark, tmp_path) == []
    wave(message("1", 1000), message("2.1", 1000, thread="2"), message("9.1", 1000, thread="9"))
    wave(message("1.1", 1300, thread="1"), message("2", 1300, thread="2"), message("1.1", 1300, thread="1", channel="C2"))
    assert outcomes(spark, tmp_path) == [("C1", "1.1", "t1", "matched"), ("C1", "2.1", "t2", "matched")]
    wave(message("9", 9000), message("1.2", 9000, thread="1"))  # a parent after the wait, a reply after its parent is gone
    wave(message("70", 90000))
    wave(message("71", 180000))
    assert outcomes(spark, tmp_path) == [
        ("C1", "1.1", "t1", "matched"), ("C1", "1.2", None, "orphan"), ("C1", "2.1", "t2", "matched"),
        ("C1", "9.1", None, "orphan"), ("C2", "1.1", None, "orphan"),
    ]


def test_redelivered_replies_are_one_row(spark, wave, tmp_path):
    again = message("1.1", 1000, thread="1")
    wave(message("1", 1000), again, again)
    wave(message("1.1", 20000, thread="1"))  # the parent is gone by now
    wave(message("70", 90000))
    wave(message("71", 180000))
    assert outcomes(spark, tmp_path) == [("C1", "1.1", "t1", "matched")]


def test_what_is_no_reply(spark, wave, tmp_path):
    wave(
        message("1.0", 1000, thread="1"), message("2", 1000, thread=""), message("3", 1000),
        envelope("reaction_added", "r", user="U", reaction="x", item={"channel": "C1", "ts": "1"}, event_ts="4"),
        message(None, 1000, thread="2"), message("2.1", None, thread="2"),
    )
    wave(message("70", 90000))
    # a reply without a time of its own has a parent as any other; one without an arrival can't be placed
    assert outcomes(spark, tmp_path) == [("C1", "", "t2", "matched")]


def test_state_is_bounded(spark, wave):
    held = []
    for hour in range(8):
        at = 10_000 + hour * 3_600 * 2
        query = wave(message(f"{hour}", at), *[message(f"{hour}.{n}", at, thread=f"{hour}") for n in range(1, 20)], parts=2)
        held.append(sum(s.numRowsTotal for s in query.lastProgress.stateOperators))
    assert max(held[2:]) <= 2 * (19 + 2)  # two waves, whatever came before them


def test_a_batch_with_replies_only_lets_parents_go(spark, wave):
    wave(message("1", 1000))
    for n in range(1, 4):
        query = wave(message(f"5.{n}", 1000 + n * 20_000, thread="5"))
    assert sum(s.numRowsTotal for s in query.lastProgress.stateOperators) <= 2


def test_a_huge_thread_is_dealt_to_parts(spark, wave, tmp_path):
    query = wave(message("1", 1000), *[message(f"1.{n:03d}", 1000, thread="1") for n in range(1, 200)], parts=4)
    assert read_thread_replies(spark, str(tmp_path / "out")).where("outcome = 'matched'").count() == 199
    joined = [p for p in query.recentProgress if p.numInputRows][-1].stateOperators[0]
    assert joined.numRowsTotal == 199 + 4  # the parent once for each part


def test_orphans_settled_by_history(spark, wave, tmp_path):
    wave(message("1", 1000), message("1.1", 1000, thread="1"), message("2.1", 1000, thread="2"), message("3.1", 1000, thread="3"))
    wave(message("70", 90000))
    wave(message("71", 180000))
    columns = "channel_id string, message_ts string, thread_ts string, user_id string, text string"
    history = spark.createDataFrame(
        [("C1", "2", "2", "U7", "old"), ("C1", "2.5", "2", "U8", "a reply"), ("C1", "1", "", "U9", "not looked at"), ("C2", "3", "", "U", "x")], columns
    )
    settled = settle_orphans(read_thread_replies(spark, str(tmp_path / "out")), history)
    assert rows(settled.select("message_ts", "parent_user_id", "parent_text", "outcome"), "message_ts") == [
        ("1.1", "U", "t1", "matched"), ("2.1", "U7", "old", "history"), ("3.1", None, None, "orphan"),
    ]


def test_live_feed_with_threads(spark, write_lines, tmp_path):
    source = write_lines("in", [message("1", 1000), message("1.1", 1000, thread="1")])
    feed = LiveFeed(Lake(spark, str(tmp_path / "lake")), source, threads={"keep": "1 hour"})
    feed.drain()
    out = read_thread_replies(spark, feed._threads)
    assert rows(out.select("message_ts", "parent_text", "outcome")) == [("1.1", "t1", "matched")]
