import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_raw import ENVELOPES, envelope
from tidewell.model.payloads import ENVELOPE
from tidewell.operators.events import classify_events, malformed_events
from tidewell.operators.infer import parse_records
from tidewell.operators.messages import live_messages, unify_messages
from tidewell.plans import marts
from tidewell.plans.ingest import Lake, backfill_chat
from tidewell.plans.live import LiveFeed
from tidewell.plans.publish import publish
from tidewell.sources import read_envelopes
from tidewell.streaming import (
    counter_totals, events, read_counters, read_events, read_marks, start_event_counters, start_event_stream,
)

DAY = "2024-01-01"


@pytest.fixture
def place(tmp_path):
    return {k: str(tmp_path / k) for k in ("in", "out", "check")}


def drain(spark, place, **options):
    query = start_event_stream(
        spark, place["in"], place["out"], place["check"], load_date=F.lit(DAY), interval=None, **options
    )
    query.awaitTermination()
    return query


def batches(place):
    """Numbers of the landed batches of one query."""
    return sorted(int(d.name.split("=")[1]) for d in Path(place["out"]).glob("events/processing_date=*/run=*/batch_id=*"))


def count(spark, place):
    query = start_event_counters(spark, place["in"], place["out"] + "-n", place["check"] + "-n", interval=None)
    query.awaitTermination()
    return read_counters(spark, place["out"] + "-n")


def test_stream_equals_batch_and_drops_redeliveries(spark, write_lines, place):
    write_lines("in", ENVELOPES, "a.json")
    drain(spark, place)
    batch = classify_events(read_envelopes(spark, place["in"]), F.lit(DAY))
    assert sorted(rows(read_events(spark, place["out"]))) == sorted(rows(batch))
    # Redelivered in a later batch, twice in one batch, and a new one.
    new = envelope("message", "n", 5, channel="C1", ts="1000.25", user="U9", text="new")
    write_lines("in", [*ENVELOPES, new, new], "b.json")
    drain(spark, place)
    assert sorted(r["envelope_id"] for r in read_events(spark, place["out"]).collect()) == ["j", "m", "m2", "n", "r"]
    assert rows(read_marks(spark, place["out"])) == [("C1", "1000.25")]


def test_marks_compare_numbers_over_batches(spark, write_lines, place):
    for name, channel, ts in (("a", "C1", "1000.25"), ("b", "C2", "7"), ("c", "C1", "999.5"), ("d", "C3", "8")):
        write_lines("in", [envelope("message", name, channel=channel, ts=ts)], f"{name}.json")
        drain(spark, place)
    assert rows(read_marks(spark, place["out"]), "channel_id") == [("C1", "1000.25"), ("C2", "7"), ("C3", "8")]


def test_marks_held_stay_readable(spark, write_lines, place, monkeypatch):
    monkeypatch.setattr(events, "KEPT_VERSIONS", 4)
    held = []
    for n in range(7):
        write_lines("in", [envelope("message", f"e{n}", channel="C1", ts=str(n))], f"{n}.json")
        drain(spark, place)
        held.append(read_marks(spark, place["out"]))
    assert [rows(h) for h in held[-3:]] == [[("C1", "4")], [("C1", "5")], [("C1", "6")]]
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|File does not"):
        held[0].collect()  # gone for good is an error, not an empty answer
    assert len([d for d in os.listdir(place["out"] + "/marks") if not d.startswith(".")]) <= 5


def test_a_new_checkpoint_adds_to_the_sink(spark, write_lines, place):
    for n in range(3):
        write_lines("in", [envelope("message", f"e{n}", channel="C1", ts=str(97 + n))], f"{n}.json")
        drain(spark, place)
    again = {**place, "in": place["in"] + "2", "check": place["check"] + "2"}
    write_lines("in2", [envelope("message", "late", channel="C1", ts="50"), envelope("message", "e0", channel="C1", ts="97")], "x.json")
    drain(spark, again)
    assert sorted(r["envelope_id"] for r in read_events(spark, place["out"]).collect()) == ["e0", "e1", "e2", "late"]
    assert rows(read_marks(spark, place["out"])) == [("C1", "99")]


def test_batches_land_once_each(spark, write_lines, place):
    for n in range(3):
        write_lines("in", [envelope("message", f"e{n}", channel="C1", ts=str(n))], f"{n}.json")
        drain(spark, place)
    ids = batches(place)
    assert len(ids) == 3 and ids == sorted(set(ids))


def test_events_without_an_id_are_all_kept(spark, write_lines, place):
    bare = envelope("message", None, 1, channel="C1", ts="1", text="same")
    write_lines("in", [bare, bare, {**bare, "envelope_id": ""}], "a.json")
    drain(spark, place)
    write_lines("in", [bare], "b.json")
    drain(spark, place)
    assert read_events(spark, place["out"]).count() == 4


@pytest.mark.parametrize("horizon", ["1 hour", None])
def test_old_events_are_not_late(spark, write_lines, place, horizon):
    for n, ts in enumerate(("1700000000", "5", "1600000000")):
        write_lines("in", [envelope("message", f"e{n}", channel="C1", ts=ts)], f"{n}.json")
        drain(spark, place, horizon=horizon)
    assert read_events(spark, place["out"]).count() == 3


def test_batches_are_bounded(spark, write_lines, place):
    for n in range(4):
        write_lines("in", [envelope("message", f"e{n}", channel="C1", ts=str(n))], f"{n}.json")
    drain(spark, place, max_files=1)
    assert len(batches(place)) >= 4
    assert read_events(spark, place["out"]).count() == 4


def test_crash_between_write_and_commit_repeats_nothing(spark, write_lines, place, monkeypatch):
    write_lines("in", ENVELOPES, "a.json")
    real, calls = events._overwrite, []

    def die_after_the_events(rows_, folder, *by):
        real(rows_, folder, *by)
        calls.append(folder)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(events, "_overwrite", die_after_the_events)
        with pytest.raises(Exception, match="lost"):
            drain(spark, place)
    assert len(calls) == 1
    drain(spark, place)
    assert sorted(r["envelope_id"] for r in read_events(spark, place["out"]).collect()) == ["j", "m", "m2", "r"]
    assert rows(read_marks(spark, place["out"])) == [("C1", "1.6")]


def test_counters_survive_a_restart(spark, write_lines, place):
    write_lines("in", ENVELOPES, "a.json")
    want = {"message": 2, "reaction_added": 1, "member_joined_channel": 1, "channel_archive": 1, "unknown": 1}
    assert dict(rows(count(spark, place))) == want
    write_lines("in", ENVELOPES, "b.json")
    counted = count(spark, place)
    assert dict(rows(counted)) == {k: 2 * n for k, n in want.items()}
    assert rows(counter_totals(counted)) == [(12, 4)]


def test_malformed_lines_are_counted_and_can_be_read(spark, write_lines, place):
    folder = write_lines("in", ENVELOPES[1:3], "a.json")
    with open(f"{folder}/b.json", "w") as out:
        out.write('{"type": "events_api", "payload"\n5\n"text"\n')
    drain(spark, place)
    assert read_events(spark, place["out"]).count() == 2
    assert dict(rows(count(spark, place))) == {"message": 2, "malformed": 3}
    broken = malformed_events(read_envelopes(spark, folder))
    assert '{"type": "events_api", "payload"' in {r["line"] for r in broken.collect()}


def test_a_field_of_another_shape_does_not_break_an_event(spark, write_lines, place):
    odd = envelope("message", "odd", 1, channel={"id": "C9"}, ts=5, item="none", text="still here")
    write_lines("in", [odd], "a.json")
    drain(spark, place)
    assert rows(read_events(spark, place["out"]).select("text", "message_ts")) == [("still here", "5")]


def test_feed_of_a_lake(spark, write_lines, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    feed = LiveFeed(lake, write_lines("in", ENVELOPES, "a.json"), interval="1 second")
    assert feed.status()["state"] == "stopped"
    feed.start()
    feed.start()
    for query in feed.queries:
        query.processAllAvailable()
    got = feed.status()
    assert (got["state"], got["running"], got["total_events"], got["total_messages"], got["total_flushes"]) == (
        "running", True, 6, 2, 1,
    )
    assert got["uptime_seconds"] > 0
    feed.pause()
    assert feed.status()["state"] == "paused" and not feed.status()["running"]
    write_lines("in", [envelope("message", "z", channel="C1", ts="9")], "b.json")
    feed.resume()
    feed.drain()
    feed.stop()
    assert feed.status()["state"] == "stopped" and feed.status()["total_events"] == 7
    assert lake.runs.get("chat") == "stopped"
    assert rows(feed.marks()) == [("C1", "9")]
    assert "v_chat_realtime_feed" in publish(lake, "chat", live=True)
    assert spark.table("v_chat_realtime_feed").count() == 5
    live = {r["message_ts"] for r in spark.table("bronze_chat_messages").collect()}
    assert "9" in live and "v_chat_channel_activity" in publish(lake, "chat", live=True)

    # History of a message that also came live counts once, as the history has it.
    write_lines("history/channel_id=C1", [{"messages": [{"ts": "9", "user": "U1", "text": "fuller"}, {"ts": "3", "user": "U1", "text": "old"}]}])
    backfill_chat(lake, date(2024, 1, 2), messages=str(tmp_path / "history"))
    publish(lake, "chat", live=True)
    got = {r["message_ts"]: r["ingestion_mode"] for r in spark.table("bronze_chat_messages").collect()}
    assert set(got) == live | {"3"} and got["9"] == got["3"] == "historical"


def test_envelopes_from_a_text_stream(spark, write_lines, place):
    write_lines("in", ENVELOPES, "a.json")
    texts = parse_records(spark.readStream.text(place["in"]), ENVELOPE)
    start_event_stream(spark, texts, place["out"], place["check"], load_date=F.lit(DAY), interval=None).awaitTermination()
    batch = classify_events(read_envelopes(spark, place["in"]), F.lit(DAY))
    assert sorted(rows(read_events(spark, place["out"]))) == sorted(rows(batch))


def test_stop_and_resume_on_an_interval(spark, write_lines, place):
    write_lines("in", ENVELOPES, "a.json")
    for name in ("a", "b"):
        query = start_event_stream(spark, place["in"], place["out"], place["check"], interval="1 second")
        query.processAllAvailable()
        query.stop()
        write_lines("in", [envelope("message", name * 2, channel="C1", ts="9")], f"{name}2.json")
    drain(spark, place)
    got = read_events(spark, place["out"])
    assert got.count() == 6 and got.where("processing_date = '2024-01-01'").count() < 6


def test_live_feed_and_unified_messages(spark, write_lines, place):
    write_lines("in", ENVELOPES, "a.json")
    drain(spark, place)
    landed = read_events(spark, place["out"])
    assert [r["event_time"] for r in marts.live_feed(landed).collect()] == ["1700000001", "1700000000", "5", "4"]
    live = live_messages(landed, spark.createDataFrame([("C1", "general")], "id string, name string"))
    history = live.where("message_ts = '1.5'").withColumn("ingestion_mode", F.lit("historical"))
    both = unify_messages(history, live)
    assert rows(both.select("channel_name", "message_ts", "ingestion_mode"), "message_ts") == [
        ("general", "1.5", "historical"), ("general", "1.6", "realtime"),
    ]
