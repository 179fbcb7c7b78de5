"""Page sources, flattening, threads and events."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell.model import CHAT, MARKETING
from tidewell.model.payloads import CHANNEL, MESSAGE, USER, marketing_record
from tidewell.operators.coerce import coerce
from tidewell.operators.events import classify_events, drop_handshake
from tidewell.operators.flatten import expand_list, flatten_channels, flatten_properties, flatten_users
from tidewell.operators.infer import parse_records
from tidewell.operators.messages import normalize_messages, thread_replies, unify_messages, with_reactions, with_replies
from tidewell.sources import read_envelopes, read_pages, within


def parse(spark, records, schema):
    return parse_records(spark.createDataFrame([(json.dumps(r),) for r in records], "value string"), schema)


def test_bulk_pages(spark, write_lines):
    folder = write_lines("bulk", [
        {"records": [{"Id": "1", "NumberOfEmployees": "5"}, {"Id": "2"}], "locator": "x", "done": False},
        {"records": [], "done": False},
        {"records": [{"Id": "3", "NumberOfEmployees": 7, "Extra": 1}], "done": True},
        {"done": True},
    ])
    got = read_pages(spark, folder, "sales", "Account")
    assert sorted(r["Id"] for r in got.collect()) == ["1", "2", "3"]


def test_broken_page_fails(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"records":[{"Id":"1"}]}\n{"records":[{"Id":\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_pages(spark, str(tmp_path), "sales", "Account").collect()


def test_multiline_pages(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"results": [{"id": "1"}, {"id": "2"}]}, indent=2))
    assert read_pages(spark, str(tmp_path), "marketing", "contacts", multiline=True).count() == 2


def test_pages_per_channel_folder(spark, write_lines, tmp_path):
    write_lines("m/channel_id=C1", [{"messages": [{"ts": "1.5", "user": "U"}]}])
    write_lines("m/channel_id=C2", [{"messages": [{"ts": "2"}, {"ts": "3"}]}])
    got = read_pages(spark, str(tmp_path / "m"), "chat", "messages")
    assert rows(got.select("channel_id", "ts"), "ts") == [("C1", "1.5"), ("C2", "2"), ("C2", "3")]


def test_range_compares_numbers_and_includes_bounds(spark):
    got = spark.createDataFrame([("999.5",), ("1000.25",), ("1000.250",), ("1001",)], "ts string")
    assert rows(within(got, "1000.25", "1001"), "ts") == [("1000.25",), ("1000.250",), ("1001",)]
    assert within(got, latest="1000").count() == 1


def test_property_bag(spark):
    spec = MARKETING["contacts"]
    raw = parse(spark, [
        {"id": "1", "properties": {"firstname": "A", "city": None, "nope": 1}, "createdAt": "c", "updatedAt": "u"},
        {"id": "2", "properties": {}, "createdAt": "c"},
        {"id": "3"},
        {"id": "4", "properties": {"id": "own"}},
    ], marketing_record(spec))
    flat = flatten_properties(raw)
    assert set(flat.columns) == set(spec.names)
    got = rows(coerce(flat, spec).select("id", "firstname", "city", "_created_at", "_updated_at"), "id")
    assert got == [("1", "A", None, "c", "u"), ("2", None, None, "c", ""), ("3", None, None, "", ""), ("own", None, None, "", "")]


def test_pipelines_and_owners_keep_their_fields(spark):
    spec = MARKETING["pipelines"]
    stages = [{"id": "0", "label": "New", "displayOrder": 0}, {"id": "1", "label": "Won", "displayOrder": 1}]
    raw = parse(spark, [
        {"id": "7", "label": "P", "displayOrder": 3, "stages": stages, "createdAt": "c", "updatedAt": "u"},
        {"id": "8", "label": "Q", "displayOrder": 4, "stages": []},
        {"id": "9", "label": "R", "displayOrder": 5},
    ], marketing_record(spec))
    flat = flatten_properties(raw)
    row = coerce(flat, spec).where("id = '7'").first()
    assert (row["label"], row["displayOrder"], json.loads(row["stages"])) == ("P", 3, stages)
    expanded = expand_list(flat.withColumnRenamed("id", "pipeline_id"), ["pipeline_id"], "stages")
    assert rows(expanded.select("pipeline_id", "position", "id", "label"), "position") == [
        ("7", 0, "0", "New"), ("7", 1, "1", "Won"),
    ]
    owners = MARKETING["owners"]
    raw = parse(spark, [{"id": "1", "email": "e", "userId": 9, "teams": [{"id": "t", "name": "T"}]}], marketing_record(owners))
    row = coerce(flatten_properties(raw), owners).first()
    assert (row["email"], row["userId"], row["teams"]) == ("e", 9, '[{"id":"t","name":"T"}]')


def test_users_and_channels(spark):
    users = parse(spark, [
        {"id": "U1", "name": "n", "real_name": "r", "profile": {"email": "e", "title": "t"}, "is_admin": True, "tz": "z"},
        {"id": "U2", "is_bot": "true"},
    ], USER)
    assert rows(coerce(flatten_users(users), CHAT["users"]), "id") == [
        ("U1", "n", "r", "e", "t", 1, None, "z"), ("U2", "", "", "", "", None, 1, ""),
    ]
    channels = parse(spark, [
        {"id": "C1", "name": "n", "is_private": False, "created": 1700000000, "creator": "U1", "num_members": 3,
         "topic": {"value": "t"}, "purpose": {"value": "p"}},
        {"id": "C2", "name": "m"},
    ], CHANNEL)
    assert rows(coerce(flatten_channels(channels), CHAT["channels"]), "id") == [
        ("C1", "n", 0, 1700000000, "U1", 3, "t", "p"), ("C2", "m", None, None, "", None, "", ""),
    ]


def chat(spark, records, **extra):
    frame = parse(spark, records, MESSAGE)
    return frame.withColumns({k: F.lit(v) for k, v in {"channel_id": "C1", **extra}.items()})


def test_normalize(spark):
    reaction = {"name": "eyes", "users": ["U1", "U2"], "count": 2}
    raw = chat(spark, [
        {"ts": "1", "user": "U", "text": "t", "reactions": [reaction], "files": [{"id": "F"}, {"id": "G"}], "reply_count": 2,
         "thread_ts": "1", "team": "T", "subtype": None},
        {"ts": "2", "files": []},
    ], channel_name="general")
    out = normalize_messages(raw, F.lit("2024-01-01"))
    assert out.columns == CHAT["messages"].names
    assert rows(out, "message_ts") == [
        ("C1", "general", "1", "U", "t", "1", 2, '[{"name":"eyes","users":["U1","U2"],"count":2}]', 1, 2, "T", "",
         "2024-01-01", "historical"),
        ("C1", "general", "2", "", "", "", 0, "[]", 0, 0, "", "", "2024-01-01", "historical"),
    ]
    names = spark.createDataFrame([("C1", "from-list")], "id string, name string")
    assert {r["channel_name"] for r in normalize_messages(raw.drop("channel_name"), F.lit("d"), names).collect()} == {"from-list"}
    assert with_reactions(raw).count() == 1
    assert rows(expand_list(raw, ["ts"], "files").select("ts", "position", "id")) == [("1", 0, "F"), ("1", 1, "G")]


def test_thread_replies(spark):
    messages = chat(spark, [
        {"ts": "1", "thread_ts": "1", "reply_count": 2},
        {"ts": "2", "thread_ts": "2", "reply_count": 0},
        {"ts": "3", "reply_count": 4},
        {"ts": "4", "thread_ts": "", "reply_count": 4},
    ])
    replies = chat(spark, [
        {"ts": "1", "thread_ts": "1", "reply_count": 2}, {"ts": "1.1", "thread_ts": "1"}, {"ts": "1.2", "thread_ts": "1"},
        {"ts": "2.1", "thread_ts": "2"}, {"ts": "3.1", "thread_ts": "3"}, {"ts": "9.1", "thread_ts": "9"},
    ]).unionByName(chat(spark, [{"ts": "1.3", "thread_ts": "1"}], channel_id="C2"))
    assert rows(thread_replies(messages, replies).select("channel_id", "ts"), "ts") == [("C1", "1.1"), ("C1", "1.2")]
    assert with_replies(messages, replies).count() == 6
    only_threads = replies.select("channel_id", "ts", "thread_ts")
    both = normalize_messages(with_replies(messages, only_threads), F.lit("d"))
    assert rows(both.where("message_ts = '1.1'").select("reply_count", "user_id", "reactions")) == [(0, "", "[]")]


def envelope(kind, envelope_id="e1", event_time=None, **event):
    payload = {"type": "event_callback", "event": {"type": kind, **event}}
    if event_time is not None:
        payload["event_time"] = event_time
    return {"type": "events_api", "envelope_id": envelope_id, "payload": payload}


ENVELOPES = [
    {"type": "hello", "connection_info": {"app_id": "A"}},
    envelope("message", "m", 1700000000, subtype=None, channel="C1", user="U1", text='say "hi"', ts="1.5", team="T", channel_type="channel"),
    envelope("message", "m2", 1700000001, subtype="bot", channel="C1", user="U1", text="x", ts="1.6", thread_ts="1.5"),
    envelope("reaction_added", "r", user="U2", reaction="eyes", item={"type": "message", "channel": "C2", "ts": "3"}, event_ts="4"),
    envelope("member_joined_channel", "j", user="U3", channel="C3", channel_type="C", team="T", event_ts="5"),
    envelope("channel_archive", "x", user="U4"),
    {"type": "events_api"},
]


def test_classify(spark, write_lines):
    raw = read_envelopes(spark, write_lines("events", ENVELOPES))
    assert drop_handshake(raw).count() == 6
    out = classify_events(raw, F.lit("2024-01-01"))
    assert out.columns == CHAT["realtime_events"].names
    tail = ("2024-01-01", "realtime")
    assert rows(out, "envelope_id") == [
        ("member_joined_channel", "C3", "U3", "joined channel", "5", "", "T", "C", "member_join", "5", *tail, "j"),
        ("message", "C1", "U1", 'say "hi"', "1.5", "", "T", "channel", "", "1700000000", *tail, "m"),
        ("message", "C1", "U1", "x", "1.6", "1.5", "", "", "bot", "1700000001", *tail, "m2"),
        ("reaction_added", "C2", "U2", ":eyes:", "3", "", "", "", "reaction", "4", *tail, "r"),
    ]


def test_unify_prefers_history_and_keeps_rows_without_time(spark):
    def message(ts, mode, text):
        base = {n: "" for n in CHAT["messages"].names}
        base |= {"channel_id": "C1", "message_ts": ts, "text": text, "ingestion_mode": mode, "reply_count": 0,
                 "has_files": 0, "file_count": 0}
        return tuple(base[n] for n in CHAT["messages"].names)

    schema = CHAT["messages"].struct()
    history = spark.createDataFrame([message("1", "historical", "h1"), message("", "historical", "lost")], schema)
    live = spark.createDataFrame(
        [message("1", "realtime", "l1"), message("2", "realtime", "l2"), message("", "realtime", "lost")], schema
    )
    got = rows(unify_messages(history, live).select("message_ts", "text"), "message_ts", "text")
    assert got == [("", "lost"), ("", "lost"), ("1", "h1"), ("2", "l2")]
