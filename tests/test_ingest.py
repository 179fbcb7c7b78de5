from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidewell.plans import ingest
from tidewell.plans.publish import publish

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


@pytest.fixture
def lake(spark, tmp_path):
    return ingest.Lake(spark, str(tmp_path / "lake"))


def account(key, name, modified):
    return {"Id": key, "Name": name, "LastModifiedDate": modified, "CreatedDate": "2023-01-01"}


def names(lake, entity="Account", family="sales", key="Id", value="Name"):
    return dict(rows(lake.bronze(family, entity).select(key, value)))


def test_incremental_loads(lake, write_lines):
    first = write_lines("p1", [{"records": [account("1", "a", "2024-01-01"), account("2", "b", "2024-01-01")]}])
    report = ingest.run_family(lake, "sales", {"Account": first}, D1)
    assert rows(report.select("resource", "status", "records")) == [("Account", "completed", 2)]
    assert names(lake) == {"1": "a", "2": "b"}

    # The same day again: already complete, nothing is written or moved.
    assert ingest.ingest_entity(lake, "sales", "Account", first, D1)["records"] == 0
    assert lake.landed(ingest.find_spec("sales", "Account")).count() == 2

    # Newer, unchanged, older and new rows; a row at the mark counts as changed.
    second = write_lines("p2", [{"records": [
        account("1", "a2", "2024-01-05"), account("2", "b2", "2024-01-01"), account("3", "c", "2024-01-03"),
        account("1", "stale", "2023-12-31"),
    ]}])
    assert ingest.ingest_entity(lake, "sales", "Account", second, D2)["records"] == 3
    assert names(lake) == {"1": "a2", "2": "b2", "3": "c"}
    assert lake.state.load("sales", "Account")["last_modified"] == "2024-01-05"


def test_a_load_that_died_before_saving_its_state_is_repeated(lake, write_lines, monkeypatch):
    pages = write_lines("p", [{"records": [account("1", "a", "2024-01-01")]}])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(lake.state, "save", die)
        report = ingest.run_family(lake, "sales", {"Account": pages}, D1)
    assert rows(report.select("status", "error")) == [("failed", "RuntimeError: lost")]
    assert lake.runs.get("sales") == "failed"
    ingest.run_family(lake, "sales", {"Account": pages}, D1)
    assert lake.landed(ingest.find_spec("sales", "Account")).count() == 1
    assert lake.runs.get("sales") == "completed"


def test_empty_load_and_reset(lake, write_lines):
    empty = write_lines("e", [{"records": []}])
    assert ingest.ingest_entity(lake, "sales", "Lead", empty, D1)["records"] == 0
    assert lake.state.load("sales", "Lead")["completed"]
    assert lake.bronze("sales", "Lead").count() == 0
    full = write_lines("f", [{"records": [{"Id": "1", "CreatedDate": "2020-01-01"}]}])
    ingest.ingest_entity(lake, "sales", "Lead", full, D2)
    ingest.reset(lake, "sales")
    assert lake.state.current("sales").count() == 0
    assert ingest.ingest_entity(lake, "sales", "Lead", full, D2)["records"] == 1
    assert lake.bronze("sales", "Lead").count() == 1


def test_one_failure_leaves_the_others(lake, write_lines, tmp_path):
    good = write_lines("good", [{"results": [{"id": "1", "properties": {"dealname": "d"}, "updatedAt": "2024"}]}])
    report = ingest.run_family(lake, "marketing", {"deals": good, "tickets": str(tmp_path / "missing")}, D1)
    got = {r["resource"]: r for r in report.collect()}
    assert got["deals"]["status"] == "completed" and got["tickets"]["status"] == "failed"
    assert "PATH_NOT_FOUND" in got["tickets"]["error"] and lake.runs.get("marketing") == "failed"
    ingest.run_family(lake, "marketing", {"deals": good}, D2)
    state, newest, summary = ingest.status(lake, "marketing")
    assert state == "completed" and newest.count() == 2
    assert summary.first()["failed"] == 1 and summary.first()["total_records"] == 1
    assert (tmp_path / "lake/marketing/deals/load=0/year=2024/month=01").is_dir()
    assert rows(lake.bronze("marketing", "deals").select("id", "dealname", "_updated_at")) == [("1", "d", "2024")]


def test_pause_and_resume(lake):
    begun = []

    def load(name, pause=False):
        def run():
            begun.append(name)
            if pause:
                ingest.pause(lake, "sales")
            return {"records": 1, "path": ""}

        return run

    report = ingest.run_all(lake, "sales", {"a": load("a", pause=True), "b": load("b"), "c": load("c")}, parallel=1)
    assert rows(report.select("resource", "status")) == [("a", "completed"), ("b", "paused"), ("c", "paused")]
    assert begun == ["a"] and lake.runs.get("sales") == "paused"
    ingest.resume(lake, "sales")
    assert lake.runs.get("sales") == "running"


def test_snapshots(lake, write_lines):
    def load(folder, day, *records):
        ingest.ingest_entity(lake, "sales", "Account", write_lines(folder, [{"records": list(records)}]), day)

    load("s1", D1, account("1", "a", "2024-01-01"), account("2", "b", "2024-01-01"))
    load("s2", D2, account("1", "a2", "2024-01-02"))
    path = lake.take_snapshot("sales", "Account")
    assert path.endswith("version=1") and names(lake) == {"1": "a2", "2": "b"}
    load("s3", D3, account("2", "b2", "2024-01-03"), account("1", "a3", "2024-01-02"))
    assert names(lake) == {"1": "a3", "2": "b2"}
    assert lake.take_snapshot("sales", "Account").endswith("version=2")
    assert names(lake) == {"1": "a3", "2": "b2"}
    current = lake.bronze("sales", "Account")
    assert "Exchange" not in plan(current) and all("version=2" in f for f in current.inputFiles())


def test_custom_object(lake, write_lines, spark):
    pages = write_lines("c", [
        {"records": [{"Id": "1", "Size": 2, "Tags": ["a"], "CreatedDate": "2024-01-01"}], "done": False},
        {"records": [{"Id": "2", "Size": 2.5, "Active": True}], "done": True},
    ])
    assert ingest.ingest_custom(lake, "Gadget__c", pages, D1)["records"] == 2
    spec = lake.spec("sales", "Gadget__c")
    assert dict(spec.columns) == {"Id": "text", "Active": "flag", "CreatedDate": "text", "Size": "double", "Tags": "text"}
    assert spec.modified == ("LastModifiedDate",)
    assert rows(lake.bronze("sales", "Gadget__c").select("Id", "Active", "Size", "Tags"), "Id") == [
        ("1", None, 2.0, '["a"]'), ("2", 1, 2.5, None),
    ]
    later = write_lines("c2", [{"records": [{"Id": "1", "Size": "n/a", "CreatedDate": "2024-01-02"}]}])
    ingest.ingest_custom(lake, "Gadget__c", later, D2)
    assert rows(lake.bronze("sales", "Gadget__c").select("Id", "Size"), "Id") == [("1", 0.0), ("2", 2.5)]
    # Another session: the declaration is there, a new field is added, whole numbers widen.
    other = ingest.Lake(spark, lake.root)
    wider = write_lines("c3", [{"records": [{"Id": "3", "Size": 7.25, "Colour": "red"}]}])
    ingest.ingest_custom(other, "Gadget__c", wider, D3)
    assert rows(other.bronze("sales", "Gadget__c").select("Id", "Size", "Colour"), "Id") == [
        ("1", 0.0, None), ("2", 2.5, None), ("3", 7.25, "red"),
    ]
    lake = ingest.Lake(spark, lake.root)
    assert publish(lake, "sales")[0] == "bronze_sales_gadget__c"
    assert spark.table("bronze_sales_gadget__c").count() == 3


def message(ts, **more):
    return {"type": "message", "ts": ts, "user": "U1", "text": f"at {ts}", **more}


def test_chat_backfill(lake, write_lines, spark, tmp_path):
    channels = write_lines("channels", [{"channels": [{"id": "C1", "name": "general"}, {"id": "C2", "name": "random"}]}])
    users = write_lines("users", [{"members": [{"id": "U1", "name": "ann"}]}])
    write_lines("m1/channel_id=C1", [{"messages": [message("999.5"), message("1000.25", reply_count=1, thread_ts="1000.25")]}])
    write_lines("m1/channel_id=C2", [{"messages": [message("5")]}])
    write_lines("r/channel_id=C1", [{"messages": [
        message("1000.25", reply_count=1, thread_ts="1000.25"), message("2000", thread_ts="1000.25"), message("999.6", thread_ts="999.5"),
    ]}])
    replies = str(tmp_path / "r")
    done = ingest.backfill_chat(lake, D1, messages=str(tmp_path / "m1"), replies=replies, channels=channels, users=users)
    assert done["records"] == 4
    bronze = lake.bronze("chat", "messages")
    assert rows(bronze.select("channel_name", "message_ts", "thread_ts"), "message_ts") == [
        ("general", "1000.25", "1000.25"), ("general", "2000", "1000.25"), ("random", "5", ""), ("general", "999.5", ""),
    ]
    assert rows(ingest.channel_report(lake, D1), "channel_id") == [
        ("C1", "general", "completed", 2, 1, "1000.25"), ("C2", "random", "completed", 1, 0, "5"),
    ]
    # The reply at 2000 does not move the mark; the message at 1500 is still new.
    assert rows(ingest.channel_marks(lake), "channel_id") == [("C1", "1000.25"), ("C2", "5")]
    write_lines("m2/channel_id=C1", [{"messages": [message("1000.25"), message("1500")]}])
    write_lines("m2/channel_id=C3", [{"messages": [message("1")]}])
    assert ingest.backfill_chat(lake, D2, messages=str(tmp_path / "m2"), replies=replies)["records"] == 2
    assert lake.bronze("chat", "messages").count() == 6
    assert rows(ingest.channel_marks(lake), "channel_id") == [("C1", "1500"), ("C2", "5"), ("C3", "1")]

    published = publish(lake, "chat")
    assert {"bronze_chat_messages", "bronze_chat_users", "bronze_chat_channels", "v_chat_channel_activity"} <= set(published)
    top = spark.sql("SELECT channel_name, message_count FROM v_chat_channel_activity").first()
    assert tuple(top) == ("general", 4)
    ingest.reset(lake, "chat")
    assert ingest.channel_marks(lake).count() == 0


def test_backfill_that_died_before_its_marks_loses_nothing(lake, write_lines, tmp_path, monkeypatch):
    write_lines("m/channel_id=C1", [{"messages": [message("1"), message("2")]}])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(lake.state, "save_all", die)
        with pytest.raises(RuntimeError):
            ingest.backfill_chat(lake, D1, messages=str(tmp_path / "m"))
    ingest.backfill_chat(lake, D1, messages=str(tmp_path / "m"))
    assert rows(lake.bronze("chat", "messages").select("message_ts"), "message_ts") == [("1",), ("2",)]
    assert lake.bronze("chat", "messages").where(F.col("processing_date") == "2024-01-01").count() == 2


def test_changed_records_without_a_declared_time(lake, write_lines):
    def deal(stage, **more):
        return {"Id": "1", "StageName": stage, "CreatedDate": "2023-01-01", **more}

    other = {"Id": "2", "StageName": "New", "CreatedDate": "2024-01-01", "LastModifiedDate": "2024-01-01"}
    ingest.ingest_entity(lake, "sales", "Opportunity", write_lines("a", [{"records": [deal("Prospecting", LastModifiedDate="2023-01-01"), other]}]), D1)
    ingest.ingest_entity(lake, "sales", "Opportunity", write_lines("b", [{"records": [deal("Closed Won", LastModifiedDate="2024-01-02"), other]}]), D2)
    assert names(lake, "Opportunity", value="StageName") == {"1": "Closed Won", "2": "New"}
    # Without any time every record is taken, and the later load counts.
    ingest.ingest_entity(lake, "sales", "Opportunity", write_lines("c", [{"records": [deal("Lost")]}]), D3)
    assert names(lake, "Opportunity", value="StageName") == {"1": "Lost", "2": "New"}


def test_a_retry_on_the_next_day_replaces_the_load(lake, write_lines, monkeypatch):
    pages = write_lines("p", [{"records": [account("1", "a", "2024-01-01"), account(None, "none", "2024-01-01")]}])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(lake.state, "save", die)
        ingest.run_family(lake, "sales", {"Account": pages}, D1)
    assert lake.bronze("sales", "Account").count() == 0  # nothing that the state doesn't count
    ingest.run_family(lake, "sales", {"Account": pages}, D2)
    assert lake.landed(ingest.find_spec("sales", "Account")).count() == 2
    assert lake.bronze("sales", "Account").count() == 2


def test_rows_after_a_reset_are_the_ones_read(lake, write_lines):
    ingest.ingest_entity(lake, "sales", "Account", write_lines("a", [{"records": [account("1", "old", "2024-01-05"), account("2", "gone", "2024-01-05")]}]), D1)
    ingest.reset(lake, "sales")
    assert lake.bronze("sales", "Account").count() == 0
    ingest.ingest_entity(lake, "sales", "Account", write_lines("b", [{"records": [account("1", "fresh", "2024-01-05")]}]), D1)
    assert names(lake) == {"1": "fresh"}
    ingest.reset(lake, "sales")
    ingest.ingest_entity(lake, "sales", "Account", write_lines("c", [{"records": [account("3", "third", "2024-01-01")]}]), D1)
    assert names(lake) == {"3": "third"}


def test_late_replies_and_odd_values(lake, write_lines, tmp_path):
    parent = message("10", reply_count="2", thread_ts="10")
    write_lines("m1/channel_id=C1", [{"messages": [parent, message("soon"), message("11", files=[{"id": "f", "size": "big"}])]}])
    write_lines("r1/channel_id=C1", [{"messages": [parent, message("12", thread_ts="10")]}])
    assert ingest.backfill_chat(lake, D1, messages=str(tmp_path / "m1"), replies=str(tmp_path / "r1"))["records"] == 4
    write_lines("m2/channel_id=C1", [{"messages": [message("later")]}])
    write_lines("r2/channel_id=C1", [{"messages": [parent, message("12", thread_ts="10"), message("13", thread_ts="10")]}])
    assert ingest.backfill_chat(lake, D2, messages=str(tmp_path / "m2"), replies=str(tmp_path / "r2"))["records"] == 2
    empty = write_lines("m3/channel_id=C1", [{"messages": []}])
    write_lines("r3/channel_id=C1", [{"messages": [message("14", thread_ts="10")]}])
    assert ingest.backfill_chat(lake, D3, messages=str(tmp_path / "m3"), replies=str(tmp_path / "r3"))["records"] == 1
    got = {r["message_ts"]: r["reply_count"] for r in lake.bronze("chat", "messages").collect()}
    assert got == {"10": 2, "11": 0, "12": 0, "13": 0, "14": 0, "soon": 0, "later": 0} and empty


def test_a_bounded_extract_goes_on_where_it_ended(lake, write_lines):
    records = [{"Id": f"a{i}", "Name": "n", "LastModifiedDate": f"2024-01-{10 + i}"} for i in range(7)]
    pages = write_lines("in/bounded", [{"records": records[::-1]}])
    taken = [ingest.ingest_entity(lake, "sales", "Account", pages, date(2024, 2, d), max_records=3)["records"] for d in (1, 2, 3)]
    assert taken == [3, 3, 3]  # the last of each load is taken again
    assert lake.bronze("sales", "Account").count() == 7
    assert ingest.ingest_entity(lake, "sales", "Account", pages, date(2024, 2, 4))["records"] == 1
