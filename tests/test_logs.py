"""State logs and event sinks whose reads do not grow with their age."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidewell.operators import files
from tidewell.operators import state as st
from tidewell.streaming import events as live


@pytest.fixture
def often(monkeypatch):
    monkeypatch.setattr(st, "CHECKPOINT", 4)


def folders(spark, log):
    return files.children(spark, log.path)


def test_reads_stay_bounded(spark, tmp_path, often):
    state, want = st.IngestState(spark, str(tmp_path / "s")), {}
    for i in range(40):
        key = f"r{i % 7}"
        state.save("chat" if i % 2 else "sales", key, {"n": i, "completed": i % 3 == 0})
        want["chat" if i % 2 else "sales", key] = i
        names = folders(spark, state)
        assert len(names) <= 2 * 4 + 2  # saves of two rounds, and two checkpoints
    assert len([n for n in names if n.startswith(st.TAKEN)]) <= 2
    got = {(r["pipeline"], r["resource"]): json.loads(r["state"])["n"] for r in state.current().collect()}
    assert got == want
    assert state.load("chat", "r6") == {"n": 27, "completed": True}
    assert len(state.log().inputFiles()) <= 2 * 4 + 2 * 2
    state.clear("chat")
    for i in range(9):
        state.save("sales", "r0", {"n": 100 + i})
    assert state.load("chat", "r6") is None and state.load("sales", "r0") == {"n": 108}
    assert {r["pipeline"] for r in state.current().collect()} == {"sales"}


def test_dying_at_any_point_of_a_checkpoint_loses_nothing(spark, tmp_path, often, monkeypatch):
    for dies in ("write_new", "delete", "_kept"):
        state = st.IngestState(spark, str(tmp_path / dies))
        for i in range(7):
            state.save("p", f"r{i}", {"n": i})
        with monkeypatch.context() as patch:

            def die(*_):
                raise RuntimeError("gone")

            patch.setattr(*((st.IngestState, dies) if dies == "_kept" else (st, dies)), die)
            for i in range(7, 13):
                state.save("p", f"r{i}", {"n": i})
        assert {r["resource"] for r in state.current("p").collect()} == {f"r{i}" for i in range(13)}
        for i in range(13, 24):
            state.save("p", f"r{i}", {"n": i})
        assert {r["resource"] for r in state.current("p").collect()} == {f"r{i}" for i in range(24)}
        assert len(folders(spark, state)) <= 2 * 4 + 4


def test_a_torn_checkpoint_is_not_read(spark, tmp_path, often):
    state = st.IngestState(spark, str(tmp_path / "s"))
    for i in range(5):
        state.save("p", f"r{i}", {"n": i})
    torn = tmp_path / "s" / f"{st.TAKEN}99999999999999999999" / "pipeline=p"
    torn.mkdir(parents=True)
    (torn / "part-0.parquet").write_bytes(b"half")
    assert state.load("p", "r4") == {"n": 4} and state.current("p").count() == 5


def test_a_read_outlives_the_next_checkpoint(spark, tmp_path, often):
    runs = st.RunLog(spark, str(tmp_path / "r"))
    for i in range(3):
        runs.set(f"p{i}", st.RUNNING)
    listed = runs.all()
    for _ in range(4):
        runs.set("p9", st.PAUSED)
    assert listed.count() == 3
    assert runs.get("p1") == st.RUNNING and runs.get("p9") == st.PAUSED and runs.get("none") == st.STOPPED


def test_concurrent_saves(spark, tmp_path, often):
    state = st.IngestState(spark, str(tmp_path / "s"))

    def save(k):
        for i in range(6):
            state.save("p", f"r{k}-{i}", {"n": i})

    threads = [threading.Thread(target=save, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert state.current("p").count() == 24


def test_reports_are_all_kept(spark, tmp_path, often):
    reports = st.Reports(spark, str(tmp_path / "r"))
    for i in range(11):
        reports.add(spark.createDataFrame([("p", f"x{i % 2}", "completed", i, None, float(i), 0.0, None)], st.REPORT_SCHEMA))
    assert reports.log().count() == 11
    assert sorted(rows(reports.newest("p").select("resource", "records"))) == [("x0", 10), ("x1", 9)]


def test_a_batch_lists_its_own_folders_only(spark, tmp_path, write_lines, monkeypatch):
    sink, day = str(tmp_path / "sink"), F.lit("2024-02-01")
    read = []
    landed = live._landed
    monkeypatch.setattr(live, "_landed", lambda s, k, f=None: read.append(f) or landed(s, k, f))

    def event(i):
        return {"type": "events_api", "envelope_id": f"e{i}", "payload": {"event": {"type": "message", "channel": "C1", "user": "u", "text": "t", "ts": f"{i}.5"}}}

    for wave in range(2):
        source = write_lines("in", [event(10 * wave + i) for i in range(3)], f"{wave}.json")
        live.start_event_stream(spark, source, sink, str(tmp_path / "c"), load_date=day, interval=None).awaitTermination()
    held = [f for f in read if f]  # batches without data name no folder
    assert None not in read and len(held) == 2 == len({f[0] for f in held})
    assert all(len(f) == 1 and f[0].startswith("processing_date=2024-02-01/run=") for f in held)
    assert rows(live.read_marks(spark, sink)) == [("C1", "12.5")]
    # damage another day: a read of this one does not see it
    other = tmp_path / "sink" / "events" / "processing_date=2024-01-01" / "run=x" / "batch_id=0"
    other.mkdir(parents=True)
    (other / "part-0.parquet").write_bytes(b"not parquet")
    found = live.read_days(spark, sink, ["2024-02-01", "2023-01-01"])
    assert found.count() == 6 and "2024-01-01" not in plan(found)
    with pytest.raises(ValueError):
        live.read_days(spark, sink, ["../x"])
