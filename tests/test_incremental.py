from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidewell.functions import epoch, epoch_key, epoch_text
from tidewell.operators.incremental import high_water_marks, latest_per_key, modified_since, newer_than, skip_completed
from tidewell.operators.state import IngestState, RunLog


def test_epoch_key_orders_as_number_and_returns_the_text(spark):
    texts = ["999.5", "1000.25", "1000.250", "5", "0.000000001", "1700000000.123456", "0.0", "0"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows(frame.select("t", epoch_text(epoch_key(F.col("t")))))
    assert all(a == b for a, b in got)
    order = [r["t"] for r in frame.orderBy(epoch_key(F.col("t"))).collect()]
    assert order == ["0", "0.0", "0.000000001", "5", "999.5", "1000.25", "1000.250", "1700000000.123456"]
    bad = spark.createDataFrame([("",), ("abc",), (None,), ("-1.5",), (" 5",), ("1.0000000001",), ("9" * 19,), ("1e3",)], "t string")
    assert {v for r in bad.select(epoch_key(F.col("t")), epoch(F.col("t"))).collect() for v in r} == {None}
    longest = spark.createDataFrame([("9" * 18 + "." + "9" * 9,)], "t string")
    assert longest.select(epoch_text(epoch_key(F.col("t")))).first()[0] == "9" * 18 + "." + "9" * 9


def test_marks_compare_numbers(spark):
    frame = spark.createDataFrame([("a", "999.5"), ("a", "1000.25"), ("b", "7"), ("c", "")], "k string, ts string")
    assert rows(high_water_marks(frame, "k", "ts"), "k") == [("a", "1000.25"), ("b", "7"), ("c", None)]
    assert "SortAggregate" not in plan(high_water_marks(frame, "k", "ts"))


def test_newer_than_mark(spark):
    frame = spark.createDataFrame(
        [("a", "999.5"), ("a", "1000.25"), ("a", "1000.3"), ("a", "soon"), ("new", "1"), (None, "2")], "k string, ts string"
    )
    marks = spark.createDataFrame([("a", "1000.25"), ("gone", "5")], "k string, mark string")
    got = newer_than(frame, marks, "k", epoch(F.col("ts")), epoch(F.col("mark")))
    assert sorted(r["ts"] for r in got.collect()) == ["1", "1000.3", "2", "soon"]
    assert sorted(got.columns) == ["k", "ts"]


def test_skip_completed(spark):
    work = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    state = spark.createDataFrame([("a", True), ("b", False)], "k string, completed boolean")
    assert sorted(r["n"] for r in skip_completed(work, state, ["k"]).collect()) == [2, 3]


def test_latest_per_key(spark):
    frame = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), ("a", None, "undated"), ("b", None, "only"), ("c", 1, "x"), ("c", 1, "y"),
         (None, 1, "n1"), (None, 1, "n1"), ("", 1, "e1"), ("", 2, "e2")],
        "k string, v int, t string",
    )
    got = latest_per_key(frame, ["k"], ["v"])
    assert got.columns == frame.columns
    assert sorted(r["t"] for r in got.collect()) == ["e1", "e2", "n1", "n1", "new", "only", "y"]
    compound = latest_per_key(frame.withColumn("m", F.create_map("t", "v")), ["k", "t"], ["v"])
    assert compound.count() == 10
    assert plan(latest_per_key(frame, ["k"], ["v"])).count("Scan ExistingRDD") == 1  # the input is read once


def test_latest_per_key_shrinks_before_the_shuffle(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    frame = spark.range(1000).select(key.alias("k"), F.col("id").alias("v"), F.lit("t").alias("t"))
    text = plan(latest_per_key(frame, ["k"], ["v"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert "1, Partial" in text[text.index("Exchange hashpartitioning"):]


@pytest.mark.parametrize("inclusive, want", [(False, ["c", "none"]), (True, ["b", "c", "none"])])
def test_modified_since_falls_back_to_created(spark, inclusive, want):
    frame = spark.createDataFrame(
        [("a", "2024-01-01", "2024-09-09"), ("b", "", "2024-02-02"), ("c", None, "2024-03-03"), ("none", None, "")],
        "id string, m string, c string",
    )
    got = modified_since(frame, ("m", "c"), "2024-02-02", inclusive)
    assert sorted(r["id"] for r in got.collect()) == want
    assert modified_since(frame, ("m", "c"), None).count() == 4


def test_state_log(spark, tmp_path):
    state = IngestState(spark, str(tmp_path / "state"))
    assert state.load("chat", "x") is None
    state.save("chat", "x", {"completed": False, "last_timestamp": "1"})
    state.save("chat", "x", {"completed": True, "last_timestamp": "2"})
    state.save("chat", "y", {"n": 1})
    state.save("sales", "x", {"n": 2})
    assert state.load("chat", "x") == {"completed": True, "last_timestamp": "2"}
    assert state.load_some("chat", "x", "none") == {"x": {"completed": True, "last_timestamp": "2"}}
    assert rows(state.current("chat").select("resource", "completed"), "resource") == [("x", True), ("y", False)]
    state.clear("chat", "x")
    assert state.load("chat", "x") is None and state.current().count() == 2
    state.save("chat", "x", {"n": 3})
    state.clear("chat")
    assert state.current("chat").count() == 0 and state.load("sales", "x") == {"n": 2}
    many = spark.createDataFrame([("chat", "c1", '{"completed": true, "m": "5"}'), ("chat", "c2", "{}")],
                                 "pipeline string, resource string, state string")
    state.save_all(many)
    assert state.load("chat", "c1")["m"] == "5"
    assert rows(state.current("chat").select("resource", "completed"), "resource") == [("c1", True), ("c2", False)]
    # A second object over the same folder sees the same state.
    assert IngestState(spark, str(tmp_path / "state")).load("chat", "c1")["m"] == "5"


def test_run_log(spark, tmp_path):
    runs = RunLog(spark, str(tmp_path / "runs"))
    assert runs.get("chat") == "stopped"
    runs.set("chat", "running", "live", {"by": "test"})
    runs.set("chat", "paused")
    assert (runs.get("chat", "live"), runs.get("chat")) == ("running", "paused")
    runs.set("chat", "completed")
    assert rows(runs.all().select("mode", "state"), "mode") == [("batch", "completed"), ("live", "running")]
    with pytest.raises(ValueError):
        runs.set("chat", "sleeping")


def test_saves_at_the_same_time_are_all_kept(spark, tmp_path):
    state = IngestState(spark, str(tmp_path / "state"))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda n: state.save("chat", f"r{n}", {"n": n}), range(16)))
    assert state.current("chat").count() == 16
