"""Bucketed merges, rollups by signed changes, and distinct counts by bitmaps."""

import json
import os
import random
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidewell.operators import buckets, files
from tidewell.operators.buckets import MergeTable
from tidewell.operators.distinct import DistinctCounts
from tidewell.operators.rollups import MaintainedRollup, Rollup
from tidewell.plans import ingest
from tidewell.plans import maintained as m

SCHEMA = "key string, grp string, amount double, v int"


def table(spark, tmp_path, **options):
    return MergeTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["key"], **{"buckets": 8, **options})


def listed(folder):
    return {os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_upserts_against_a_dictionary(spark, tmp_path):
    random.seed(5)
    t, want = table(spark, tmp_path), {}
    for load in range(4):
        data = [(f"k{random.randrange(60)}", random.choice(["a", "b", None]), float(load), load) for _ in range(40)]
        data = list({r[0]: r for r in data}.values())
        want |= {r[0]: r for r in data}
        t.append(frame(spark, data))
        assert sorted(rows(t.read())) == sorted(want.values(), key=str) or {r[0]: r for r in rows(t.read())} == want
        if load != 2:
            t.merge()
    assert {r[0]: r for r in rows(t.read())} == want
    assert t.merge() == []


def test_a_large_bucket_is_written_in_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "SLICE_ROWS", 100, raising=False)
    t = table(spark, tmp_path, buckets=2)
    rest = [(None, "same", 1.0, 1)] * 300  # equal rows without a key are one bucket's
    t.upsert(frame(spark, [(f"k{i}", "g", 1.0, 1) for i in range(3000)] + rest))
    t.upsert(frame(spark, [(f"k{i}", "h", 2.0, 2) for i in range(2900, 3100)]))
    for gen in t.manifest().merges:
        files = spark.read.parquet(str(tmp_path / "t" / "base" / f"gen={gen}")).groupBy(F.input_file_name()).count()
        assert files.agg(F.max("count")).first()[0] < 900
    assert {r[0]: r[1] for r in rows(t.read()) if r[0]} == {f"k{i}": "g" if i < 2900 else "h" for i in range(3100)}
    assert t.read().where("key IS NULL").count() == 300
    t.append(frame(spark, [("k7", "i", 3.0, 3)]))
    assert t.read().count() == 3400 and rows(t.lookup(key="k7")) == [("k7", "i", 3.0, 3)]


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [(f"k{i}", "g", 1.0, 1) for i in range(200)]))
    before, base = listed(tmp_path / "t" / "base"), t.manifest().base
    touched = t.upsert(frame(spark, [("k7", "h", 2.0, 2)]))
    assert len(touched) == 1
    now = t.manifest().base
    assert {b for b in now if now[b] != base[b]} == set(touched)
    fresh = listed(tmp_path / "t" / "base") - before
    assert before <= listed(tmp_path / "t" / "base")
    assert {f.split("bucket=")[1].split("/")[0] for f in fresh} == {str(touched[0])}
    t.vacuum()
    assert {r[0]: r[1] for r in rows(t.read())} == {f"k{i}": "h" if i == 7 else "g" for i in range(200)}


def test_reads_of_merged_buckets_do_not_shuffle(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [(f"k{i}", "g", 1.0, 1) for i in range(100)]))
    between = t.read().where("key BETWEEN 'k3' AND 'k5'")
    assert "Exchange" not in plan(between) and "PushedFilters: [IsNotNull(key)" in plan(between)
    assert between.count() == 23
    one = t.lookup(key="k42")
    assert "Exchange" not in plan(one) and rows(one) == [("k42", "g", 1.0, 1)]
    opened = one.select(F.input_file_name()).distinct().count()
    assert opened == 1 and len(one.inputFiles()) >= 8  # one bucket's file of all
    t.append(frame(spark, [("k42", "h", 2.0, 2)]))
    assert rows(t.lookup(key="k42")) == [("k42", "h", 2.0, 2)]
    assert t.read().count() == 100


def test_versions_ties_and_rows_without_a_key(spark, tmp_path):
    t = table(spark, tmp_path, version=["v"])
    t.upsert(frame(spark, [("a", "new", 1.0, 5), (None, "x", 1.0, 1), ("", "y", 1.0, 1), (None, "x", 1.0, 1)]))
    t.upsert(frame(spark, [("a", "older", 2.0, 4), (None, "z", 1.0, None)]))
    t.upsert(frame(spark, [("a", "equal", 3.0, 5), ("b", "first", 1.0, 1), ("b", "second", 1.0, 2)]))
    got = sorted((r[0] or "", r[1]) for r in rows(t.read()))
    assert got == [("", "x"), ("", "x"), ("", "y"), ("", "z"), ("a", "equal"), ("b", "second")]
    assert t.upsert(frame(spark, [])) == [] and t.read().count() == 6


def test_of_two_writers_the_second_fails_and_loses_nothing(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [("a", "g", 1.0, 1)]))
    stale = t.manifest()
    t.append(frame(spark, [("b", "g", 1.0, 1)]))
    other = table(spark, tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(other, "manifest", lambda: stale)
        with pytest.raises(FileExistsError):
            other.append(frame(spark, [("c", "g", 1.0, 1)]))
    assert sorted(r[0] for r in rows(t.read())) == ["a", "b"]
    assert not [n for n in files.children(spark, f"{t.path}/manifest") if "json." in n and not n.endswith(".crc")]
    t.merge()
    t.vacuum()
    assert sorted(r[0] for r in rows(t.read())) == ["a", "b"] and len(listed(tmp_path / "t" / "delta")) == 0


def test_a_known_load_is_not_repeated(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [(None, "g", 1.0, 1)]), tag=0)
    t.upsert(frame(spark, [(None, "g", 1.0, 1)]), tag=0)
    assert t.read().count() == 1
    t.upsert(frame(spark, []), tag=1)
    assert t.manifest().tag == 1


def full(data):
    out = defaultdict(lambda: [0, 0, 0.0])
    for _, grp, amount, _ in data:
        out[grp][0] += 1
        if amount is not None:
            out[grp][1] += 1
            out[grp][2] += amount
    return {g: (n, s if k else None, s / k if k else None) for g, (n, k, s) in out.items()}


def test_a_rollup_follows_inserts_changes_and_moves(spark, tmp_path):
    rollup = Rollup(["grp"], {"amount": "amount"}, lambda s: s.select("grp", "rows", rollup.total("amount"), rollup.mean("amount")))
    t, view = table(spark, tmp_path), MaintainedRollup(spark, str(tmp_path / "view"), None)
    view.rollup = rollup
    with pytest.raises(ValueError):
        view.read()
    random.seed(3)
    now = {}
    for load in range(5):
        data = {f"k{random.randrange(50)}": None for _ in range(30)}
        data = [(k, random.choice(["a", "b", "c", None]), random.choice([None, 0.5, 1e15, 0.25, -3.0]), load) for k in data]
        now |= {r[0]: r for r in data}
        t.upsert(frame(spark, data))
        if load == 3:
            t.upsert(frame(spark, [(k, "gone", 1.0, 9) for k in list(now)[:5]]))
            now |= {k: (k, "gone", 1.0, 9) for k in list(now)[:5]}
        view.refresh(t)
        got = {r[0]: tuple(r[1:]) for r in rows(view.read())}
        want = full(now.values())
        assert got.keys() == want.keys()
        for g in want:
            assert got[g] == pytest.approx(want[g])
    # everything leaves a group, and the group goes
    t.upsert(frame(spark, [(k, "one", None, 10) for k in now]))
    view.refresh(t)
    assert rows(view.read()) == [("one", len(now), None, None)]


def test_a_refresh_reads_changed_rows_only(spark, tmp_path):
    rollup = Rollup(["grp"])
    t, view = table(spark, tmp_path), MaintainedRollup(spark, str(tmp_path / "view"), rollup)
    t.upsert(frame(spark, [(f"k{i}", "g", 1.0, 1) for i in range(300)]))
    view.refresh(t)
    through = t.merged_through()
    t.upsert(frame(spark, [("k1", "h", 1.0, 2), ("new", "h", 1.0, 2)]))
    assert sorted(rows(t.changes(through).select("key", "grp", "_sign"))) == [("k1", "g", -1), ("k1", "h", 1), ("new", "h", 1)]
    view.refresh(t)
    view.refresh(t)  # nothing new
    assert sorted(rows(view.read())) == [("g", 299), ("h", 2)]
    # changes that were vacuumed before they were read: the table itself is rolled up
    t.upsert(frame(spark, [("k2", "h", 1.0, 3)]))
    t.vacuum()
    t.upsert(frame(spark, [("k3", "h", 1.0, 4)]))
    assert t.changes(through) is None and t.changes() is None
    view.refresh(t)
    assert sorted(rows(view.read())) == [("g", 297), ("h", 4)]


def test_distinct_counts_over_increments(spark, tmp_path):
    random.seed(8)
    counts = DistinctCounts(spark, str(tmp_path / "d"), ["g"], "value", buckets=3)
    with pytest.raises(ValueError):
        counts.counts()
    want = defaultdict(set)
    for load in range(4):
        data = [(random.choice(["a", "b", None]), random.choice([None, *map(str, range(70_000 if load == 3 else 60))])) for _ in range(3000)]
        data.append(("only null", None))
        for g, v in data:
            want[g].update(set() if v is None else {v})
        df = spark.createDataFrame(data, "g string, value string")
        if load == 2:  # an attempt that died after its dictionary
            df.select("value").where("value IS NOT NULL").distinct().selectExpr("value", "0 AS bucket", "99L AS place").write.parquet(
                f"{counts.path}/dictionary/increment={load + 1:012d}"
            )
        assert counts.add(df) == load + 1
    assert dict(rows(counts.counts())) == {g: len(v) for g, v in want.items()}


def test_an_increment_reads_no_history(spark, tmp_path):
    view = m.channel_activity(spark, str(tmp_path / "a"))
    schema = "channel_id string, channel_name string, message_ts string, user_id string, reply_count int, file_count int"
    first = tmp_path / "first"
    spark.createDataFrame([("C1", "one", "5.25", "u1", 1, 0), ("C1", "one", "3", "u2", 1, 2), (None, None, "x", None, 0, 0)], schema).write.parquet(str(first))
    view.add(spark.read.parquet(str(first)))
    for path in first.glob("*.parquet"):
        path.unlink()  # history is gone
    view.add(spark.createDataFrame([("C1", "one", "7", "u2", 2, 0), ("C2", "two", "1.5", "u1", 0, 0)], schema))
    got = {r["channel_id"]: tuple(r)[2:] for r in view.read().collect()}
    assert got == {"C1": (3, 2, "7", "3", 4, 2), "C2": (1, 1, "1.5", "1.5", 0, 0), None: (1, 0, None, None, 0, 0)}


def test_a_lake_reads_from_merged_loads(spark, tmp_path, write_lines):
    lake = ingest.Lake(spark, str(tmp_path / "lake"))

    def load(day, names):
        pages = write_lines(f"in/{day}", [{"records": [{"Id": k, "Name": v, "LastModifiedDate": f"2024-01-{day:02d}"} for k, v in names.items()]}])
        ingest.ingest_entity(lake, "sales", "Account", pages, date(2024, 2, day))

    def names():
        return {r["Id"]: r["Name"] for r in lake.bronze("sales", "Account").collect()}

    load(1, {f"a{i}": "first" for i in range(50)})
    assert lake.merge_loads("sales", "Account", buckets=16)
    load(2, {"a3": "second"})
    assert names() == {f"a{i}": "second" if i == 3 else "first" for i in range(50)}
    assert len(lake.merge_loads("sales", "Account")) == 1
    assert "Exchange" not in plan(lake.bronze("sales", "Account"))
    assert names()["a3"] == "second" and len(names()) == 50
    state = lake.state.load("sales", "Account/merged")
    lake.state.save("sales", "Account/merged", state | {"through": 0})  # died before its state was saved
    assert lake.merge_loads("sales", "Account") == [] and len(names()) == 50
    ingest.reset(lake, "sales")
    load(3, {"b": "new"})
    assert names() == {"b": "new"}
    lake.merge_loads("sales", "Account", buckets=2)
    assert names() == {"b": "new"}
    (manifest,) = (tmp_path / "lake/sales/Account_merged").glob("since=[!0]*/table=0/manifest/*2.json")
    assert json.loads(manifest.read_text())["buckets"] == 2
