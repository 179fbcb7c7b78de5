import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidewell.model import CHAT, SALES
from tidewell.operators import reports, tables
from tidewell.operators.landing import append_bronze, land, replace, write_parquet
from tidewell.plans.marts import MARTS, publish_views
from tidewell.session import scratch, shared_root
from tidewell.sources import list_files, load_bronze, read_landed, read_named


def frame(spark, *values):
    return spark.createDataFrame(list(values), "id string, day string, n int")


@pytest.mark.parametrize("codec", ["snappy", "gzip", "zstd", "none"])
def test_write_parquet(spark, tmp_path, codec):
    path = str(tmp_path / codec)
    assert write_parquet(frame(spark, ("a", "1", 1), ("b", "1", 2)), path, codec) == 2
    assert rows(read_landed(spark, path), "id") == [("a", "1", 1), ("b", "1", 2)]
    names = [f for f in os.listdir(path) if f.startswith("part-")]
    assert codec == "none" or all(f".{codec if codec != 'gzip' else 'gz'}." in f for f in names)


def test_write_parquet_refuses_nothing_and_unknown_codecs(spark, tmp_path):
    with pytest.raises(ValueError):
        write_parquet(frame(spark, ("a", "1", 1)).where("n > 1"), str(tmp_path / "x"))
    with pytest.raises(ValueError):
        write_parquet(frame(spark, ("a", "1", 1)), str(tmp_path / "y"), "brotli")


def test_land_replaces_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "d")
    first = frame(spark, ("a", "d1", 1), ("b", "d1", 2), ("c", "d2", 3))
    assert land(first, path, ["day"], ["id"], measures={"top": F.max("n")}) == {"rows": 3, "top": 3}
    land(first, path, ["day"], ["id"])
    again = frame(spark, ("b", "d1", 20))
    assert land(again, path, ["day"], ["id"])["rows"] == 1
    assert rows(read_landed(spark, path, first.schema).select("id", "day", "n"), "id") == [("b", "d1", 20), ("c", "d2", 3)]
    assert land(again.where("n < 0"), path, ["day"])["rows"] == 0
    assert read_landed(spark, path).count() == 2


def test_land_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "d")
    land(frame(spark, ("a", "d1", 1), ("c", "d2", 3)), path, ["day"])
    text = plan(read_landed(spark, path).where("day = 'd1'").select("id"))
    assert "PartitionFilters: [isnotnull(day" in text and "ReadSchema: struct<id:string>" in text


@pytest.mark.parametrize("shuffle", [True, False])
def test_landed_files_are_sorted(spark, tmp_path, shuffle):
    ids = spark.range(0, 3000, 1, 3).select(F.sha1(F.col("id").cast("string")).alias("id"), F.lit("d1").alias("day"))
    path = str(tmp_path / "d")
    land(ids, path, ["day"], ["id"], shuffle=shuffle)
    place = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id())
    landed = rows(spark.read.parquet(path).select(place, "id"))
    by_file: dict = {}
    for (file, at), key in sorted(landed):
        by_file.setdefault(file, []).append(key)
    assert len(landed) == 3000 and all(keys == sorted(keys) for keys in by_file.values())


def test_replace_and_append(spark, tmp_path):
    spec = CHAT["users"]
    path = str(tmp_path / "users")
    users = spark.createDataFrame([("U1", "n", True), ("U2", "m", False)], "id string, name string, is_admin boolean")
    append_bronze(users, path, spec)
    assert append_bronze(users, path, spec) == 2
    assert load_bronze(spark, path, spec).count() == 4
    assert replace(users.limit(1), path) == 1
    assert load_bronze(spark, path, spec).columns == spec.names


def test_read_by_file_name(spark, tmp_path):
    for name in ("users", "channels"):
        frame(spark, (name, "1", 1)).coalesce(1).write.parquet(str(tmp_path / "h" / name))
        part = next(f for f in os.listdir(tmp_path / "h" / name) if f.startswith("part-"))
        os.link(tmp_path / "h" / name / part, tmp_path / "h" / f"{name}.parquet")
    assert rows(read_named(spark, str(tmp_path / "h"), "users.parquet")) == [("users", "1", 1)]


def test_file_listing_and_storage_stats(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.bin").write_bytes(b"x" * 1048576)
    (tmp_path / "two.bin").write_bytes(b"y" * 524288)
    listed = list_files(spark, str(tmp_path))
    assert rows(listed.select("size", "is_dir"), "size") == [(524288, False), (1048576, False)]
    stats = reports.storage_stats(spark, {"all": str(tmp_path), "a": str(tmp_path / "a")})
    assert rows(stats, "dataset") == [("a", 1, 1048576, 1.0), ("all", 2, 1572864, 1.5)]


def test_tables_views_and_catalog(spark, tmp_path):
    spec = SALES["Opportunity"]
    tables.drop_table(spark, spec.table)  # other tests define it elsewhere
    ddl = tables.create_family(spark, "sales", str(tmp_path))
    assert len(ddl) == 12 and "IF NOT EXISTS" in ddl[0]
    tables.create_family(spark, "sales", str(tmp_path))
    assert len(tables.list_tables(spark, "bronze_sales_")) == 12
    assert tables.table_exists(spark, spec.table) and not tables.table_exists(spark, "bronze_none")
    deals = spark.createDataFrame(
        [("1", "won", 10.0, 50, [1]), ("2", "won", 30.0, 100, None), ("3", "open", None, None, None)],
        "Id string, StageName string, Amount double, Probability int, LeadSource array<int>",
    )
    assert tables.sort_key(spark, spec.table) == ["Id"]
    tables.insert_rows(deals.orderBy(F.col("Id").desc()).coalesce(1), spec.table)
    assert [r["Id"] for r in spark.table(spec.table).collect()] == ["1", "2", "3"]
    tables.insert_rows(deals.where("Id = '1'"), spec.table, ["Id", "StageName"])
    assert spark.table(spec.table).where("LeadSource = '[1]'").count() == 1
    with pytest.raises(ValueError):
        tables.insert_rows(deals.withColumnRenamed("Id", "Key"), spec.table)
    published = publish_views(spark, "sales")
    assert published == [m.view for m in MARTS if m.family == "sales"] and published == publish_views(spark, "sales", replace=False)
    assert set(published) <= set(tables.list_views(spark, "v_sales_"))
    got = rows(tables.preview(spark, "v_sales_pipeline_summary", 1))
    assert got == [("won", 3, 40.0, 20.0, 75.0)]
    with pytest.raises(ValueError):
        tables.preview(spark, "other_table")
    columns = tables.list_columns(spark, spec.table)
    assert ("Amount", "double") in rows(columns) and columns.count() == len(spec.names)
    stats = {r["name"]: r for r in reports.family_stats(spark, "sales").collect()}
    assert len(stats) == 12 and (stats[spec.table]["rows"], stats[spec.table]["columns"]) == (4, 13)
    everything = {r["name"]: r for r in reports.overview(spark).collect()}
    assert everything[spec.table]["rows"] == 4 and everything["v_sales_pipeline_summary"]["rows"] is None
    assert tables.query(spark, f"SELECT count(*) AS n FROM {spec.table}").first()["n"] == 4
    for name in tables.list_tables(spark, "bronze_sales_"):
        tables.drop_table(spark, name)
    assert tables.list_tables(spark, "bronze_sales_") == []
    assert reports.family_stats(spark, "sales").count() == 0


def test_managed_table_truncate_partition_and_names(spark):
    ddl = tables.create_named_table(spark, "bronze_named", {"id": "str", "n": "int", "tags": "list"}, partition_by=["n"],
                                    order_by=["id", "tags"])
    assert "PARTITIONED BY (`n`)" in ddl and tables.sort_key(spark, "bronze_named") == ["id", "tags"]
    tables.insert_rows(spark.createDataFrame([("a", 1)], "id string, n int"), "bronze_named")
    assert spark.table("bronze_named").count() == 1
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.create_named_table(spark, "bronze_named", {"id": "str"}, if_not_exists=False)
    tables.truncate_table(spark, "bronze_named")
    assert spark.table("bronze_named").count() == 0
    tables.drop_table(spark, "bronze_named")
    tables.drop_table(spark, "bronze_named")


def test_view_modes(spark):
    assert tables.create_view(spark.range(1), "v_mode")
    assert not tables.create_view(spark.range(2), "v_mode", replace=False)
    assert spark.table("v_mode").count() == 1
    assert tables.create_view(spark.range(2), "v_mode") and spark.table("v_mode").count() == 2


def test_summaries(spark, tmp_path):
    report = spark.createDataFrame(
        [("completed", 5), ("completed", 7), ("failed", 0), ("paused", 0), ("pending", None)], "status string, records long"
    )
    assert reports.run_summary(report).first().asDict() == {
        "total": 5, "completed": 2, "failed": 1, "running": 0, "pending": 1, "paused": 1, "total_records": 12,
    }
    assert reports.run_summary(report.where("records > 99")).first()["total_records"] == 0
    path = str(tmp_path / "d")
    spark.range(10).repartition(3).write.parquet(path)
    described = rows(reports.describe_dataset(spark.read.parquet(path), "d"))
    assert described == [("d", 10, 1, 3, 1, "id", "bigint", True)]
    channels = spark.createDataFrame([("C1", "a"), ("C2", "b")], "id string, name string")
    messages = spark.createDataFrame([("C1",), ("C1",)], "channel_id string")
    assert rows(reports.channel_counts(messages, channels), "channel_id") == [("C1", "a", 2), ("C2", "b", 0)]
    assert rows(reports.workspace_totals(channels, channels, messages)) == [("channels", 2), ("users", 2), ("messages", 2)]


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake_session(master, **conf):
    get = lambda key, default=None: conf.get(key.replace(".", "_"), default)
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=FakeContext(master))


def test_shared_folder_comes_from_the_session():
    named = fake_session("yarn", spark_checkpoint_dir="hdfs:/shared/place/")
    assert shared_root(named) == "hdfs:/shared/place"
    assert scratch(named, "x").startswith("hdfs:/shared/place/tidewell/x-")
    with pytest.raises(ValueError):
        shared_root(fake_session("yarn"))
    local = fake_session("local[2]")
    assert shared_root(local) == shared_root(local)
