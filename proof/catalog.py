"""Catalog, file scans, attachments and run control over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.model import CHAT
from tidewell.operators import reports, tables
from tidewell.operators.flatten import expand_list
from tidewell.operators.landing import write_parquet
from tidewell.operators.state import COMPLETED, FAILED, RUNNING, RunLog
from tidewell.plans.ingest import Lake
from tidewell.plans.live import LiveFeed
from tidewell.session import scratch
from tidewell.sources.landed import read_named
from tidewell.streaming import events as live

from . import adapters as a

#: Columns in the generic type names that extracts use.
GENERIC = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_name": "string", "c_acctbal": "float", "c_custkey": "int", "active": "bool", "tags": "list"},
}


def scan_by_suffix(spark, sf_dir):
    """Orders in two codecs in nested folders of one root, of which one codec's files are read."""
    root = scratch(spark, "suffix")
    orders = a.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for status, codec in (("F", "zstd"), ("O", "gzip"), ("P", "snappy")):
        write_parquet(orders.where(F.col("o_orderstatus") == status), f"{root}/by/{codec}", codec)
    return read_named(spark, root, ".zstd.parquet", orders.schema)


def _generic_tables(spark, sf_dir, prefix: str) -> list[str]:
    names = []
    for name, columns in GENERIC.items():
        table = f"{prefix}{name}"
        tables.drop_table(spark, table)
        tables.create_named_table(spark, table, columns, location=scratch(spark, table))
        rows = a.load(spark, sf_dir, name)
        tables.insert_rows(rows, table, [c for c in columns if c in rows.columns])
        names.append(table)
    return names


def column_catalog(spark, sf_dir):
    """Columns and types of tables made from generic type names, with their rows."""
    names = _generic_tables(spark, sf_dir, "bronze_columns_")
    listed = [tables.list_columns(spark, n).select(F.lit(n).alias("table"), "name", "type") for n in tables.list_tables(spark, "bronze_columns_")]
    stats = reports.table_stats({n: spark.table(n) for n in names}).select(F.col("name").alias("table"), "rows")
    return reduce(DataFrame.unionAll, listed).join(stats, "table")


def table_overview(spark, sf_dir):
    """Tables with their rows, and a view, as the catalog lists them."""
    names = _generic_tables(spark, sf_dir, "bronze_overview_")
    tables.create_view(spark.table(names[0]), "v_overview_region")
    return reports.overview(spark).where(F.col("name").rlike("^(bronze|v)_overview_"))


def family_statistics(spark, sf_dir):
    """The chat family's tables, created as a whole, three of them filled."""
    for spec in CHAT.values():
        tables.drop_table(spark, spec.table)
    tables.create_family(spark, "chat", scratch(spark, "family"))
    users = a.load(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    tables.insert_rows(users, CHAT["users"].table)
    tables.insert_rows(a.load(spark, sf_dir, "nation").select(F.col("n_name").alias("id"), F.col("n_name").alias("name")), CHAT["channels"].table)
    tables.insert_rows(a.chat_messages(spark, sf_dir), CHAT["messages"].table)
    return reports.family_stats(spark, "chat").drop("columns")


def truncate_and_reload(spark, sf_dir):
    """A managed table filled, emptied and filled with other rows."""
    name = "bronze_reload"
    orders = a.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    tables.drop_table(spark, name)
    tables.create_table(spark, name, orders.schema)
    tables.insert_rows(orders, name)
    tables.truncate_table(spark, name)
    tables.insert_rows(orders.where("o_orderstatus = 'O'"), name)
    return spark.table(name)


def file_attachments(spark, sf_dir):
    """Files of chat messages, one row each."""
    n = (F.col("event_id") % 4).cast("int")
    one = F.transform(
        F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
        lambda k: F.struct(
            F.concat(F.lit("F"), F.col("event_id").cast("string"), F.lit("-"), k.cast("string")).alias("id"),
            F.concat(F.col("event_type"), F.lit(".txt")).alias("name"), (F.length("props") * k).alias("size"),
        ),
    )
    messages = a.load(spark, sf_dir, "events").select(a.channel_of().alias("channel_id"), a.seconds_text().alias("ts"), F.when(n != 1, one).alias("files"))
    return expand_list(messages, ["channel_id", "ts"], "files")


def run_states(spark, sf_dir):
    """Run states of a pipeline per region, the newest of each."""
    runs = RunLog(spark, scratch(spark, "runs"))
    for row in a.load(spark, sf_dir, "region").orderBy("r_regionkey").collect():  # five rows
        key = row["r_regionkey"]
        runs.set(row["r_name"], RUNNING, "live" if key % 2 else "batch", {"region": key})
        if key != 3:
            runs.set(row["r_name"], FAILED if key == 4 else COMPLETED, "live" if key % 2 else "batch")
    return runs.all().select("pipeline", "mode", "state")


def feed_pause_resume(spark, sf_dir):
    """A live feed paused before its events come, resumed by a new object, and stopped."""
    lake = Lake(spark, scratch(spark, "feed"))
    source = f"{lake.root}/in"
    a.write_texts(a.load(spark, sf_dir, "region").select(F.lit('{"type":"hello"}').alias("value")), source)
    feed = LiveFeed(lake, source, load_date=F.lit(a.LOAD_DATE), interval="1 second")
    feed.start()
    feed.pause()
    a.write_texts(a.envelopes_json(spark, sf_dir), source)
    again = LiveFeed(lake, source, load_date=F.lit(a.LOAD_DATE), interval="1 second")
    again.resume()
    again.stop()
    state = again.status()
    return live.read_counters(spark, again._counters).select(F.lit(state["state"]).alias("state"), F.lit(state["running"]).alias("running"), "event_type", "events")
