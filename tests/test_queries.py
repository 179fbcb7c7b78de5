"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from proof import adapters as a
from tools.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_statement_has_its_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["StageName", "deal_count", "total_amount", "avg_amount", "avg_probability"]
    assert got.count() == 5


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR).toPandas()
    if name not in SQL:
        assert len(ours) > 0
        return
    assert compare(ours, duck.execute(SQL[name]).df()) is None


@pytest.fixture(scope="module")
def repeated(tmp_path_factory):
    """The smallest tables with every event three times, under keys of its own."""
    folder = tmp_path_factory.mktemp("repeated")
    for name in os.listdir(SF_DIR):
        if name != "events.parquet":
            os.symlink(f"{SF_DIR}/{name}", folder / name)
    copies = f"SELECT * REPLACE (event_id + k * 1000000 AS event_id) FROM '{SF_DIR}/events.parquet', range(3) r(k)"
    duckdb.sql(f"COPY ({copies}) TO '{folder}/events.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", ["unify_history_and_live", "chat_backfill"])
def test_events_of_one_channel_and_microsecond_are_several_messages(spark, repeated, name):
    ours = QUERIES[name](spark, repeated).toPandas()
    assert compare(ours, connect(repeated).execute(SQL[name]).df()) is None


def test_messages_beyond_the_digits_of_a_time_are_told_apart(spark):
    events = spark.range(250).selectExpr("id AS event_id", "timestamp_ntz'2024-01-02 00:00:00.5' AS ts", "7L AS user_id", "'view' AS event_type", "'{}' AS props")
    told = a.numbered_messages(events)
    assert told.select("channel_id", "message_ts").distinct().count() == 250
    assert told.select("channel_id").distinct().count() == 3
    for column, want in (("message_ts", "86400.500000"), ("reply_ts", "86400.5000005")):
        assert [tuple(r) for r in told.select(a.told_channel("channel_id"), a.told_time(column)).distinct().collect()] == [("C7", want)]
