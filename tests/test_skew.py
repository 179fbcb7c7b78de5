"""A key that holds a third of all rows, with sides too large to broadcast."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan
from tidewell.functions import epoch
from tidewell.operators.incremental import newer_than, skip_completed
from tidewell.operators.landing import land
from tidewell.operators.messages import thread_replies

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.shuffle.partitions": "20",
}


@pytest.fixture
def cluster_like(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def hot(spark, rows=60_000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string"))
    return spark.range(0, rows, 1, 8).select(key.alias("k"), F.col("id").cast("string").alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def joined_with_split(df, want):
    df.write.format("noop").mode("overwrite").save()
    assert df.count() == want
    df.collect()
    text = plan(df)
    assert "skew=true" in text, text[:3000]


def test_resume_splits_a_hot_channel(cluster_like):
    frame = hot(cluster_like)
    marks = frame.groupBy("k").agg(F.lit("29999").alias("mark"))
    got = newer_than(frame, marks, "k", epoch(F.col("ts")), epoch(F.col("mark")))
    joined_with_split(got, 30_000)


def test_skip_splits_a_hot_key(cluster_like):
    frame = hot(cluster_like)
    state = frame.groupBy("k").agg((F.max("ts") > "6").alias("completed"))
    done = state.where("completed").select("k")
    want = sum(n for k, n in frame.groupBy("k").count().collect() if k not in {r["k"] for r in done.collect()})
    joined_with_split(skip_completed(frame, state, ["k"]), want)


def test_thread_replies_split_a_hot_thread(cluster_like):
    replies = hot(cluster_like).select(F.lit("C").alias("channel_id"), F.col("k").alias("thread_ts"), "ts", "pad")
    numbered = F.when(F.col("thread_ts") == "hot", "0.5").otherwise(F.col("thread_ts"))
    replies = replies.withColumn("thread_ts", numbered)
    parents = replies.groupBy("channel_id", "thread_ts").agg(F.count(F.lit(1)).alias("reply_count"))
    own = replies.where(epoch(F.col("ts")) != epoch(F.col("thread_ts"))).count()
    joined_with_split(thread_replies(parents, replies), own)


def test_landing_splits_a_hot_day(cluster_like, tmp_path):
    frame = hot(cluster_like).withColumn("day", F.when(F.col("k") == "hot", "d0").otherwise(F.concat(F.lit("d"), F.substring("k", 1, 1))))
    path = str(tmp_path / "days")
    assert land(frame, path, ["day"], ["ts"])["rows"] == 60_000
    files = cluster_like.read.parquet(path).select("day", F.col("_metadata.file_path").alias("f")).distinct()
    counts = {r["day"]: r["count"] for r in files.groupBy("day").count().collect()}
    assert counts["d0"] > 1
