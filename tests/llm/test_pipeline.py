import re

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_shrink(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    source = docs.withColumn("_gone", F.lit(1)).withColumn("removed_chunks", F.lit("x"))
    now = source
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, SF)
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == source.columns
            assert after.count() <= now.count() and after.select("doc_id").distinct().count() == after.count()
            assert after.count() > 0.8 * now.count()
        now = after
    assert now.agg(F.sum("length")).first()[0] == now.groupBy("doc_id").agg(F.first("doc_tokens").alias("n")).agg(F.sum("n")).first()[0]


def test_stages_on_nothing(spark, tmp_path):
    now = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, SF).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        assert now.count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_long_texts_travel_in_batches_of_few_bytes(spark, tmp_path, stage):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage(spark, docs, SF).write.parquet(str(tmp_path / "out"))

    def run(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    long = spark.range(600, numPartitions=1).select(F.repeat(F.lit("a word "), 5_000).alias("text"))
    assert long.mapInArrow(run, "n long").agg(F.max("n")).first()[0] < 8 << 20  # of 21 MB


def test_rejecting_sends_each_text_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.toxicity.reject(docs, None)
    assert kept.columns == docs.columns and kept.exceptAll(docs).isEmpty() and kept.count() == docs.count()
    sent = kept._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[1].split("Project")[1].split("\n")[0]
    assert len(re.findall(r"\btext#", sent)) == 1


def test_planted_cases(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 150").first()["text"]
    words = " ".join(f"word{i} plain" for i in range(60))
    near = words.replace("word30", "other")
    planted = [(9001, words), (9002, words), (9003, near), (9004, "unlike " + " ".join(f"x{i}" for i in range(50)) + " " + item), (9005, "clean " + " ".join(f"y{i}" for i in range(50)))]
    extra = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in planted], docs.schema)
    now = docs.unionAll(extra)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, now, SF).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
    assert {r["doc_id"] for r in now.filter("doc_id > 9000").collect()} == {9001, 9005}


@pytest.mark.parametrize("n", range(1, 11))
def test_each_operator_is_registered(n):
    assert sum(x.startswith(f"op{n}_") for x in entry.queries()) == 1


def test_pipeline_is_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
