"""A training corpus from raw documents: five stages, each over all that the one before kept.

Every stage takes the session, the documents so far and the folder of tables, and returns a
DataFrame, which is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontamination, line_dedup, minhash, packing, toxicity
from tidewell.session import bound_batches, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit the severity model on the labelled documents and drop those toxic with a chance of 0.3 or more."""
    bound_batches(spark)
    return toxicity.reject(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated runs of lines; a document of which nothing is left goes, one that was empty stays."""
    bound_batches(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cleaned = line_dedup.remove_runs(docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(c) for c in others]).alias("others")))
    kept = cleaned.filter((F.col("removed_chunks") == 0) | F.col("text").rlike(r"\S"))
    fresh = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*[fresh.get(c, F.col(f"others.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one with the smallest id."""
    path = scratch(spark, "near-duplicates")
    gone = minhash.near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    gone.write.parquet(path)
    gone = spark.read.parquet(path)
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    bound_batches(spark)
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids of what is left into windows of 2048."""
    bound_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, window=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_windows),
]

#: Sketches, line hashes and a fitted model are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch(spark, f"stage-{k}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
    return out
