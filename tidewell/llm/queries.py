"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import bpe_codec, decontamination, divergence, embeddings, language_id, line_dedup, minhash, packing, prefix_trie, sharding, suffix_dedup, token_files, toxicity
from tidewell.session import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op2_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "removed_chunks", "removed_bytes", F.octet_length("text").alias("kept_bytes"), F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-planes")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_documents(spark, path)


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_toxic_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("toxic", F.col("toxic_probability") >= toxicity.THRESHOLD)


def op7_setsketch_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_repeat_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, window=2048)


def op11_prefix_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(prefix_trie.rebuild(table(spark, sf_dir, "conversations")))


def op12_rank_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe_codec.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), *ranks).drop("text")
    decoded = bpe_codec.decode(encoded, *ranks)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_source_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_language_families, op2_bm25_decontamination, op3_line_chunks, op4_token_planes, op5_feistel_shards, op6_toxic_severity, op7_setsketch_duplicates, op8_projection_passes, op9_repeat_intervals, op10_window_packing, op11_prefix_ranges, op12_rank_codec, op13_source_pairs)
}
