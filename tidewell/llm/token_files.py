"""Token ids in files of bit-plane shuffled chunks.

A dataset is a folder of Parquet files, so that Spark's commit protocol decides which task's
output counts. A row is a *segment*: some whole documents in ascending ``doc_id`` order and
their ids as one payload. The ids are cut into chunks of a fixed number; a chunk is transposed
into byte planes (or bit planes) and each plane is compressed by zstandard on its own, so the
high planes, which are nearly constant, take next to nothing. The columns beside the payload
are the chunk index: Parquet reads them without touching the payload.

Ids are unsigned 32-bit numbers. Null ids come first; a null text has the end id only; repeated
``doc_id`` are ordered by text; an empty table gives an empty dataset. Columns of the input
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm import tokens

#: Ids in a chunk, and in a segment unless its last document is longer.
CHUNK, SEGMENT = 1 << 16, 1 << 20

SCHEMA = (
    "shard int, segment int, n_tokens long, planes string, doc_ids array<long>, doc_tokens array<long>, "
    "chunk_ids array<int>, chunk_bytes array<int>, plane_bytes array<int>, payload binary"
)
ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()), ("planes", pa.string()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
        ("chunk_ids", pa.list_(pa.int32())), ("chunk_bytes", pa.list_(pa.int32())), ("plane_bytes", pa.list_(pa.int32())),
        ("payload", pa.binary()),
    ]
)


def split_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of a chunk, lowest first: 4 of bytes or 32 of bits."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [octets[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def join_planes(parts: list[bytes], n: int, planes: str) -> np.ndarray:
    """The inverse of split_planes."""
    if planes == "byte":
        return np.stack([np.frombuffer(x, np.uint8) for x in parts], 1).reshape(-1).view("<u4")
    bits = np.stack([np.unpackbits(np.frombuffer(x, np.uint8), count=n, bitorder="little") for x in parts], 1)
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


def pack(ids: np.ndarray, planes: str, chunk: int, level: int = 1) -> dict:
    """Payload and chunk index of one segment."""
    press = zstandard.ZstdCompressor(level=level)
    sizes, per_chunk, per_plane, payload = [], [], [], []
    for at in range(0, len(ids), chunk):
        part = ids[at : at + chunk]
        packed = [press.compress(x) for x in split_planes(part, planes)]
        sizes.append(len(part))
        per_chunk.append(sum(map(len, packed)))
        per_plane.extend(map(len, packed))
        payload.extend(packed)
    return {"chunk_ids": sizes, "chunk_bytes": per_chunk, "plane_bytes": per_plane, "payload": b"".join(payload)}


def unpack(row: dict, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids first to last of a segment; only the chunks that hold them are decompressed."""
    press, count = zstandard.ZstdDecompressor(), 4 if row["planes"] == "byte" else 32
    last = row["n_tokens"] if last is None else last
    out, begin, at, base = [], None, 0, 0
    for k, (n, size) in enumerate(zip(row["chunk_ids"], row["chunk_bytes"])):
        if base < last and base + n > first:
            begin = base if begin is None else begin
            parts, place = [], at
            for m in row["plane_bytes"][k * count : (k + 1) * count]:
                parts.append(press.decompress(row["payload"][place : place + m]))
                place += m
            out.append(join_planes(parts, n, row["planes"]))
        at, base = at + size, base + n
    if begin is None:
        return np.zeros(0, "<u4")
    return np.concatenate(out)[first - begin : last - begin]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, planes: str = "byte", chunk: int = CHUNK, segment: int = SEGMENT) -> None:
    """Encode whole texts, each with ``end_id`` after it, and write them in ``doc_id`` order.

    The one shuffle deals documents by ranges of ``doc_id``. A segment ends with the document
    that fills it, so a task holds one segment and one batch whatever the size of its range.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, ids, names, lengths = TaskContext.get().partitionId(), 0, [], [], []
        held = 0

        def close() -> pa.RecordBatch:
            row = {"shard": shard, "segment": number, "n_tokens": held, "planes": planes, "doc_ids": names, "doc_tokens": lengths}
            return pa.RecordBatch.from_pylist([row | pack(np.concatenate(ids), planes, chunk)], ARROW)

        end = np.array([end_id], np.uint32)
        for batch in batches:
            all_ids, bounds = tokens.encoder(tokenizer).encode(batch.column("text"))
            for name, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                ids.extend((all_ids[a:b], end))
                names.append(name)
                lengths.append(b - a + 1)
                held += b - a + 1
                if held >= segment:
                    yield close()
                    number, ids, names, lengths, held = number + 1, [], [], [], 0
        if names:
            yield close()

    head = F.substring("text", 1, 64)  # spreads null and repeated ids, in the same order as whole texts
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id", head).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, SCHEMA).write.option("compression", "none").parquet(path)


def index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index: a row per segment with ``start``, the ids of all segments before it."""
    rows = spark.read.parquet(path).select("shard", "segment", "n_tokens", "planes", "chunk_ids", "chunk_bytes", "plane_bytes")
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("shard_tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    shards = shards.select("shard", F.coalesce(F.sum("shard_tokens").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return rows.join(shards, "shard").withColumn("start", F.col("start") + F.col("shard_start")).drop("shard_start")


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, their ids."""
    kinds = "shard int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                ids = unpack(row)
                sizes = np.array(row["doc_tokens"], np.int64)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                parts = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                n = len(parts)
                out = {
                    "shard": pa.array([row["shard"]] * n, pa.int32()),
                    "segment": pa.array([row["segment"]] * n, pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "at": pa.array(bounds[:-1]),
                    "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([x.astype(np.int64) for x in parts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    docs = spark.read.parquet(path).mapInArrow(decode, kinds)
    starts = index(spark, path).select("shard", "segment", F.col("start").alias("segment_start"))
    columns = ["doc_id", (F.col("segment_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"]
    return docs.join(starts, ["shard", "segment"]).select(*columns, *["ids"] * with_ids)


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Ids first to last of the whole dataset as rows (position, id); reads the segments that hold them."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = max(first - row["start"], 0), min(last - row["start"], row["n_tokens"])
                ids = unpack(row, a, b)
                yield pa.RecordBatch.from_pydict({"position": pa.array(np.arange(row["start"] + a, row["start"] + b)), "id": pa.array(ids.astype(np.int64))})

    keys = index(spark, path).select("shard", "segment", "start").filter((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    return spark.read.parquet(path).join(keys, ["shard", "segment"]).mapInArrow(decode, "position long, id long")
