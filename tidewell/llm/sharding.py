"""Shards from a Feistel permutation of row numbers; DataFrame functions only.

Rows get gapless global numbers in the order of ``doc_id`` (null first; repeated rows by size
and checksum, which makes them interchangeable). A four-round Feistel network permutes the
numbers: it works on pairs (left, right) of the mixed radix a x b, where a = ceil(sqrt(n)) and
b = ceil(n / a), so fewer than a numbers of its domain lie beyond n. Those are walked: the
network is applied again until the number is below n. How often that can take is measured
before, exactly, over the few numbers beyond n. Position p then goes to shard ``p mod k``,
slot ``p div k``: counts differ by one at most, slots have no gaps, and shard and slot of a row
number can be computed without any table.

A null text counts as no bytes. An empty table gives no rows. Columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import scratch

ROUNDS = 4


def sides(n: int) -> tuple[int, int]:
    """The smallest mixed radix (a, b) near the square root of n with a * b >= n."""
    a = max(1, isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def feistel(df: DataFrame, name: str, n: int, seed: int) -> DataFrame:
    """One application of the network to column ``name``, a number below a * b."""
    a, b = sides(n)
    df = df.withColumn("_l", F.col(name).cast("long") % a).withColumn("_r", F.expr(f"CAST({name} AS BIGINT) div {a}"))
    for i in range(ROUNDS):
        side, other, radix = ("_l", "_r", a) if i % 2 == 0 else ("_r", "_l", b)
        moved = F.pmod(F.xxhash64(F.lit(seed), F.lit(i), F.col(other)), F.lit(radix))
        df = df.withColumn(side, (F.col(side) + moved) % radix)
    return df.withColumn(name, F.col("_l") + F.col("_r") * a).drop("_l", "_r")


def walks(df: DataFrame, n: int, seed: int) -> int:
    """How many further applications bring every number of the domain below n."""
    a, b = sides(n)
    left, steps = df.sparkSession.range(n, a * b).select(F.col("id").alias("_p")), 0
    while left.limit(1).count():
        left = feistel(left, "_p", n, seed).filter(F.col("_p") >= n)
        steps += 1
    return steps


def permute(df: DataFrame, name: str, n: int, seed: int) -> DataFrame:
    """Column ``name``, the numbers 0 to n-1, permuted; every other column stays."""
    if n < 2:
        return df
    df = feistel(df, name, n, seed)
    for _ in range(walks(df, n, seed)):
        again = feistel(df.withColumn("_w", F.col(name)), "_w", n, seed)
        df = again.withColumn(name, F.when(F.col(name) < n, F.col(name)).otherwise(F.col("_w"))).drop("_w")
    return df


def row_numbers(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Gapless global row numbers in this order, and how many rows there are.

    The sorted rows are written once, so that numbers and counts come from the same partitions;
    then the number within a partition is added to the rows of all partitions before.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, "row-numbers")
    df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_p", F.shiftright("_m", 33))
    counts = rows.groupBy("_p").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    numbered = rows.join(starts, "_p").withColumn(name, F.col("_s") + F.col("_m").bitwiseAND((1 << 33) - 1))
    return numbered.drop("_p", "_m", "_s"), rows.count()


def shard(docs: DataFrame, shards: int = 16, seed: int = 1) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard and slot of every document."""
    octets = F.coalesce(F.encode(F.col("text"), "UTF-8"), F.lit(b""))
    light = docs.select(F.col("doc_id").cast("long"), (F.octet_length(octets).cast("long") + 1).alias("size"), F.crc32(octets).alias("text_crc32"))
    numbered, n = row_numbers(light, ["doc_id", "size", "text_crc32"], "row_number")
    placed = permute(numbered.withColumn("_pos", F.col("row_number")), "_pos", n, seed)
    return placed.select("doc_id", "size", "text_crc32", "row_number", (F.col("_pos") % shards).cast("int").alias("shard"), F.expr(f"_pos div {shards}").alias("slot"))
