"""Exact distinct counts over increments, without a second look at what came before.

Values get numbers from a dictionary that only grows: a hash deals values into ``buckets``, each of which
numbers its own from where it stopped, so numbers are dense without a total order and no task has all values.
A group's state is a set of bitmaps over these numbers, 32,768 to a bitmap. Bitmaps merge by OR, which Spark does before
the shuffle too, so an increment costs its own rows, the dictionary's and the states' size; history is not read again.

Null values don't count. A bitmap takes 4 kB in memory, so this is for groups with many values;
groups with a few values each (users and their channels) cost 4 kB a group in each task that meets them, and compress to
little when stored. Increments are numbered; one that died is repeated under its number and replaces what was left.
Values can only be added: a table whose rows change needs signed counts per value instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .files import Versions, children, exists
from .joins import join_on


class DistinctCounts:
    """Distinct ``value`` per ``groups``, as states below ``path``."""

    def __init__(self, spark: SparkSession, path: str, groups: list[str], value: str, buckets: int = 64):
        self.spark, self.path, self.groups, self.value, self.buckets = spark, path, groups, value, buckets
        self.states = Versions(spark, f"{path}/states")

    def _dictionary(self, before: int) -> DataFrame:
        """value, bucket, number of all increments before this one."""
        folder = f"{self.path}/dictionary"
        paths = [f"{folder}/{n}" for n in children(self.spark, folder) if int(n[10:]) < before and exists(self.spark, f"{folder}/{n}/_SUCCESS")]
        shape = f"value {self.kind}, bucket int, place long"
        return self.spark.read.schema(shape).parquet(*paths) if paths else self.spark.createDataFrame([], shape)

    def add(self, rows: DataFrame) -> int:
        """Count an increment's rows in; returns its number. The states of its number make it count."""
        self.kind = rows.schema[self.value].dataType.simpleString()
        known = self.states.newest()
        number = 1 if known is None else known + 1
        rows = rows.select(*self.groups, F.col(self.value).alias("value"))
        dictionary = self._dictionary(number)
        fresh = join_on(rows.where("value IS NOT NULL").select("value").distinct(), dictionary.select("value"), ["value"], "left_anti")
        fresh = fresh.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(self.buckets)).cast("int"))
        taken = dictionary.groupBy("bucket").agg(F.max("place").alias("taken"))  # a row per bucket
        order = F.row_number().over(W.partitionBy("bucket").orderBy("value"))
        placed = fresh.withColumn("_n", order).join(taken, "bucket", "left")
        placed = placed.select("value", "bucket", (F.coalesce("taken", F.lit(0)) + F.col("_n")).cast("long").alias("place"))
        placed.write.mode("overwrite").parquet(f"{self.path}/dictionary/increment={number:012d}")

        numbers = self._dictionary(number + 1).select("value", (F.col("place") * self.buckets + F.col("bucket")).alias("_number"))
        held = join_on(rows.distinct(), numbers, ["value"], "left")  # a null value has no number; its group stays
        at = F.coalesce(F.bitmap_bucket_number("_number"), F.lit(0))
        bits = F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits")
        states = held.groupBy(*self.groups, at.alias("part")).agg(bits)
        if known is not None:
            states = self.spark.read.parquet(self.states.path(known)).unionByName(states)
        merged = states.groupBy(*self.groups, "part").agg(F.bitmap_or_agg("bits").alias("bits"))
        self.states.write(merged, number)
        return number

    def counts(self, name: str = "distinct_values") -> DataFrame:
        """Groups and their number of distinct values."""
        newest = self.states.newest()
        if newest is None:
            raise ValueError("nothing has been counted yet")
        state = self.spark.read.parquet(self.states.path(newest))
        return state.groupBy(*self.groups).agg(F.sum(F.bitmap_count("bits")).alias(name))
