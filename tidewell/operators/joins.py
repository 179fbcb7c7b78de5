"""The one equi-join of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys``, so that Spark can split a key that holds a large part of the rows.

    Spark splits a skewed partition only where both sides are shuffled for the join itself.
    A side that was grouped by the same keys is not, and would send all rows of a hot key to
    one task. The hash in the join keys makes Spark shuffle it, which costs little: it is
    the side already reduced to its keys. Sides below Spark's size limit are broadcast as
    for any join.
    """
    mark = F.xxhash64(*[F.col(k) for k in keys])
    return left.withColumn("_key", mark).join(right.withColumn("_key", mark), [*keys, "_key"], how).drop("_key")
