"""Incremental loading: high-water marks, completed work, and one row per key."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_key, epoch_text, first_filled, is_blank
from .joins import join_on

_UNORDERED = (T.MapType, T.VariantType)


def _keyless(rows: DataFrame, keys: list[str]) -> Column | None:
    """Whether a row lacks part of its key; None when the schema rules that out."""
    tests = []
    for field in (rows.schema[k] for k in keys):
        if isinstance(field.dataType, T.StringType):
            tests.append(is_blank(F.col(field.name)))
        elif field.nullable:
            tests.append(F.col(field.name).isNull())
    return reduce(or_, tests) if tests else None


def latest_per_key(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the highest version of every key.

    Versions compare left to right, null lowest; equal versions are settled by the other
    columns, so a rerun gives the same rows. Rows whose key is null or empty cannot be
    matched with others; all of them are kept: each is a group of its own, so the input is
    read once and they spread over all tasks.

    Spark keeps one row per key on the map side before the shuffle, so a key that holds a
    large share of all rows sends one row per task.
    """
    rest = [
        f.name for f in rows.schema.fields
        if f.name not in keys and f.name not in version and not isinstance(f.dataType, _UNORDERED)
    ]
    keyless = _keyless(rows, keys)
    groups = keys
    if keyless is not None:
        own = F.when(keyless, F.monotonically_increasing_id())
        rows, groups = rows.withColumn("_own", own), [*keys, "_own"]
    window = W.partitionBy(*groups).orderBy(*[F.col(f"`{c}`").desc_nulls_last() for c in [*version, *rest]])
    return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank", "_own")


def skip_completed(work: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has no completed state row."""
    done = state.where(F.col("completed")).select(*keys)
    return join_on(work, done, keys, "left_anti").select(work.columns)


def high_water_marks(rows: DataFrame, key: str, ts: str, mark: str = "mark") -> DataFrame:
    """Highest epoch text per key, compared as a number."""
    return rows.groupBy(key).agg(epoch_text(F.max(epoch_key(F.col(ts)))).alias(mark))


def newer_than(rows: DataFrame, marks: DataFrame, key: str, stamp: Column, mark: Column) -> DataFrame:
    """Rows above their key's mark, all rows of keys without one, and rows without a stamp.

    ``stamp`` is an expression over ``rows``, ``mark`` one over ``marks``. The comparison is
    strict: the row the mark was taken from is already loaded. Nothing shows that a row without
    a readable stamp is old.
    """
    bounds = marks.select(F.col(key), mark.alias("_mark"))
    above = F.col("_mark").isNull() | F.col("_stamp").isNull() | (F.col("_stamp") > F.col("_mark"))
    return join_on(rows.withColumn("_stamp", stamp), bounds, [key], "left").where(above).select(rows.columns)


def modified_since(
    rows: DataFrame, modified: tuple[str, ...], mark: str | None, inclusive: bool = False
) -> DataFrame:
    """Rows changed after ``mark`` (or at it), by the first filled modification column.

    Rows with none of them filled are kept: nothing shows that they are old.
    """
    if mark is None or not modified:
        return rows
    changed = first_filled(*[F.col(m) for m in modified])
    newer = changed >= mark if inclusive else changed > mark
    return rows.where(changed.isNull() | newer)
