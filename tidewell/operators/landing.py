"""Parquet sinks. All but the plain append can be run again without repeating rows."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..model.specs import TableSpec
from .coerce import coerce

CODECS = ("snappy", "gzip", "zstd", "none")


def _codec(name: str) -> str:
    if name not in CODECS:
        raise ValueError(f"codec {name!r} is not one of {CODECS}")
    return name


def write_parquet(rows: DataFrame, path: str, codec: str = "snappy") -> int:
    """Replace ``path`` with ``rows`` and return their number.

    No rows is an error that leaves ``path`` as it was: the first row is looked for before.
    """
    if rows.isEmpty():
        raise ValueError("cannot write a Parquet dataset without rows")
    return _measured_write(rows, path, codec, "overwrite")["rows"]


def land(
    rows: DataFrame,
    path: str,
    partitions: list[str],
    sort_by: list[str] | None = None,
    codec: str = "snappy",
    measures: dict[str, Column] | None = None,
    shuffle: bool = True,
) -> dict[str, Any]:
    """Replace exactly the partitions that ``rows`` touches.

    Returns the number of ``rows`` and the given aggregate ``measures`` of them.

    Rows are rebalanced by partition before the write: Spark splits a partition that is too
    large for one file and gathers small ones, so a day that holds most rows is written by
    many tasks and a small day by one. Rows that all go to one partition need no shuffle.
    """
    spread = rows.hint("rebalance", *partitions) if shuffle else rows
    ordered = spread.sortWithinPartitions(*partitions, *(sort_by or []))
    return _measured_write(ordered, path, codec, "overwrite", partitions, measures)


def replace(
    rows: DataFrame, path: str, codec: str = "snappy", sort_by: list[str] | None = None, shuffle: bool = True
) -> int:
    """Replace a reference dataset as a whole."""
    spread = rows.hint("rebalance", *(sort_by or [])) if shuffle else rows
    ordered = spread.sortWithinPartitions(*sort_by) if sort_by else spread
    return _measured_write(ordered, path, codec, "overwrite")["rows"]


def land_folder(
    rows: DataFrame, folder: str, partitions: list[str], sort_by: list[str], measures: dict[str, Column] | None = None
) -> dict[str, Any]:
    """Replace a load's folder as a whole, with sub-folders by ``partitions``.

    Whatever an attempt that died left there goes, also on another day. Rows are written where
    they were read.
    """
    ordered = rows.sortWithinPartitions(*partitions, *sort_by)
    return _measured_write(ordered, folder, "snappy", "overwrite", partitions, measures, whole=True)


def append_bronze(rows: DataFrame, path: str, spec: TableSpec, codec: str = "snappy") -> int:
    """Append rows to a bronze dataset in the declared shape, sorted by its key."""
    fitted = coerce(rows, spec).hint("rebalance", spec.key).sortWithinPartitions(spec.key)
    return _measured_write(fitted, path, codec, "append")["rows"]


def _measured_write(
    rows: DataFrame,
    path: str,
    codec: str,
    mode: str,
    partitions: list[str] | None = None,
    measures: dict[str, Column] | None = None,
    whole: bool = False,
) -> dict[str, Any]:
    # Measured in the writing stage itself: a retried task counts once, and the input is
    # not read a second time.
    seen = Observation()
    wanted = [m.alias(name) for name, m in (measures or {}).items()]
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *wanted).write.mode(mode)
    writer = writer.option("compression", _codec(codec))
    writer = writer.option("partitionOverwriteMode", "dynamic" if partitions and not whole else "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)
    return dict(seen.get)
