"""Ingestion state and run state as Parquet logs; the newest row per key counts.

Nothing is updated in place, so a job that dies while saving leaves the earlier state
readable, and saving never rewrites a path that the same plan reads.

A save is a folder. Each time ``CHECKPOINT`` saves have come together, a checkpoint takes in the one before it and
all saves there are, and reads begin with the newest checkpoint that is whole. A save may be in both: it is the
same row twice, of which the newest per key counts once. Saves go when the checkpoint after the one that took them in
is there, so a read that listed them still finds them, and a job that dies at any point loses nothing. However old a
log is, a read opens one checkpoint and some ``2 * CHECKPOINT`` saves at most, and what concurrent jobs add meanwhile.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import children, delete, exists, read_text, write_new
from .incremental import latest_per_key

STATE_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("resource", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("completed", T.BooleanType()),
        T.StructField("saved_at", T.TimestampType()),
        T.StructField("version", T.LongType()),
        T.StructField("cleared", T.BooleanType()),
    ]
)
RUN_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("version", T.LongType()),
    ]
)
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("resource", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("started_at", T.DoubleType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)

#: Saves that a checkpoint is written after.
CHECKPOINT = 16
#: Name of a checkpoint, which is a save of many.
TAKEN = "save=checkpoint-"
_logger = logging.getLogger(__name__)

# The run states.
RUNNING, PAUSED, STOPPED, COMPLETED, FAILED = "running", "paused", "stopped", "completed", "failed"


def current_state(log: DataFrame) -> DataFrame:
    """Newest row of every (pipeline, resource) that has not been cleared since."""
    return latest_per_key(log, ["pipeline", "resource"], ["version"]).where(~F.col("cleared"))


def current_runs(log: DataFrame) -> DataFrame:
    return latest_per_key(log, ["pipeline", "mode"], ["version"])


def _now() -> tuple[datetime, int]:
    ns = time.time_ns()
    return datetime.fromtimestamp(ns / 1e9, tz=timezone.utc), ns


class _Log:
    """A Parquet folder of saves and checkpoints, by pipeline."""

    schema: T.StructType

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _kept(self, rows: DataFrame) -> DataFrame:
        """What a checkpoint keeps of all rows."""
        raise NotImplementedError

    def _listed(self) -> tuple[str | None, list[str]]:
        """The newest checkpoint that is whole, and the saves that are."""
        names = children(self.spark, self.path)
        whole = [n for n in names if n.startswith("save=") and exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return max((n for n in whole if n.startswith(TAKEN)), default=None), [n for n in whole if not n.startswith(TAKEN)]

    def log(self) -> DataFrame:
        """All rows that may count; none before the first is written."""
        checkpoint, saves = self._listed()
        return self._read([*([checkpoint] if checkpoint else []), *saves])

    def _read(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        read = self.spark.read.schema(self.schema).option("basePath", self.path)
        return read.parquet(*[f"{self.path}/{n}" for n in names]).select(self.schema.names)

    def _append(self, rows: DataFrame) -> None:
        # A folder for each save: two jobs that append to one folder at the same time clear away
        # each other's temporary files.
        folder = f"{self.path}/save={uuid.uuid4().hex}"
        rows.select(self.schema.names).write.partitionBy("pipeline").parquet(folder)
        try:
            self._compact()
        except Exception as e:  # the save is done; another job may have been at the same checkpoint
            _logger.warning("checkpoint of %s left to a later save: %s", self.path, e)

    def _compact(self) -> None:
        """Write a checkpoint if enough saves have come since the last one."""
        last, saves = self._listed()
        taken = set(self._covered(last))
        if len(set(saves) - taken) < CHECKPOINT:
            return
        name = f"{TAKEN}{time.time_ns():020d}"
        kept = self._kept(self._read([*([last] if last else []), *saves]))
        kept.hint("rebalance", "pipeline").write.partitionBy("pipeline").parquet(f"{self.path}/{name}")
        write_new(self.spark, f"{self.path}/{name}/_covered", json.dumps(saves))
        for old in children(self.spark, self.path):
            if old in taken or (old.startswith(TAKEN) and last and old < last):
                delete(self.spark, f"{self.path}/{old}")

    def _covered(self, checkpoint: str | None) -> list[str]:
        """Saves that a checkpoint took in, as far as it came to say so."""
        note = f"{self.path}/{checkpoint}/_covered"
        return json.loads(read_text(self.spark, note)) if checkpoint and exists(self.spark, note) else []

    def _append_row(self, **values: Any) -> None:
        row = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        self._append(self.spark.range(0, 1, 1, 1).select(*row))

    def _newest(self, key: Column) -> Row | None:
        return self.log().where(key).orderBy(F.col("version").desc()).first()


class IngestState(_Log):
    """Checkpoint of every (pipeline, resource): a JSON object, the newest one valid."""

    schema = STATE_SCHEMA

    def _kept(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, ["pipeline", "resource"], ["version"])  # what is cleared stays known as cleared

    def save(self, pipeline: str, resource: str, state: dict[str, Any]) -> None:
        at, version = _now()
        self._append_row(
            pipeline=pipeline, resource=resource, state=json.dumps(state), completed=bool(state.get("completed")),
            saved_at=at, version=version, cleared=False,
        )

    def save_all(self, rows: DataFrame) -> None:
        """Save a frame of ``pipeline, resource, state`` (JSON text), e.g. one row per channel."""
        at, version = _now()
        done = F.coalesce(F.get_json_object("state", "$.completed").cast("boolean"), F.lit(False))
        self._append(
            rows.select(
                "pipeline", "resource", "state", done.alias("completed"),
                F.lit(at).alias("saved_at"), F.lit(version).alias("version"), F.lit(False).alias("cleared"),
            )
        )

    def clear(self, pipeline: str, resource: str | None = None) -> None:
        """Forget one resource, or all of a pipeline for a full reload."""
        at, version = _now()
        gone = self.current(pipeline)
        if resource is not None:
            gone = gone.where(F.col("resource") == resource)
        self._append(
            gone.withColumns({"cleared": F.lit(True), "saved_at": F.lit(at), "version": F.lit(version)})
        )

    def current(self, pipeline: str | None = None) -> DataFrame:
        log = self.log()
        return current_state(log if pipeline is None else log.where(F.col("pipeline") == pipeline))

    def load(self, pipeline: str, resource: str) -> dict[str, Any] | None:
        row = self._newest((F.col("pipeline") == pipeline) & (F.col("resource") == resource))
        return None if row is None or row["cleared"] else json.loads(row["state"])

    def load_some(self, pipeline: str, *resources: str) -> dict[str, dict[str, Any]]:
        """States of a few resources in one read; those without one are left out."""
        rows = self.current(pipeline).where(F.col("resource").isin(*resources)).collect()  # a row per resource
        return {row["resource"]: json.loads(row["state"]) for row in rows}


class RunLog(_Log):
    """Run state of every (pipeline, mode); a pipeline that never ran is stopped."""

    schema = RUN_SCHEMA

    def _kept(self, rows: DataFrame) -> DataFrame:
        return current_runs(rows)

    def set(self, pipeline: str, state: str, mode: str = "batch", metadata: dict | None = None) -> None:
        if state not in (RUNNING, PAUSED, STOPPED, COMPLETED, FAILED):
            raise ValueError(f"unknown run state {state!r}")
        at, version = _now()
        self._append_row(
            pipeline=pipeline, mode=mode, state=state, metadata=json.dumps(metadata or {}), updated_at=at, version=version
        )

    def get(self, pipeline: str, mode: str = "batch") -> str:
        row = self._newest((F.col("pipeline") == pipeline) & (F.col("mode") == mode))
        return STOPPED if row is None else row["state"]

    def all(self) -> DataFrame:
        return current_runs(self.log())


class Reports(_Log):
    """What every load did, one row each; the newest per resource tells where things stand.

    Checkpoints keep every report.
    """

    schema = REPORT_SCHEMA

    def _kept(self, rows: DataFrame) -> DataFrame:
        return rows.distinct()

    def log(self) -> DataFrame:
        return super().log().distinct()

    def add(self, rows: DataFrame) -> None:
        self._append(rows)

    def newest(self, pipeline: str) -> DataFrame:
        return latest_per_key(self.log().where(F.col("pipeline") == pipeline), ["resource"], ["started_at"])
