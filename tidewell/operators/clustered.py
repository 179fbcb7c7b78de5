"""Messages laid out by channel and time at once, with a map that says which files a read needs.

Rows are ordered along a space-filling curve over two coordinates: the slot of the channel's hash, and the
number of the time's range among ranges that hold equally many rows. Bits of both alternate, so a file holds
few channels for a short time, and a read of one channel for a day, of one channel, or of one day opens few files.
Files are cut by a range sort over curve, channel and time, so a channel that holds a third of the rows is
split by time. Within a file rows are sorted by channel and time, and Parquet keeps Bloom filters on the channel::

    data/<layer>/part-*.parquet     the rows of an append or of a compaction
    zones/<layer>/                  per file and slot: earliest and latest time, and rows
    log/add-<layer>.json            the append counts
    log/compact-<k>.json            a layer that counts, and those it replaces

Data and zones are written first, a note in the log makes them count, and notes are never replaced: an append
that dies leaves nothing that is read, and of two compactions at once the second fails and changes nothing. ``vacuum`` removes
what was replaced; run it when no read of older layers is under way and no write is.

Rows without a channel have a slot like any other; a read by channel does not give them. Rows without
a readable time come first on the curve; a read with a time bound does not give them. Bounds are inclusive. Repeated
rows are kept. An append of no rows changes nothing.
"""

from __future__ import annotations

import json
import math
import secrets
import time
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import EPOCH_TYPE, epoch
from .files import children, delete, read_text, write_new

#: Bits of each coordinate.
BITS = 8
SLOTS = RANGES = 1 << BITS
ZONES = "layer string, file string, slot int, earliest decimal(28,9), latest decimal(28,9), rows long"


def slot(channel: Column) -> Column:
    return F.pmod(F.xxhash64(channel), F.lit(SLOTS)).cast("int")


def curve(a: Column, b: Column) -> Column:
    """The bits of two coordinates in turn."""
    bit = lambda x, k, at: F.shiftleft(F.shiftright(x, k).bitwiseAND(F.lit(1)), at)
    place = F.lit(0)
    for k in range(BITS):
        place = place.bitwiseOR(bit(a, k, 2 * k)).bitwiseOR(bit(b, k, 2 * k + 1))
    return place


class ClusteredTable:
    """A table by channel and time below ``path``; ``at`` names a column of epoch-second text."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, channel: str = "channel_id", at: str = "ts", rows_per_file: int = 1_000_000):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.channel, self.at, self.rows_per_file = channel, at, rows_per_file

    def _log(self) -> tuple[set[str], set[str], int]:
        """Layers that count, layers that were replaced, and the number of compactions."""
        names = children(self.spark, f"{self.path}/log")
        added = {n.removeprefix("add-").removesuffix(".json") for n in names if n.startswith("add-")}
        notes = [json.loads(read_text(self.spark, f"{self.path}/log/{n}")) for n in names if n.startswith("compact-")]
        gone = {layer for note in notes for layer in note["replaces"]}
        return (added | {note["layer"] for note in notes}) - gone, gone, len(notes)

    def _write(self, rows: DataFrame) -> str | None:
        """A new layer that does not count yet; None without rows."""
        when = epoch(F.col(self.at)).cast("double")
        shares = [k / RANGES for k in range(1, RANGES)]
        n, cuts = rows.agg(F.count("*"), F.percentile_approx(when, shares, 10_000)).first()  # 255 numbers
        if not n:
            return None
        layer = f"{time.time_ns():020d}-{secrets.token_hex(4)}"
        ranged = rows.select(F.struct(*[F.col(c) for c in self.schema.names]).alias("row"), when.alias("when"))
        splits = [-math.inf, *sorted({*(cuts or ()), 0.0}), math.inf]
        ranged = Bucketizer(splits=splits, inputCol="when", outputCol="range", handleInvalid="keep").transform(ranged)
        known = F.when(F.col("when").isNull(), F.lit(0)).otherwise(F.least(F.col("range").cast("int"), F.lit(RANGES - 1)))
        channel = F.col(f"row.{self.channel}")
        placed = ranged.withColumn("place", curve(slot(channel), known))
        files = math.ceil(n / self.rows_per_file)
        spread = placed.repartitionByRange(files, "place", channel, "when").select("row.*")
        ordered = spread.sortWithinPartitions(self.channel, epoch(F.col(self.at)))
        writer = ordered.write.option(f"parquet.bloom.filter.enabled#{self.channel}", "true")
        writer.option(f"parquet.bloom.filter.expected.ndv#{self.channel}", "10000").parquet(f"{self.path}/data/{layer}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{layer}")
        number = epoch(F.col(self.at))
        zones = written.groupBy(F.col("_metadata.file_name").alias("file"), slot(F.col(self.channel)).alias("slot"))
        zones = zones.agg(F.min(number).alias("earliest"), F.max(number).alias("latest"), F.count("*").alias("rows"))
        zones.hint("rebalance", "slot").sortWithinPartitions("slot").write.parquet(f"{self.path}/zones/{layer}")
        return layer

    def append(self, rows: DataFrame) -> str | None:
        """Add rows as a layer, and return its name."""
        layer = self._write(rows)
        if layer is not None:
            write_new(self.spark, f"{self.path}/log/add-{layer}.json", "{}")
        return layer

    def compact(self) -> str | None:
        """Order all layers as one; another compaction meanwhile is a FileExistsError, appends are left beside it."""
        layers, _, k = self._log()
        if len(layers) < 2:
            return None
        layer = self._write(self._read([f"{self.path}/data/{x}" for x in sorted(layers)]))
        write_new(self.spark, f"{self.path}/log/compact-{k + 1:08d}.json", json.dumps({"layer": layer, "replaces": sorted(layers)}))
        return layer

    def vacuum(self) -> list[str]:
        """Remove layers that were replaced or never came to count."""
        live, _, _ = self._log()
        dead = sorted(set(children(self.spark, f"{self.path}/data")) - live)
        for layer in dead:
            for name in (f"data/{layer}", f"zones/{layer}"):
                delete(self.spark, f"{self.path}/{name}")
        return dead

    def zones(self) -> DataFrame:
        """layer, file, slot, earliest, latest and rows of what counts."""
        found = self.spark.createDataFrame([], ZONES)
        layers = sorted(self._log()[0])
        if not layers:
            return found
        read = self.spark.read.schema("file string, slot int, earliest decimal(28,9), latest decimal(28,9), rows long")
        zones = read.parquet(*[f"{self.path}/zones/{x}" for x in layers])
        parts = F.split(F.col("_metadata.file_path"), "/")
        return zones.select(F.element_at(parts, -2).alias("layer"), "file", "slot", "earliest", "latest", "rows")

    def files(self, channel: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
        """layer and file of every file that a read with these bounds may need."""
        zones = self.zones()
        if channel is not None:
            zones = zones.where(F.col("slot") == slot(F.lit(channel)))
        if since is not None:
            zones = zones.where(F.col("latest") >= F.lit(since).cast(EPOCH_TYPE))
        if until is not None:
            zones = zones.where(F.col("earliest") <= F.lit(until).cast(EPOCH_TYPE))
        return zones.select("layer", "file").distinct()

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, channel: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
        """The rows of a channel and of a time, bounds included; all of them without bounds."""
        if channel is None and since is None and until is None:
            return self._read([f"{self.path}/data/{x}" for x in sorted(self._log()[0])])
        names: list[Any] = self.files(channel, since, until).collect()  # names of the files to open
        rows = self._read([f"{self.path}/data/{r['layer']}/{r['file']}" for r in names])
        if channel is not None:
            rows = rows.where(F.col(self.channel) == channel)
        number = epoch(F.col(self.at))
        if since is not None:
            rows = rows.where(number >= F.lit(since).cast(EPOCH_TYPE))
        if until is not None:
            rows = rows.where(number <= F.lit(until).cast(EPOCH_TYPE))
        return rows
