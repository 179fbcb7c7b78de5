"""A table of one row per key in hash buckets, with a log of deltas and a manifest.

A load is appended as a delta: its newest row per key, by bucket. ``merge`` takes the pending deltas
in and rewrites the buckets they touch, and no others, as a new *generation*::

    delta/gen=<g>/bucket=<b>/            a load that is not merged yet
    base/gen=<g>/bucket=<b>/kind=<k>/    a bucket as of a generation
    manifest/<v>.json                    which generation each bucket is at, and what is pending

Kind ``same`` are rows as before, ``new`` those that the deltas brought, ``old`` the rows they replaced, which
are no part of the table: ``changes`` gives the last two with their sign, for views that are maintained.

Data is written first; a manifest that names it makes it count. Manifests are never
replaced, so of two writers at once the second fails and changes nothing. What no manifest needs, such as what a
writer that died left, goes with ``vacuum``.

A read of merged buckets is a scan: no shuffle, pruned to one bucket for a given key, and files are sorted by
key, so a range of keys skips pages of them. Only buckets with pending deltas are compared with these. Rows
without a key are all kept, spread over the buckets by their other columns.

A merge shuffles the touched buckets and the deltas once, by bucket and, where a bucket has many rows or bytes, by slices of its
keys: a task sorts a few slices at most, so its memory does not grow with the table, and a bucket has a file per slice and kind.
Rows are counted before, from the files' footers. ``buckets`` says how little a merge of few keys rewrites. A
key that fills a load sends one row per task, as loads are reduced to one row per key first.
"""

from __future__ import annotations

import json
import secrets
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import children, delete, read_text, write_new
from .incremental import _keyless, latest_per_key

SAME, NEW, OLD = "same", "new", "old"
#: What a slice of a bucket holds; a task gets some slices.
SLICE_ROWS, SLICE_BYTES = 100_000, 16 << 20
#: Generations that attempts at one manifest may choose from.
TRIES = 1_000_000


@dataclass
class Manifest:
    """What counts: bucket -> generation, pending deltas (generation, buckets), merges whose changes can be read."""

    version: int = 0
    buckets: int = 0
    base: dict[int, int] = field(default_factory=dict)
    pending: list[tuple[int, list[int]]] = field(default_factory=list)
    merges: list[int] = field(default_factory=list)
    cut: bool = False  # whether earlier merges were vacuumed
    tag: int = -1  # of the last load that had one

    @property
    def dirty(self) -> set[int]:
        return {b for _, touched in self.pending for b in touched}

    def text(self) -> str:
        return json.dumps({"buckets": self.buckets, "base": self.base, "pending": self.pending, "merges": self.merges, "cut": self.cut, "tag": self.tag})

    @staticmethod
    def parse(version: int, text: str) -> Manifest:
        read = json.loads(text)
        pending = [(g, touched) for g, touched in read["pending"]]
        return Manifest(version, read["buckets"], {int(b): g for b, g in read["base"].items()}, pending, read["merges"], read["cut"], read["tag"])


class MergeTable:
    """See the module. Without ``version`` columns the later load of a key wins, with them the higher version."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 64, version: list[str] | None = None):
        self.spark, self.path, self.schema, self.keys, self.version = spark, path, schema, keys, version or []
        self.buckets = self.manifest().buckets or buckets

    def manifest(self) -> Manifest:
        folder = f"{self.path}/manifest"
        names = [n for n in children(self.spark, folder) if n.endswith(".json") and not n.startswith(".")]
        return Manifest.parse(int(names[-1][:-5]), read_text(self.spark, f"{folder}/{names[-1]}")) if names else Manifest()

    def _commit(self, now: Manifest) -> None:
        now.version, now.buckets = now.version + 1, self.buckets
        write_new(self.spark, f"{self.path}/manifest/{now.version:012d}.json", now.text())

    @staticmethod
    def _generation(now: Manifest) -> int:
        """Above all that the manifest names, and no other's."""
        return (now.version + 1) * TRIES + secrets.randbelow(TRIES)

    def _bucket(self, rows: DataFrame) -> Column:
        """By key; rows without one by all that can be hashed."""
        by_key = F.xxhash64(*[F.col(f"`{k}`") for k in self.keys])
        keyless = _keyless(rows.select(self.schema.names), self.keys)
        if keyless is not None:
            plain = [F.col(f"`{f.name}`") for f in self.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
            by_key = F.when(keyless, F.xxhash64(*plain)).otherwise(by_key)
        return F.pmod(by_key, F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame, tag: int | None = None) -> list[int]:
        """Add a load to the deltas; returns the buckets it touches. A load with a tag not above the last one is known already."""
        now = self.manifest()
        if tag is not None and tag <= now.tag:
            return []
        gen = self._generation(now)
        newest = latest_per_key(rows.select(self.schema.names), self.keys, self.version)
        seen = Observation()
        dealt = newest.withColumn("bucket", self._bucket(newest)).hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.keys)
        # at most as many numbers as there are buckets
        dealt.observe(seen, F.collect_set("bucket").alias("touched")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/delta/gen={gen}")
        touched = sorted(seen.get["touched"])
        if touched or tag is not None:
            now.pending += [(gen, touched)] if touched else []
            now.tag = now.tag if tag is None else tag
            self._commit(now)
        return touched

    def _shape(self, *added: str) -> T.StructType:
        kinds = {"gen": T.LongType(), "bucket": T.IntegerType(), "kind": T.StringType(), "_sign": T.IntegerType()}
        return T.StructType([*self.schema.fields, *[T.StructField(name, kinds[name]) for name in added]])

    def _base(self, now: Manifest, buckets: list[int]) -> DataFrame:
        """Rows of these buckets as of their generations."""
        shape = self._shape("gen", "bucket", "kind")
        paths = [f"{self.path}/base/gen={now.base[b]}/bucket={b}" for b in buckets if b in now.base]
        if not paths:
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).option("basePath", f"{self.path}/base").parquet(*paths).where(F.col("kind") != OLD)

    def _delta(self, now: Manifest) -> DataFrame:
        shape = self._shape("gen", "bucket")
        paths = [f"{self.path}/delta/gen={gen}" for gen, _ in now.pending]
        return self.spark.read.schema(shape).option("basePath", f"{self.path}/delta").parquet(*paths)

    def _slices(self, parts: list[DataFrame]) -> int:
        """Into how many slices each bucket is cut, by the rows and bytes of the largest."""
        found = [p.select("bucket", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")) for p in parts if p.inputFiles()]
        if not found:
            return 1
        files = reduce(DataFrame.unionAll, found).groupBy("bucket", "file").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
        need = F.greatest(F.sum("rows") / SLICE_ROWS, F.sum("size") / SLICE_BYTES)
        most = files.groupBy("bucket").agg(F.ceil(need).alias("need")).agg(F.max("need")).first()[0]
        return max(1, most or 1)

    def _ranked(self, now: Manifest) -> DataFrame:
        """Rows of the dirty buckets and the deltas with their rank in their key; ``_from`` is 0 for the base."""
        base, delta = self._base(now, sorted(now.dirty)), self._delta(now)
        slices = self._slices([base, delta])
        rows = base.drop("gen", "kind").withColumn("_from", F.lit(0).cast("long")).unionByName(delta.withColumnRenamed("gen", "_from"))
        keyless = _keyless(rows, self.keys)
        own = F.lit(None).cast("long") if keyless is None else F.when(keyless, F.monotonically_increasing_id())
        order = [*[F.col(f"`{v}`").desc_nulls_last() for v in self.version], F.col("_from").desc()]
        rows = rows.withColumn("_own", own)
        # the bucket took the hash modulo the buckets; the slice needs another one
        at = F.pmod(F.xxhash64(F.lit(1), *[F.col(f"`{k}`") for k in self.keys], "_own"), F.lit(slices)).cast("int")
        window = W.partitionBy("bucket", "_slice", *self.keys, "_own").orderBy(*order)
        # one shuffle serves the window and the write; small buckets may share a task
        dealt = ["bucket", "_slice"] if slices == 1 else [slices * len(now.dirty), "bucket", "_slice"]
        return rows.withColumn("_slice", at).repartition(*dealt).withColumn("_rank", F.row_number().over(window)).drop("_own", "_slice")

    def merge(self) -> list[int]:
        """Take the pending deltas in; returns the buckets that were rewritten."""
        now = self.manifest()
        touched = sorted(now.dirty)
        if not touched:
            return []
        gen = self._generation(now)
        new = F.col("_from") > 0
        kind = F.when(F.col("_rank") == 1, F.when(new, NEW).otherwise(SAME)).when(~new, OLD)
        rows = self._ranked(now).withColumn("kind", kind).where(F.col("kind").isNotNull()).drop("_rank", "_from")
        rows = rows.sortWithinPartitions("bucket", "kind", *self.keys)
        rows.write.mode("overwrite").partitionBy("bucket", "kind").parquet(f"{self.path}/base/gen={gen}")
        now.base.update(dict.fromkeys(touched, gen))
        now.pending, now.merges = [], [*now.merges, gen]
        self._commit(now)
        return touched

    def upsert(self, rows: DataFrame, tag: int | None = None) -> list[int]:
        """Append a load and merge it."""
        self.append(rows, tag)
        return self.merge()

    def read(self) -> DataFrame:
        """The newest row of every key."""
        return self._read(None)

    def lookup(self, **key: object) -> DataFrame:
        """The row of one key; reads its bucket only."""
        values = [F.lit(key[k]).cast(self.schema[k].dataType) for k in self.keys]
        return self._read(values)

    def _read(self, values: list[Column] | None) -> DataFrame:
        now = self.manifest()
        clean = self._base(now, sorted(set(now.base) - now.dirty))
        parts = [clean.select("bucket", *self.schema.names)]
        if now.pending:
            parts.append(self._ranked(now).where(F.col("_rank") == 1).select("bucket", *self.schema.names))
        if values is not None:
            at = F.pmod(F.xxhash64(*values), F.lit(self.buckets)).cast("int")  # constant, so it prunes folders
            parts = [p.where(F.col("bucket") == at) for p in parts]
            for k, value in zip(self.keys, values):
                parts = [p.where(F.col(f"`{k}`") == value) for p in parts]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return rows.select(self.schema.names)

    def merged_through(self) -> int:
        """Generation of the last merge; 0 before the first."""
        return max(self.manifest().merges, default=0)

    def changes(self, after: int = 0) -> DataFrame | None:
        """Rows that merges after a generation brought (``_sign`` 1) and replaced (-1); None if some were vacuumed."""
        now = self.manifest()
        if after not in now.merges and (after or now.cut):
            return None
        shape = self._shape("gen", "bucket", "kind")
        paths = [f"{self.path}/base/gen={g}" for g in now.merges if g > after]
        if not paths:
            return self.spark.createDataFrame([], self._shape("_sign"))
        rows = self.spark.read.schema(shape).option("basePath", f"{self.path}/base").parquet(*paths).where(F.col("kind") != SAME)
        return rows.select(*self.schema.names, F.when(F.col("kind") == NEW, 1).otherwise(-1).alias("_sign"))

    def vacuum(self) -> None:
        """Drop manifests before the newest, generations it doesn't name, and with them the older changes."""
        now = self.manifest()
        last = max(now.merges, default=0)
        needed = set(now.base.values()) | ({last} if last else set())
        now.merges, now.cut = [last] if last else [], bool(last)
        self._commit(now)
        waiting = {g for g, _ in now.pending}
        for folder, kept in (("base", needed), ("delta", waiting)):
            for name in children(self.spark, f"{self.path}/{folder}"):
                # a merge at work has a number above the manifest's
                if name.startswith("gen=") and int(name[4:]) not in kept and int(name[4:]) < now.version * TRIES:
                    delete(self.spark, f"{self.path}/{folder}/{name}")
        for name in children(self.spark, f"{self.path}/manifest"):
            if name.endswith(".json") and int(name[:-5]) < now.version:
                delete(self.spark, f"{self.path}/manifest/{name}")
