"""Near-duplicate vectors by sorted projection passes.

In each pass a vector gets 64 sign bits of random projections, concatenated to one number, and all
vectors are ordered by it, so close vectors tend to lie near each other. Going through the order
in blocks of 256, each block is compared with itself and the one before by a matrix product, and
with the ones before that for as long as pairs are found: a dense cluster is compared as a whole.
Pairs with a cosine of at least the threshold, in double precision, are united over all passes.

The number of passes is first what vectors spread evenly would need: a pair exactly at the threshold
falls into a common window in at least one pass with a chance of ``RECALL`` or more. It grows as the
number of vectors to the power 0.22. Vectors that share a direction need more, so recall is measured:
up to ``PILOTS`` vectors, drawn by a hash of the id, are compared with all vectors, and each without
a link gets a made-up partner at the threshold that goes through the passes like a vector and is left
out of the result. While less than ``RECALL`` is found of the pilots' links, of each pilot's links on
average, or of the partners, passes are added; after ``MOST`` passes a warning gives the recall
reached. The order is dealt by
ranges; pairs across two tasks of one pass are left to the other passes, and are part of the measure.

Equal vectors are one class; only classes are compared, and counts of links include all copies.
Vectors that are null, empty, zero, or hold null or non-finite numbers link with nothing, and so do
vectors of different length with each other. A null id is kept and has no component. Repeated
rows count as copies. Other columns are not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.graph import components
from tidewell.session import scratch

BITS, WINDOW, RECALL = 64, 256, 0.995
#: Vectors whose links are counted, and numbers in them at most; passes in all, and added at once.
PILOTS, PILOT_NUMBERS = 2048, 1 << 20
MOST, ADDED = 512, 32


def passes(vectors: int, threshold: float) -> int:
    """Passes after which a pair at the threshold was in a common window with the chance RECALL, if keys spread evenly."""
    agree = 1 - acos(threshold) / pi
    chance = agree ** max(0.0, log2(max(vectors, 1) / WINDOW))
    return max(3, ceil(log(1 - RECALL) / log(max(1e-12, 1 - min(chance, 0.999)))))


def sign_keys(units: np.ndarray, number: int, seed: int = 7) -> np.ndarray:
    """Signs of 64 random projections, first bit highest, as a number that sorts like the bits."""
    planes = np.random.default_rng([seed, number, units.shape[1]]).standard_normal((units.shape[1], BITS))
    bits = np.packbits(units @ planes > 0, axis=1)
    return (bits.view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def _units(vectors: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one length, scaled to length one in double precision."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows(vectors: pa.Array) -> list[np.ndarray]:
    """The same for vectors of any lengths, each by itself."""
    lengths = np.array(vectors.value_lengths())
    if (lengths == lengths[0]).all():
        return list(_units(vectors, int(lengths[0])))
    return [_units(vectors.slice(k, 1), int(n))[0] for k, n in enumerate(lengths)]


def _keyed(classes: DataFrame, first: int, end: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                units = _units(part.column("embedding"), dim)
                for number in range(first, end):
                    keys = pa.array(sign_keys(units, number))
                    same = pa.array(np.full(len(units), number, np.int32))
                    yield pa.RecordBatch.from_arrays([part.column("dim"), same, keys, part.column("vec_id"), part.column("embedding")], names=["dim", "pass", "key", "vec_id", "embedding"])

    kind = classes.schema["embedding"].dataType.simpleString()
    return classes.select("dim", "vec_id", "embedding").mapInArrow(run, f"dim int, pass int, key long, vec_id long, embedding {kind}")


def _pairs(ordered: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between neighbours of each pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # blocks that a later one may still reach
        group, ids, rows = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            x, own = np.stack(rows), np.array(ids, np.int64)
            i, j = np.nonzero(np.triu(x @ x.T >= threshold, 1))
            found = [(own[i], own[j])]
            reach = 0
            for back, (y, others) in enumerate(reversed(held)):
                i, j = np.nonzero(x @ y.T >= threshold)
                found.append((own[i], others[j]))
                reach = back
                if not len(i):
                    break
            del held[: max(0, len(held) - reach - 1)]
            held.append((x, own))
            a, b = (np.concatenate(v) for v in zip(*found))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            groups = list(zip(batch.column("dim").to_pylist(), batch.column("pass").to_pylist()))
            names = batch.column("vec_id").to_pylist()
            units = _rows(batch.column("embedding"))
            for k in range(len(groups)):
                if groups[k] != group:
                    if rows:
                        yield from close()
                    group, ids, rows = groups[k], [], []
                    held.clear()
                ids.append(names[k])
                rows.append(units[k])
                if len(rows) == WINDOW:
                    yield from close()
                    ids, rows = [], []
        if rows:
            yield from close()

    return ordered.mapInArrow(run, "a long, b long").distinct()


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _degrees(classes: DataFrame, pilots: dict[int, tuple[np.ndarray, np.ndarray]], threshold: float) -> dict[int, int]:
    """How many others each pilot (by dim: ids, unit vectors) links with, by comparing it with all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = {dim: np.zeros(len(ids), np.int64) for dim, (ids, _) in pilots.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in set(np.unique(dims).tolist()) & set(pilots):
                units = _units(batch.filter(pa.array(dims == dim)).column("embedding"), dim)
                for at in range(0, len(units), WINDOW):
                    count[dim] += (units[at : at + WINDOW] @ pilots[dim][1].T >= threshold).sum(0)
        for dim, n in count.items():
            yield pa.RecordBatch.from_arrays([pa.array(pilots[dim][0]), pa.array(n)], names=["vec_id", "n"])

    counted = classes.select("dim", "embedding").mapInArrow(run, "vec_id long, n long").groupBy("vec_id").agg((F.sum("n") - 1).alias("n"))
    return {r["vec_id"]: r["n"] for r in counted.collect()}  # a row a pilot


def _recall(got: dict[int, tuple[int, bool]], degree: dict[int, int]) -> float:
    """The least of three shares found: of all links, of each pilot's links on average, and of the made-up partners."""
    linked = [(min(n, degree[x]), degree[x]) for x, (n, _) in got.items() if degree[x]]
    made = [found for x, (_, found) in got.items() if not degree[x]]
    shares = [sum(n for n, _ in linked) / sum(d for _, d in linked), float(np.mean([n / d for n, d in linked]))] if linked else []
    return min([*shares, *([float(np.mean(made))] if made else [])], default=1.0)


def _links(classes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) of the passes, so many that the pilots' links are found."""
    spark = classes.sparkSession
    n, low, high, widest = classes.agg(F.count("*"), F.min("vec_id"), F.max("vec_id"), F.max("dim")).first()
    drawn = classes.orderBy(F.xxhash64(F.lit("pilot"), "vec_id"), "vec_id").limit(max(1, min(PILOTS, PILOT_NUMBERS // (widest or 1)))).collect()
    pilots = {}
    for dim in sorted({r["dim"] for r in drawn}):
        own = [r for r in drawn if r["dim"] == dim]
        pilots[dim] = np.array([r["vec_id"] for r in own], np.int64), _units(pa.array([r["embedding"] for r in own], pa.list_(pa.float64())), dim)
    degree = _degrees(classes, pilots, threshold)
    rng, partner, made = np.random.default_rng(17), {}, []
    beyond = (high or 0) + 1 if (high or 0) < (1 << 63) - 1 - PILOTS else low - PILOTS
    near = min(1.0, threshold + 1e-4)
    for dim, (ids, units) in pilots.items():
        for name, unit in zip(ids.tolist(), units):
            if not degree[name] and dim > 1 and beyond >= -(1 << 63):
                away = rng.standard_normal(dim)
                away -= away @ unit * unit
                partner[name] = beyond + len(made)
                made.append((dim, partner[name], (near * unit + (1 - near**2) ** 0.5 * away / np.linalg.norm(away)).tolist()))
    kind = classes.schema["embedding"].dataType
    extra = spark.createDataFrame(made, "dim int, vec_id long, embedding array<double>").withColumn("embedding", F.col("embedding").cast(kind))
    mixed = classes.select("dim", "vec_id", "embedding").unionAll(extra)
    sought = [name for name in degree if degree[name] or name in partner]
    real = F.col("b").between(low, high)
    done, end, found = 0, passes(n, threshold), None
    while True:
        ordered = _keyed(mixed, done, end).repartitionByRange("dim", "pass", "key").sortWithinPartitions("dim", "pass", "key", "vec_id")
        fresh = _saved(_pairs(ordered, threshold), "vector-links")
        found, done = fresh if found is None else _saved(found.unionAll(fresh).distinct(), "vector-links"), end
        seen = found.unionAll(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter(F.col("a").isin(sought))
        got = {r["a"]: r for r in seen.groupBy("a").agg(F.count_if(real).alias("n"), F.collect_set(F.when(~real, F.col("b"))).alias("made")).collect()}  # a row a pilot
        recall = _recall({x: (got[x]["n"], partner.get(x) in got[x]["made"]) if x in got else (0, False) for x in sought}, degree)
        if recall >= RECALL:
            break
        if done >= MOST:
            warnings.warn(f"after {done} passes {recall:.4f} of the pilots' links are found, not {RECALL}", stacklevel=2)
            break
        wanted = ceil(done * log(1 - RECALL) / log(1 - recall)) if recall > 0 else 2 * done
        end = min(MOST, done + min(ADDED, max(4, wanted - done)))
    return found.filter(F.col("a").between(low, high) & real) if made else found


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(sound & F.col("vec_id").isNotNull(), F.lit(False))
    classes = rows.filter(good).groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    classes = _saved(classes.withColumn("dim", F.size("embedding")), "vector-classes")
    links = _links(classes, threshold)
    copies = classes.select(F.col("vec_id").alias("b"), "copies")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "vec_id")
    found = classes.join(linked, "vec_id", "left").join(components(links).withColumnRenamed("node", "vec_id"), "vec_id", "left")
    found = found.select(
        "embedding", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    named = rows.withColumn("_e", F.when(good, F.col("embedding"))).join(found.withColumnRenamed("embedding", "_e"), "_e", "left")
    component = F.coalesce("component_id", "vec_id")
    return named.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )
