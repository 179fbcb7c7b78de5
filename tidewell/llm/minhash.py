"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct five-word shingles (``shingle_sets``). Its sketch has 128
registers of 16 bits: register i is the smallest value of a hash over the set, turned into an
exponential variable and rounded down on the scale of powers of 1.001, cut off at both ends. Such
registers merge by maximum, and two sketches agree in a register about as often as the sets'
Jaccard similarity, so runs of four registers are used as bands.

1. Documents with equal sets, by a BLAKE2 digest of all their shingles, are one class, named by the
   smallest id; only classes go on.
2. In each band's bucket every class is compared with two of its members: the smallest, and one
   drawn by a hash. A link to either joins the class to the bucket's component, so large groups
   need a number of comparisons in proportion to their size.
3. Buckets that still hold several components are compared in blocks of 512 against 512, inside a
   task, between components only: first by sketches, then, for members that may link, on the full
   sets. A task puts out no more links than join its components, so no pairs of a group travel,
   and no pair that shares a band is left out.
4. Before any set is fetched, the likelihood of the similarity given both sketches and both set
   sizes must have its maximum above ``ESTIMATE``, five standard errors below the threshold.
5. Links are verified on the full sets: 100 * intersection >= 75 * union.

A pair at the threshold misses all 32 bands with a chance of about 5e-6. Null texts and texts
without words have no set and link with nothing. Rows with the same id are one node, linked with
all that any of them is equal or near to; a null id links with nothing. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import text as T
from tidewell.llm.graph import components
from tidewell.operators.joins import join_on
from tidewell.session import bound_batches, scratch

SHINGLE, REGISTERS, BAND = 5, 128, 4
#: The sketch: base of the scale, rate of the exponentials, largest register.
SCALE, RATE, LARGEST = 1.001, 20.0, 65_534
THRESHOLD, ESTIMATE, BLOCK = 75, 0.55, 512
#: Ids of documents to fetch that may be broadcast: 16 MB. Beyond, they are joined.
BROADCAST_IDS = 2_000_000
_JOIN = T.constants(SHINGLE, 41)
_SHORT = T.constants(SHINGLE, 43)
_HASH = T.constants(REGISTERS, 47)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a block, in order, and where each text's begin."""
    _, word, row = T.words(T.LOWER[data], offsets, T.SPACES)
    rows = len(offsets) - 1
    n = np.bincount(row, minlength=rows)
    begin = np.cumsum(n) - n
    size = max(len(word) - SHINGLE + 1, 0)
    long = sum((word[k : k + size] * _JOIN[k] for k in range(SHINGLE)), np.zeros(size, np.uint64))
    whole = row[:size] == row[SHINGLE - 1 :] if size else np.zeros(0, bool)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    few = np.array([sum(int(word[begin[i] + k]) * int(_SHORT[k]) for k in range(n[i])) + int(n[i]) & (1 << 64) - 1 for i in short.tolist()], np.uint64)
    hashes = T.mix(np.concatenate([long[whole], few]))
    rows_of = np.concatenate([row[:size][whole], short]) if size else short
    order = np.lexsort((hashes, rows_of))
    hashes, rows_of = hashes[order], rows_of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows_of[1:] != rows_of[:-1])
    return hashes[new], np.searchsorted(rows_of[new], np.arange(rows + 1))


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of registers for each set; an empty set has zeros."""
    out = np.zeros((len(bounds) - 1, REGISTERS), np.uint16)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        least = np.empty((REGISTERS, len(full)))
        for i in range(REGISTERS):
            least[i] = np.minimum.reduceat(hashes * _HASH[i], bounds[full])
        exponential = -np.log1p(-(least + 0.5) / 2.0**64) / RATE
        out[full] = np.clip(np.floor(1 - np.log(np.maximum(exponential, 1e-300)) / np.log(SCALE)), 0, LARGEST).T
    return out


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sets from their registers and sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    u = size_a / (size_a + size_b)
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / (1 - u), (1 - u) / u)[:, None]
    chance = lambda x: -np.log1p(-x * (SCALE - 1) / SCALE) / np.log(SCALE)
    up = np.maximum(chance(u[:, None] - (1 - u[:, None]) * grid), 1e-12)
    down = np.maximum(chance(1 - u[:, None] - u[:, None] * grid), 1e-12)
    same = np.maximum(1 - up - down, 1e-12)
    score = more[:, None] * np.log(up) + less[:, None] * np.log(down) + (REGISTERS - more - less)[:, None] * np.log(same)
    return grid[np.arange(len(grid)), score.argmax(1)]


def _sketches(docs: DataFrame) -> DataFrame:
    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in T.blocks(*T.column(batch.column("text"))):
                hashes, bounds = shingle_sets(data, offsets)
                rows, n = len(offsets) - 1, np.diff(bounds)
                signs = [hashlib.blake2b(x, digest_size=16).digest() for x in T.slices(hashes, bounds)]
                sketch = registers(hashes, bounds)
                columns = [batch.column("doc_id").slice(at, rows), pa.array(n), pa.array(signs, pa.binary()), pa.array([x.tobytes() for x in sketch], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, sig binary, sketch binary")


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.stack([np.frombuffer(v.as_py(), np.uint16) for v in batch.column(c)]) for c in ("x", "y"))
                n, m = (batch.column(c).to_numpy().astype(float) for c in ("n", "m"))
                kept = pa.array((100 * np.minimum(n, m) >= THRESHOLD * np.maximum(n, m)) & (estimate(x, y, n, m) >= ESTIMATE))
                yield batch.select(["a", "b"]).filter(kept)

    left = classes.select(F.col("doc_id").alias("a"), F.col("n"), F.col("sketch").alias("x"))
    right = classes.select(F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the documents with these ids, as written."""
    ids = _saved(ids.distinct(), "set-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in T.blocks(*T.column(batch.column("text"))):
                hashes, bounds = shingle_sets(data, offsets)
                parts = [x.tobytes() for x in T.slices(hashes, bounds)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(parts)), pa.array(parts, pa.binary())], names=["doc_id", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id")
    return _saved(texts.mapInArrow(run, "doc_id long, shingles binary"), "sets")


def _links(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.intersect1d(x, y, assume_unique=True).size
                kept.append(100 * both >= THRESHOLD * (len(x) + len(y) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    full = _sets(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs)
    left, right = (full.select(F.col("doc_id").alias(k), F.col("shingles").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long").distinct()


def _sides(group: pa.Table, key: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows to compare: all within a block, or all between two."""
    block, low, high = group.column("block").to_numpy(), key[-2].as_py(), key[-1].as_py()
    i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(block == low), np.flatnonzero(block == high), indexing="ij"))
    component = group.column("component").to_numpy()
    kept = (component[i] != component[j]) & ((i < j) | (low != high))
    return i[kept], j[kept]


def _promising(buckets: DataFrame) -> DataFrame:
    """Members of the buckets that may link, by sizes and sketches, to one of another component.

    A pair is looked at in the first band it shares only.
    """
    kinds = pa.schema([(c, k) for c, k in (("key", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("doc_id", pa.int64()), ("block", pa.int32()), ("component", pa.int64()))])

    def run(key: tuple, group: pa.Table) -> pa.Table:
        n = group.column("n").to_numpy().astype(float)
        i, j = _sides(group, key)
        fit = 100 * np.minimum(n[i], n[j]) >= THRESHOLD * np.maximum(n[i], n[j])
        i, j = i[fit], j[fit]
        sketch, band = np.stack([np.frombuffer(v.as_py(), np.uint16) for v in group.column("sketch")]), group.column("band")[0].as_py()
        seen = np.zeros(group.num_rows, bool)
        for k in range(0, len(i), 4096):
            a, b = i[k : k + 4096], j[k : k + 4096]
            same = (sketch[a] == sketch[b]).reshape(len(a), -1, BAND).all(2)
            first = same.argmax(1) == band
            a, b = a[first], b[first]
            if len(a):
                likely = estimate(sketch[a], sketch[b], n[a], n[b]) >= ESTIMATE
                seen[a[likely]] = seen[b[likely]] = True
        return group.filter(pa.array(seen)).select(kinds.names).cast(kinds)

    return buckets.groupBy("key", "low", "high").applyInArrow(run, "key long, low int, high int, doc_id long, block int, component long")


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of different sets, by matrix products over the shingles that two sets or more share."""
    values = np.concatenate(sets)
    every, place, count = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    number = np.cumsum(count > 1) - 1
    kept = count[place] > 1
    owner, place = owner[kept], number[place[kept]]
    width, total = max(1, (1 << 24) // len(sets)), int((count > 1).sum())
    both = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, total, width):
        here = (place >= at) & (place < at + width)
        has = np.zeros((len(sets), min(width, total - at)), np.float32)
        has[owner[here], place[here] - at] = 1
        both += has @ has.T
    return both[i, j].astype(np.int64)


def _between(buckets: DataFrame) -> DataFrame:
    """Links on the full sets between components that meet in a block; no more than join them."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        ids, component = group.column("doc_id").to_numpy(), group.column("component").to_pylist()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in group.column("shingles").combine_chunks()]
        i, j = _sides(group, key)
        found: list[tuple[int, int]] = []
        if len(i):
            n, both = np.array([len(x) for x in sets]), intersections(sets, i, j)
            linked = 100 * both >= THRESHOLD * (n[i] + n[j] - both)
            up = {c: c for c in component}

            def top(c: int) -> int:
                while up[c] != c:
                    up[c] = up[up[c]]
                    c = up[c]
                return c

            for a, b in zip(i[linked].tolist(), j[linked].tolist()):
                x, y = top(component[a]), top(component[b])
                if x != y:
                    up[x] = y
                    found.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return buckets.groupBy("key", "low", "high").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    bound_batches(docs.sparkSession)
    sketches = _saved(_sketches(docs), "sketches")
    full = sketches.filter("n > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    classes = _saved(classes, "classes")
    width = 2 * BAND
    bands = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)), lambda k: F.xxhash64(k, F.substring("sketch", k * width + 1, F.lit(width))))
    banded = classes.select("doc_id", F.posexplode(bands).alias("band", "key"))
    drawn = F.min_by("doc_id", F.xxhash64("doc_id"))
    heads = banded.groupBy("key").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last"), drawn.alias("drawn"))
    heads = heads.filter("head <> last").drop("last")
    shared = _saved(join_on(banded, heads, ["key"], "inner"), "shared-bands")
    stars = shared.select("doc_id", F.explode(F.array_distinct(F.array("head", "drawn"))).alias("head")).filter("doc_id <> head")
    stars = stars.select(F.least("doc_id", "head").alias("a"), F.greatest("doc_id", "head").alias("b")).distinct()
    tested = _saved(_likely(stars, classes), "star-pairs")
    links = _saved(_links(tested, docs), "star-links")
    first = _saved(components(links).withColumnRenamed("node", "doc_id"), "components")

    members = shared.select("doc_id", "band", "key").join(first, "doc_id", "left")
    members = members.withColumn("component", F.coalesce("component", "doc_id"))
    mixed = members.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.count("*").alias("m")).filter("c <> d")
    mixed = mixed.select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    blocked = join_on(members, mixed, ["key"], "inner").withColumn("block", F.pmod(F.xxhash64("doc_id", "key"), F.col("blocks")).cast("int"))
    # each block meets itself and every other block once
    partners = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("low"), F.greatest("block", k).alias("high")))
    columns = ["doc_id", "band", "key", "block", "component"]
    met = blocked.select(*columns, F.explode(partners).alias("_b")).select(*columns, "_b.low", "_b.high")
    promising = _saved(_promising(met.join(classes.select("doc_id", "n", "sketch"), "doc_id")), "promising")
    more = _between(promising.join(_sets(promising.select("doc_id"), docs), "doc_id"))
    # an id with several sets belongs to several classes, which are thereby one
    several = full.groupBy("doc_id").agg(F.min("sig").alias("x"), F.max("sig").alias("y")).filter("x <> y").select("doc_id")
    named = join_on(join_on(full.select("doc_id", "sig"), several, ["doc_id"], "inner"), classes.select("sig", F.col("doc_id").alias("b")), ["sig"], "inner")
    same = named.filter("doc_id <> b").select(F.col("b").alias("a"), F.col("doc_id").alias("b")).distinct()
    final = components(links.unionAll(more).unionAll(same)).withColumnRenamed("node", "doc_id")

    of_class = classes.join(final, "doc_id", "left").select("sig", F.coalesce("component", "doc_id").alias("component"))
    named = join_on(sketches.select("doc_id", "n", "sig"), of_class, ["sig"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return named.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )
