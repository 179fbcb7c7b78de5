"""Repeated passages by common-prefix interval trees over enhanced suffix arrays.

A passage of ``least`` bytes (200) that occurs at two places must be found wherever it lies, so the
work is dealt by anchors that its content chooses: of the hashes of all 50-byte grams, the smallest
in every window of 151 grams. A passage of 200 bytes is one such window, so each of its places
has the same anchor at the same distance. What a passage can span around an anchor is the
anchor's *context*: 150 bytes before its start and 200 after.

1. Anchors that occur once are dropped; counts are combined before the shuffle.
2. Equal contexts of an anchor, by a 128-bit BLAKE2 digest, are one, with a count. One that occurs
   twice repeats as a whole.
3. Anchors with several different contexts are searched for maximal repeats. Suffixes that end at
   the anchor are sorted backwards, their common lengths stack-scanned to a tree of intervals: all
   places that share so many bytes before the anchor and then differ. For each interval its
   suffixes are taken in order of the text after the anchor, with common prefix lengths; a second
   stack scan gives the intervals of common prefixes that are long enough in sum. An interval is
   left-maximal if its places come from different branches of the first tree; it is then a maximal
   repeat, and all its places are output, neighbours in the order or not.
4. An anchor with more than ``GROUP`` different contexts (a passage in very many surroundings)
   isn't gathered: each of its contexts is cut into all its 200-byte strings, which are counted by
   a 128-bit hash with the distance to the anchor. This covers the same bytes.
5. Each document gets the places of its anchors' repeats, and they are united.

Texts are bytes of UTF-8; null is empty; matches never cross documents, overlaps count, and texts
of under 200 bytes match nothing. Every row is a document, whatever its id: rows with the same id and
text repeat each other, rows with the same or no id and different texts don't share anything. Empty tables give no rows. ``remove`` keeps all columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import text as T
from tidewell.operators.files import delete
from tidewell.operators.joins import join_on
from tidewell.session import scratch

LEAST, GRAM = 200, 50
SPAN = LEAST - GRAM + 1  # grams in a passage
BEFORE, AFTER = LEAST - GRAM, LEAST
GROUP, BUCKET = 50_000, 2_000
_inverse = pow(int(T.BASE), -1, 1 << 64)
_backward = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _backward
    if len(_backward) < n:
        grown = np.full(max(n, 2 * len(_backward)), np.uint64(_inverse))
        grown[0] = 1
        _backward = np.multiply.accumulate(grown)
    return _backward[:n]


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any byte range follows."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(T.BYTE[data] * T.powers(len(data)), out=out[1:])
    return out


def _slide(values: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """Best of each run of ``size`` values, by doubling."""
    have, out = 1, values
    while have < size:
        step = min(have, size - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash, start, first and end byte of the context of a block's anchors."""
    empty = np.zeros(0, np.int64)
    lengths = np.diff(offsets)
    if not len(data) or lengths.max() < LEAST:
        return empty, empty, empty, empty, empty
    sums, back = _sums(data), _inverse_powers(len(data) + 1)
    grams = len(data) - GRAM + 1
    hashes = T.mix((sums[GRAM:] - sums[:grams]) * back[:grams])
    windows = len(data) - LEAST + 1
    least = _slide(hashes, SPAN, np.minimum)[:windows]
    # a window counts if the 200 bytes are of one text
    rest = np.repeat(offsets[1:], lengths) - np.arange(len(data))
    least = np.where(rest[:windows] >= LEAST, least, 0)
    padded = np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)])
    most = _slide(padded, SPAN, np.maximum)[:grams]
    at = np.flatnonzero((hashes == most) & (rest[:grams] >= GRAM))
    row = np.searchsorted(offsets, at, "right") - 1
    first, end = np.maximum(at - BEFORE, offsets[row]), np.minimum(at + AFTER, offsets[row + 1])
    return row, hashes[at].view(np.int64), at, first, end


def _digests(data: np.ndarray, at: np.ndarray, first: np.ndarray, end: np.ndarray) -> list[bytes]:
    """128 bits of each context and of where the anchor lies in it."""
    raw = data.tobytes()
    return [hashlib.blake2b(raw[a:b], digest_size=16, salt=(i - a).to_bytes(2, "big")).digest() for i, a, b in zip(at.tolist(), first.tolist(), end.tolist())]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Depth, first and last of all intervals of the common-prefix tree at least so deep, inner ones first.

    ``common[i]`` is what entries i-1 and i of the sorted order share; the first is not used.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(common) + 1):
        depth = common[i] if i < len(common) else -1
        first = i - 1
        while stack and stack[-1][0] > depth:
            height, first = stack.pop()
            yield height, first, i - 1
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


class Suffixes:
    """Enhanced suffix array of some byte strings: their order and the lengths neighbours share."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.order = sorted(range(len(strings)), key=strings.__getitem__)
        self.rank = [0] * len(strings)
        for k, m in enumerate(self.order):
            self.rank[m] = k
        longest = max(map(len, strings))
        self.numbers = [int.from_bytes(x.ljust(longest, b"\0"), "big") for x in strings]
        self.longest, self.lengths = longest, list(map(len, strings))

    def common(self, members: list[int]) -> list[int]:
        """What each of these, in their order, shares with the one before."""
        out, numbers, lengths, longest = [0], self.numbers, self.lengths, self.longest
        for a, b in zip(members, members[1:]):
            same = longest - ((numbers[a] ^ numbers[b]).bit_length() + 7) // 8
            out.append(min(same, lengths[a], lengths[b]))
        return out


def left_intervals(lefts: list[bytes], rights: list[bytes], least: int) -> Iterator[tuple[int, list[int], list[tuple[int, int, int]]]]:
    """For each interval of the tree before the anchors, deepest first: its depth, its members in the
    order of the text after the anchors, and the left-maximal intervals (length, first, last) there.
    """
    before, after = Suffixes(lefts), Suffixes(rights)
    rank, at = after.rank, after.order
    common = before.common(before.order)
    for depth, first, last in intervals(common, 0):
        branch, number = {}, 0
        ranks = []
        for k in range(first, last + 1):
            number += k > first and common[k] == depth
            r = rank[before.order[k]]
            branch[r] = number
            ranks.append(r)
        ranks.sort()
        members = [at[r] for r in ranks]
        shared = after.common(members)
        if max(shared) < least - depth:
            continue
        changes, n, old = [], -1, None  # how often the branch changed so far: an interval is diverse if it does inside
        for r in ranks:
            n += branch[r] != old
            old = branch[r]
            changes.append(n)
        yield depth, members, [(length, a, b) for length, a, b in intervals(shared, least - depth) if changes[a] != changes[b]]


def maximal_repeats(lefts: list[bytes], rights: list[bytes], least: int = LEAST) -> Iterator[tuple[int, int, list[int]]]:
    """Bytes before the anchor, bytes from its start on, and all members of each maximal repeat.

    ``lefts`` are the bytes before the anchors, reversed; ``rights`` those from the anchors on.
    """
    for depth, members, found in left_intervals(lefts, rights, least):
        for length, a, b in found:
            yield depth, length, members[a : b + 1]


def reach(lefts: list[bytes], rights: list[bytes], least: int = LEAST) -> tuple[list[int], list[int]]:
    """How far the maximal repeats of each member go before its anchor, and from its start on; -1 for none.

    All of them hold the anchor, so together they cover one range. Inner intervals come first and
    give their members their length; outer ones skip the members that have one.
    """
    low, high = [-1] * len(lefts), [-1] * len(lefts)
    for depth, members, found in left_intervals(lefts, rights, least):
        following = list(range(1, len(members) + 2))  # the next member without a length, by union of runs
        taken = [False] * (len(members) + 1)
        for length, a, b in found:
            k = a
            while k <= b:
                if taken[k]:
                    hop = following[k]
                    while hop <= b and taken[hop]:
                        hop = following[hop]
                    following[k] = hop
                    k = hop
                    continue
                taken[k] = True
                m = members[k]
                low[m] = max(low[m], depth)
                high[m] = max(high[m], length)
                k += 1
    return low, high


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds ``key``, 128 bits of a SHA-256 of id and text: rows that share it are alike in both."""
    told = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return docs.withColumn("key", F.substring(F.unhex(F.sha2(told, 256)), 1, 16))


ROWS = "h long, ctx binary, row long, pos int, before short, after short, key binary"
ROWS_ARROW = pa.schema([("h", pa.int64()), ("ctx", pa.binary()), ("row", pa.int64()), ("pos", pa.int32()), ("before", pa.int16()), ("after", pa.int16()), ("key", pa.binary())])


def _anchor_rows(keyed: DataFrame) -> DataFrame:
    """A row per anchor with the number of its document, and one (row, key) per document with anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys = batch.column("key")
            for base, data, offsets in T.blocks(*T.column(batch.column("text"))):
                row, h, at, first, end = anchors(data, offsets)
                columns = (h, _digests(data, at, first, end), number + base + row, at - offsets[row], at - first, end - at, [None] * len(row))
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, ROWS_ARROW)], schema=ROWS_ARROW)
                held = base + np.unique(row)
                nothing = {k.name: pa.nulls(len(held), k.type) for k in ROWS_ARROW}
                found = nothing | {"row": pa.array(number + held), "key": keys.take(pa.array(held))}
                yield pa.RecordBatch.from_arrays(list(found.values()), schema=ROWS_ARROW)
            number += batch.num_rows

    return keyed.select("key", "text").mapInArrow(run, ROWS)


def _written(df: DataFrame, label: str) -> str:
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return path


def _saved(df: DataFrame, label: str) -> DataFrame:
    return df.sparkSession.read.parquet(_written(df, label))


def _context_bytes(keyed: DataFrame, numbers: DataFrame, contexts: DataFrame) -> DataFrame:
    """h, ctx, different, before and bytes of one place of each context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist()):
                raw = text.as_buffer().to_pybytes()
                for w in wanted:
                    values = (w["h"], w["ctx"], w["different"], w["before"], raw[w["pos"] - w["before"] : w["pos"] + w["after"]])
                    for column, value in zip(out, values):
                        column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int16(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["h", "ctx", "different", "before", "bytes"])

    asked = contexts.select("h", "ctx", "different", "place.*").join(numbers, "row")
    places = asked.groupBy("key").agg(F.collect_list(F.struct("h", "ctx", "different", "pos", "before", "after")).alias("wanted"))
    texts = join_on(keyed.select("key", "text"), places, ["key"], "inner").select("text", "wanted")
    return texts.mapInArrow(run, "h long, ctx binary, different long, before short, bytes binary")


COVER = "h long, ctx binary, low int, high int"
COVER_ARROW = pa.schema([("h", pa.int64()), ("ctx", pa.binary()), ("low", pa.int32()), ("high", pa.int32())])


def _search(contexts: DataFrame, buckets: int) -> DataFrame:
    """The repeats of each anchor: low and high are bytes from the anchor's start."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("ctx", "ascending")])
        h, before = (table.column(c).to_numpy() for c in ("h", "before"))
        ctx, parts = (table.column(c).to_pylist() for c in ("ctx", "bytes"))
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(h)) + 1, [len(h)]]).tolist()
        out: list[list[int]] = [[], [], [], []]
        for a, b in zip(bounds[:-1], bounds[1:]):
            lefts = [parts[i][: before[i]][::-1] for i in range(a, b)]
            rights = [parts[i][before[i] :] for i in range(a, b)]
            for m, (low, high) in enumerate(zip(*reach(lefts, rights))):
                if high >= 0:
                    for column, value in zip(out, (h[a + m], ctx[a + m], -low, high)):
                        column.append(value)
        return pa.Table.from_arrays([pa.array(c, k.type) for c, k in zip(out, COVER_ARROW)], schema=COVER_ARROW)

    dealt = contexts.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
    return dealt.select("h", "ctx", "before", "bytes", "bucket").groupBy("bucket").applyInArrow(run, COVER)


def _count_strings(contexts: DataFrame) -> DataFrame:
    """The same cover for anchors with very many contexts, by counting their 200-byte strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, ctx, before, raw in zip(*(batch.column(c).to_pylist() for c in ("h", "ctx", "before", "bytes"))):
                starts = range(min(before + 1, max(0, len(raw) - LEAST + 1)))
                digests = [hashlib.blake2b(raw[s : s + LEAST], digest_size=16).digest() for s in starts]
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * n, pa.int64()), pa.array([ctx] * n, pa.binary()), pa.array([s - before for s in starts], pa.int32()), pa.array(digests, pa.binary())],
                    names=["h", "ctx", "low", "string"],
                )

    strings = contexts.select("h", "ctx", "before", "bytes").mapInArrow(run, "h long, ctx binary, low int, string binary")
    often = strings.groupBy("h", "low", "string").agg(F.count("*").alias("n")).filter("n > 1")
    return strings.join(often, ["h", "low", "string"]).select("h", "ctx", "low", (F.col("low") + LEAST).alias("high"))


def repeats(keyed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(h, ctx, low, high): what repeats around each context; the places (h, ctx, row, pos) of all contexts; (row, key) of the documents."""
    spark, written = keyed.sparkSession, _written(_anchor_rows(keyed), "anchors")
    found = spark.read.parquet(written)
    rows, numbers = found.filter("key is null").drop("key"), _saved(found.filter("key is not null").select("row", "key"), "documents")
    often = rows.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    places = _saved(join_on(rows, often, ["h"], "inner"), "repeated-anchors")
    delete(spark, written)  # nothing reads it again
    place = F.struct("row", "pos", "before", "after")
    contexts = places.groupBy("h", "ctx").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    contexts = _saved(contexts, "contexts")
    whole = contexts.filter("n > 1 AND place.before + place.after >= 200")
    whole = whole.select("h", "ctx", (-F.col("place.before")).cast("int").alias("low"), F.col("place.after").cast("int").alias("high"))
    several = contexts.groupBy("h").agg(F.count("*").alias("different")).filter("different > 1")
    wanted = join_on(contexts, several, ["h"], "inner").select("h", "ctx", "different", "place")
    written = _written(_context_bytes(keyed, numbers, wanted).dropDuplicates(["h", "ctx"]), "context-bytes")
    mixed = spark.read.parquet(written)
    few, many = mixed.filter(F.col("different") <= GROUP), mixed.filter(F.col("different") > GROUP)
    covers = whole.unionAll(_search(few, max(1, few.count() // BUCKET)))
    if many.limit(1).count():
        covers = covers.unionAll(_count_strings(many))
    covers = _saved(covers, "repeats")
    delete(spark, written)
    return covers, places, numbers


def remove(docs: DataFrame) -> DataFrame:
    """All columns, then n_bytes, n_removed, n_spans, and the bytes that stay as ``kept``."""
    columns = docs.columns
    keyed = _keyed(docs.select(F.col("doc_id"), F.col("text")))
    covers, places, numbers = repeats(keyed)
    spans = places.join(covers, ["h", "ctx"]).select("row", (F.col("pos") + F.col("low")).alias("first"), (F.col("pos") + F.col("high")).alias("end"))
    spans = spans.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("first", "end"))).alias("spans"))  # a document's own places
    spans = spans.join(numbers, "row").groupBy("key").agg(F.max("spans").alias("spans"))  # rows alike in id and text have the same ones

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, kept = [], [], [], []
            for text, found in zip(batch.column("text"), batch.column("spans").to_pylist()):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                merged: list[list[int]] = []
                for s in found or ():
                    if merged and s["first"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["first"], s["end"]])
                at, parts = 0, []
                for first, end in merged:
                    parts.append(raw[at:first])
                    at = end
                rest = b"".join([*parts, raw[at:]])
                sizes.append(len(raw))
                removed.append(len(raw) - len(rest))
                counts.append(len(merged))
                kept.append(rest)
            fresh = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("_all"), *fresh], names=["_all", "n_bytes", "n_removed", "n_spans", "kept"])

    source = _keyed(docs.select("doc_id", "text", F.struct(*[F.col(c) for c in columns]).alias("_all")))
    joined = join_on(source, spans, ["key"], "left").select("text", "spans", "_all")
    out = joined.mapInArrow(run, f"_all {source.schema['_all'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select("_all.*", "n_bytes", "n_removed", "n_spans", "kept")
