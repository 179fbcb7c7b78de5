"""The prefix trie of conversations, from sorted order and common prefix lengths.

``rebuild`` gives each conversation its sequence of turns as one text of fixed-width marks (24
characters of a SHA-256 of role and text), so that text order is the order of sequences.
``nodes`` sorts all sequences by range partitions over the whole table, equal ones by ``conv_id``,
and works on *runs*: a bounded number of neighbours of one partition. In a run

1. the common prefix lengths of neighbours go into a sparse table, which answers the least of any
   range in two look-ups;
2. a candidate prefix is a sequence and a depth below which its left neighbour differs. Each one
   binary-searches its left and its right extent on the table, without regard to any other: how far
   neighbours still share that many turns. The extents are the interval of its members;
3. a subtree is a contiguous range of the candidates, so sums over it are differences of running sums.

A node whose members all lie within a run is whole there. The others are prefixes of a run's first
or last sequence; their parts bear a SHA-256 of the prefix and are added up by it. A prefix that a
third of all conversations share is thus a few rows a run, and copies of one conversation are
spread over the partitions. What such a node adds to the subtrees above it is counted on the path of one
run only and summed upwards along it.

Null role or text is empty. Rows without ``conv_id`` belong to no conversation. Turns are in order
of ``turn``, null first; equal ones in order of the mark, and repeated rows all count. A conversation of
long texts is as cheap as one of short ones; its marks, 24 bytes a turn, are one value of one row. Other columns
are not read. An empty table has no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.joins import join_on
from tidewell.session import scratch

#: Characters of a turn's mark; turns of a run, unless one conversation is longer; ids in one piece of a list of ends.
MARK, RUN, ENDS = 24, 400_000, 50_000

NONE = hashlib.sha256(b"").hexdigest()

PARTS = (
    "kind int, key string, parent_key string, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, chars long, ends_sha256 string, part int, run int, side int, first long, ends string"
)
ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("key", pa.string()), ("parent_key", pa.string()), ("depth", pa.int32()), ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()), ("chars", pa.int64()), ("ends_sha256", pa.string()), ("part", pa.int32()), ("run", pa.int32()),
        ("side", pa.int32()), ("first", pa.int64()), ("ends", pa.string()),
    ]
)
WHOLE, PART, END = 0, 1, 2


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, mark, chars): the turns numbered from 1 in each conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    # 18 of the 32 bytes: 144 bits, which base64 writes without padding
    mark = F.base64(F.substring(F.unhex(F.sha2(told, 256)), 1, 18))
    marked = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", mark.alias("mark"), F.length(text).alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "mark")
    return marked.select("conv_id", F.row_number().over(order).alias("pos"), "mark", "chars")


def sequences(numbered: DataFrame) -> DataFrame:
    """(conv_id, key, chars): the marks of each conversation in one text, and the code points of each turn."""
    listed = numbered.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "mark", "chars"))).alias("t"))
    return listed.select("conv_id", F.array_join("t.mark", "").alias("key"), F.col("t.chars").alias("chars"))


def rebuild(conversations: DataFrame, every: int = 100, modulus: int = 6) -> DataFrame:
    """Conversations that begin as their host does: (conv_id, key, chars).

    The host of c is c - c % every, towards zero for a negative c. The first h turns are the host's, h = crc32(c in decimal) % modulus,
    then come c's own after its first h.
    """
    numbered = turns(conversations)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus
    own = sequences(numbered)
    heads = sequences(numbered.filter((F.col("pos") < modulus) & (F.col("conv_id") % every == 0)))
    heads = heads.select(F.col("conv_id").alias("host"), F.col("key").alias("head"), F.col("chars").alias("head_chars"))
    joined = join_on(own.withColumn("h", h.cast("int")).withColumn("host", F.col("conv_id") - F.col("conv_id") % every), heads, ["host"], "left")
    empty = F.array().cast("array<int>")
    rest = F.expr("slice(chars, h + 1, size(chars))")
    return joined.select(
        "conv_id",
        F.concat(F.coalesce(F.expr(f"substring(head, 1, h * {MARK})"), F.lit("")), F.expr(f"substring(key, h * {MARK} + 1)")).alias("key"),
        F.concat(F.coalesce(F.expr("slice(head_chars, 1, h)"), empty), rest).alias("chars"),
    )


def sparse(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the least of the 2^k values from each place on."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def least(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value of each range, both ends included."""
    level = np.frexp(last - first + 1)[1] - 1
    out = np.empty(len(first), table[0].dtype)
    for k in np.unique(level).tolist():
        at = level == k
        out[at] = np.minimum(table[k][first[at]], table[k][last[at] - (1 << k) + 1])
    return out


def extents(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place that share ``depth`` turns with the sequence at each place.

    ``table`` is over the common prefix lengths, of which number i tells about the places i - 1 and i (the
    first is of no use). Each search halves its step; the table tells if a whole step can be taken.
    """
    left, right, rows = at.copy(), at.copy(), len(table[0])
    for k in reversed(range(len(table))):
        step = 1 << k
        can = np.flatnonzero(right + step < rows)
        can = can[table[k][right[can] + 1] >= depth[can]]
        right[can] += step
        can = np.flatnonzero(left - step >= 0)
        can = can[table[k][left[can] - step + 1] >= depth[can]]
        left[can] -= step
    return left, right


def _common(marks: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Turns that each sequence shares with the one before it."""
    shared = np.minimum(length[1:], length[:-1])
    total = np.concatenate([[0], np.cumsum(shared)])
    k = np.arange(total[-1]) - np.repeat(total[:-1], shared)
    differ = marks[np.repeat(begin[:-1], shared) + k] != marks[np.repeat(begin[1:], shared) + k]
    first = np.concatenate([np.where(differ, k, total[-1]), [0]])
    out = np.concatenate([[0], shared])
    some = np.flatnonzero(shared)
    if len(some):
        out[1 + some] = np.minimum(shared[some], np.minimum.reduceat(first[:-1], total[some]))
    return out


def _within(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of the values from first up to last, which is not included."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[last] - total[first]


def _ends(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _path_keys(marks: np.ndarray) -> list[str]:
    """SHA-256 of every prefix of a sequence, from the empty one on."""
    state, keys = hashlib.sha256(), [NONE]
    for mark in marks.tolist():
        state.update(mark)
        keys.append(state.copy().hexdigest())
    return keys


def run_nodes(ids: np.ndarray, keys: list[bytes], chars: np.ndarray, part: int, run: int) -> Iterator[pa.RecordBatch]:
    """Whole nodes, parts of nodes and pieces of their lists of ends of one run of sorted sequences."""
    length = np.array([len(k) // MARK for k in keys], np.int64)
    begin = np.cumsum(length) - length
    marks = np.frombuffer(b"".join(keys), f"S{MARK}")
    rows = len(ids)
    common = _common(marks, begin, length)
    table = sparse(common)

    # a candidate for each sequence and depth that its left neighbour doesn't share; the first also has the root
    above = common.copy()
    above[0] = -1
    count = length - above
    base = np.cumsum(count) - count
    at = np.repeat(np.arange(rows), count)
    depth = np.arange(len(at)) - np.repeat(base, count) + above[at] + 1
    left, right = extents(table, at, depth)
    members = right - left + 1
    least_id = least(sparse(ids), left, right)
    last_chars = np.where(depth > 0, np.concatenate([chars, [0]])[begin[at] + np.maximum(depth - 1, 0)], 0)
    through = base + count  # candidates up to a sequence's last one
    until = through[right]

    # the parent is the candidate before, or where the sequence parts from its left neighbour the first to share that prefix
    parent = np.arange(len(at)) - 1
    heads = np.flatnonzero((depth - 1 == above[at]) & (at > 0))
    if len(heads):
        first, _ = extents(table, at[heads], depth[heads] - 1)
        parent[heads] = base[first] + depth[heads] - 1 - above[first] - 1
    border = (left == 0) | (right == rows - 1)
    whole = ~border
    children = np.bincount(parent[whole & (depth > 0)], minlength=len(at))
    leaf = whole & (children == 0)
    leaves = _within(leaf.astype(np.int64), np.arange(len(at)), until)
    saved = _within(np.where(whole, (members - 1) * last_chars, 0), np.arange(len(at)), until)

    same = np.zeros(rows + 1, bool)
    same[1:rows] = (common[1:] == length[1:]) & (length[1:] == length[:-1])
    firsts = np.flatnonzero(~same[:rows])
    lasts = np.append(firsts[1:], rows)
    group = np.full(rows, -1)
    group[firsts] = np.arange(len(firsts))
    ending = depth == length[at]

    # whole nodes; a child of a border node learns its parent's conversation later
    paths = {0: _path_keys(marks[: length[0]]), 1: _path_keys(marks[begin[-1] :])}
    on_first, on_last = left == 0, right == rows - 1
    w = np.flatnonzero(whole)
    up = parent[w]
    parent_key = np.array([None] * len(w), object)
    for i in np.flatnonzero(border[up]).tolist():
        parent_key[i] = paths[0 if on_first[up[i]] else 1][depth[up[i]]]
    ends = [NONE] * len(w)
    for i in np.flatnonzero(ending[w]).tolist():
        g = group[at[w[i]]]
        ends[i] = hashlib.sha256(_ends(ids[firsts[g] : lasts[g]]).encode()).hexdigest()
    yield _batch(
        WHOLE, len(w), parent_key=parent_key, depth=depth[w], conv_id=least_id[w], parent_conv_id=pa.array(least_id[up], mask=border[up]),
        n_convs=members[w], n_children=children[w], n_leaves=np.where(leaf[w], 1, leaves[w]), saved_tokens=saved[w], ends_sha256=ends,
    )

    # the paths of the first and of the last sequence; a node on both counts on the first
    for side, row in ((0, 0), (1, rows - 1)):
        d = np.arange(length[row] + 1)
        first, _ = extents(table, np.full(len(d), row), d)
        c = base[first] + d - above[first] - 1
        counts = np.ones(len(d), np.int64) if side == 0 else (first > 0).astype(np.int64)
        yield _batch(
            PART, len(d), key=paths[side], parent_key=[None, *paths[side][:-1]], depth=d, conv_id=least_id[c], n_convs=members[c] * counts,
            n_children=children[c] * counts, n_leaves=leaves[c] * counts, saved_tokens=saved[c] * counts, chars=last_chars[c],
            part=np.full(len(d), part), run=np.full(len(d), run), side=np.full(len(d), side),
        )
        for d, i in zip(d[(counts > 0) & (length[first] == d)].tolist(), first[(counts > 0) & (length[first] == d)].tolist()):
            listed = ids[i : lasts[group[i]]]
            for a in range(0, len(listed), ENDS):
                piece = listed[a : a + ENDS]
                yield _batch(END, 1, key=[paths[side][d]], first=piece[:1], ends=[_ends(piece)])


def _batch(kind: int, rows: int, **columns: object) -> pa.RecordBatch:
    def column(field: pa.Field) -> pa.Array:
        values = columns.get(field.name)
        if values is None:
            return pa.nulls(rows, field.type)
        return values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, field.type)

    columns["kind"] = np.full(rows, kind)
    return pa.RecordBatch.from_arrays([column(f) for f in ARROW], schema=ARROW)


def _search(run_turns: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run = TaskContext.get().partitionId(), 0
        ids, keys, chars, held = [], [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            return run_nodes(np.array(ids, np.int64), keys, np.concatenate(chars), part, run)

        for batch in batches:
            sizes = batch.column("chars")
            for conv, key, c in zip(batch.column("conv_id").to_pylist(), batch.column("key"), sizes):
                ids.append(conv)
                keys.append(key.as_py().encode())
                chars.append(c.values.to_numpy(zero_copy_only=False).astype(np.int64))
                held += 1 + len(chars[-1])
                if held >= run_turns:
                    yield from close()
                    run, ids, keys, chars, held = run + 1, [], [], [], 0
        if ids:
            yield from close()

    return search


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends_sha256) of pieces in order; only the hash's state is kept from one to the next."""
    now, state = None, None
    schema = pa.schema([("key", pa.string()), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for key, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if key != now:
                if state:
                    done.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.encode())
        yield pa.RecordBatch.from_pylist([{"key": k, "ends_sha256": v} for k, v in done], schema)
    if state:
        yield pa.RecordBatch.from_pylist([{"key": now, "ends_sha256": state.hexdigest()}], schema)


def nodes(built: DataFrame, run_turns: int = RUN) -> DataFrame:
    """A row per node of the trie of (conv_id, key, chars): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = built.sparkSession
    path = scratch(spark, "trie")
    ordered = built.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    ordered.select("conv_id", "key", "chars").mapInArrow(_search(run_turns), PARTS).write.parquet(path)
    found = spark.read.parquet(path)
    parts = found.filter(F.col("kind") == PART)
    place = F.struct("part", "run", "side")

    summed = parts.groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("whole_children"), F.sum("n_leaves").alias("whole_leaves"), F.sum("saved_tokens").alias("whole_saved"),
        F.min("chars").alias("chars"), F.min(place).alias("owner"),
    )
    below = summed.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    summed = join_on(summed, below, ["key"], "left").withColumn("n_children", F.col("whole_children") + F.coalesce("more", F.lit(0)))
    path = scratch(spark, "trie-borders")
    summed.drop("more", "whole_children").write.parquet(path)
    summed = spark.read.parquet(path)

    # what a border node adds itself goes up the path that owns it
    own = summed.select("key", "owner", ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"), (F.col("n_children") == 0).cast("long").alias("own_leaf"))
    steps = join_on(parts.select("key", "depth", place.alias("place")), own, ["key"], "inner")
    owned = F.col("place") == F.col("owner")
    upwards = Window.partitionBy("place").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.select(
        "key",
        F.sum(F.when(owned, F.col("own_saved")).otherwise(0)).over(upwards).alias("own_saved"),
        F.sum(F.when(owned, F.col("own_leaf")).otherwise(0)).over(upwards).alias("own_leaves"),
    )
    steps = steps.groupBy("key").agg(F.sum("own_saved").alias("own_saved"), F.sum("own_leaves").alias("own_leaves"))

    pieces = found.filter(F.col("kind") == END).select("key", "first", "ends")
    hashes = pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hash_ends, "key string, ends_sha256 string")
    border = join_on(join_on(summed, steps, ["key"], "inner"), hashes, ["key"], "left").select(
        "parent_key", "depth", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("whole_leaves") + F.col("own_leaves")).alias("n_leaves"), (F.col("whole_saved") + F.col("own_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"),
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    all_nodes = found.filter(F.col("kind") == WHOLE).select("parent_key", *columns).unionByName(border)
    known = all_nodes.filter("parent_key is null").select(*columns)
    parents = summed.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    asked = join_on(all_nodes.filter("parent_key is not null"), parents, ["parent_key"], "inner").withColumn("parent_conv_id", F.col("above"))
    out = known.unionByName(asked.select(*columns))
    return out.select("conv_id", F.col("depth").cast("long"), *columns[2:])
