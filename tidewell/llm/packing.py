"""Documents packed into token windows by non-negative least squares over length counts.

A document's ids, with the end id, are cut into full windows and one remainder. The counts of
the remainders' lengths, at most as many numbers as the window is wide, go to the driver. There
all pairs and triples of lengths that fill a window are enumerated, non-negative least squares
finds how often to repeat each so that together they use up the counts, and the repeats are
rounded to what is there. Greedy packing follows: first with the same combinations, then what
is left is laid end to end, longest first, and cut at every window; the last part-filled window
is cut at powers of two. So no sequence needs padding, and only the left-over pieces are cut.

A piece finds its place by its length and its number among the pieces of that length: tasks
count as they encode, and a table of counts per task and length turns those numbers into global
ones. Nothing else of the corpus reaches the driver, and no length gathers in one task.

Null text is empty (one piece with the end id), null ids and repeated rows are packed like any
other, an empty table gives no rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import tokens
from tidewell.session import scratch

PIECES = "part int, doc_id long, start long, length int, part_rank long, ids_crc32 long, doc_tokens long, ids binary"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Plan(NamedTuple):
    """Where pieces go. Runs are ordered by (length, first number)."""

    window: int
    keys: np.ndarray  # length << 40 | number of the run's first piece
    times: np.ndarray  # pieces of this length in each sequence of the run
    sequence: np.ndarray  # the run's first sequence
    offset: np.ndarray  # of the first of those pieces in its sequence
    planned: np.ndarray  # by length: how many pieces the runs take
    laid: np.ndarray  # by length: where its left-over pieces begin in the stream
    stream: int  # the stream's first sequence
    cuts: np.ndarray  # the stream's last cuts, after the full windows


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """Pairs and triples of present lengths that fill the window, longest first, 0 for none."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    a = np.arange(1, window // 2 + 1)
    a = a[has[a] & has[window - a]]
    found = [np.stack([window - a, a, np.zeros_like(a)], 1)]
    for small in range(1, window // 3 + 1):
        if has[small]:
            b = np.arange(small, (window - small) // 2 + 1)
            c = window - small - b
            ok = has[b] & has[c]
            found.append(np.stack([c[ok], b[ok], np.full(ok.sum(), small)], 1))
    return np.concatenate(found)


def least_squares(combos: np.ndarray, counts: np.ndarray, steps: int = 150) -> np.ndarray:
    """Repeats x >= 0 that bring the lengths used near the counts, by multiplicative updates."""
    used = (combos > 0).astype(float)
    wanted = (counts[combos] * used).sum(1)
    x = wanted / max(len(combos), 1) + 1e-9
    for _ in range(steps):
        now = np.bincount(combos.ravel(), (used * x[:, None]).ravel(), len(counts))
        x *= wanted / np.maximum((now[combos] * used).sum(1), 1e-12)
    return x


def solve(counts: np.ndarray, window: int) -> Plan:
    """The plan for so many pieces of each length; ``counts`` has window + 1 entries."""
    left = counts.astype(np.int64).copy()
    runs: list[tuple[int, int, int, int]] = []
    sequence = 0
    if left[window]:
        runs.append((window << 40, 1, 0, 0))
        sequence, left[window] = int(left[window]), 0
    combos = combinations(np.flatnonzero(left), window)
    if len(combos):
        x = least_squares(combos, left.astype(float))
        order = np.argsort(-x, kind="stable")
        whole = np.rint(x[order]).astype(np.int64)
        rows = [[n for n in c if n] for c in combos[order].tolist()]
        stock, taken = left.tolist(), (counts - left).tolist()
        for limits in (whole.tolist(), None):  # rounded repeats, then greedily what still fits
            for k, row in enumerate(rows):
                if limits is not None and limits[k] == 0:
                    break
                if not all(stock[n] for n in row):
                    continue
                times = {n: row.count(n) for n in row}
                repeats = min(stock[n] // t for n, t in times.items())
                if limits is not None:
                    repeats = min(repeats, limits[k])
                if repeats <= 0:
                    continue
                offset = 0
                for n, t in times.items():
                    runs.append((n << 40 | taken[n], t, sequence, offset))
                    stock[n] -= t * repeats
                    taken[n] += t * repeats
                    offset += n * t
                sequence += repeats
        left = np.array(stock, np.int64)
    lengths = np.arange(window + 1)
    tokens_left = (left * lengths)[::-1]
    laid = (np.cumsum(tokens_left) - tokens_left)[::-1]
    total = int(tokens_left.sum())
    at, cuts = total // window * window, []
    for bit in reversed(range(window.bit_length())):
        if (total - total // window * window) >> bit & 1:
            at += 1 << bit
            cuts.append(at)
    table = np.array(sorted(runs) or [(0, 1, 0, 0)], np.int64)
    return Plan(window, table[:, 0], table[:, 1], table[:, 2], table[:, 3], counts - left, laid, sequence, np.array(cuts, np.int64))


def place(plan: Plan, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces that the runs take."""
    run = np.searchsorted(plan.keys, length << 40 | number, "right") - 1
    within = number - (plan.keys[run] & ((1 << 40) - 1))
    return plan.sequence[run] + within // plan.times[run], plan.offset[run] + within % plan.times[run] * length


def lay(plan: Plan, length: int, number: int) -> Iterator[tuple[int, int, int, int]]:
    """Parts of a left-over piece: first id, ids, sequence, offset."""
    at = int(plan.laid[length]) + (number - int(plan.planned[length])) * length
    end, begin, w = at + length, at, plan.window
    full = int(plan.cuts[-1]) // w * w if len(plan.cuts) else None
    while at < end:
        if full is None or at < full:
            stop, sequence, first = (at // w + 1) * w, plan.stream + at // w, at // w * w
        else:
            k = int(np.searchsorted(plan.cuts, at, "right"))
            stop, sequence = int(plan.cuts[k]), plan.stream + full // w + k
            first = int(plan.cuts[k - 1]) if k else full
        stop = min(stop, end)
        yield at - begin, stop - at, sequence, at - first
        at = stop


def cut(docs: DataFrame, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """Full windows and remainders of all documents, numbered by task and length."""
    kinds = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("part_rank", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, met, end = TaskContext.get().partitionId(), [0] * (window + 1), np.array([end_id], np.uint32)
        for batch in batches:
            all_ids, bounds = tokens.encoder(tokenizer).encode(batch.column("text"))
            rows: list[list] = [[] for _ in kinds]
            for name, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                ids = np.concatenate([all_ids[a:b], end])
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    n = len(piece)
                    kept = None if n == window else piece.astype(np.uint16 if piece.max() < 65536 else np.uint32).tobytes()
                    for column, value in zip(rows, (part, name, start, n, met[n], zlib.crc32(piece.tobytes()), len(ids), kept)):
                        column.append(value)
                    met[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(rows, kinds)], schema=kinds)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, PIECES)


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if window < 2 or window & (window - 1) or window >= 1 << 20:
        raise ValueError("the window must be a power of two below 2**20")
    spark, path = docs.sparkSession, scratch(docs.sparkSession, "pieces")
    cut(docs, tokenizer, end_id, window).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(window + 1, np.int64)
    for row in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length
        counts[row["length"]] = row["n"]
    plan = solve(counts, window)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(bases, ["part", "length"]).withColumn("number", F.col("base") + F.col("part_rank"))
    kinds = pa.schema([(x.split()[0], pa.int64()) for x in PLACED.split(", ")])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [batch.column(x).to_numpy(zero_copy_only=False) for x in ("start", "length", "ids_crc32", "doc_tokens", "number")]
            start, length, crc, doc_tokens, number = (x.astype(np.int64) for x in whole)
            names = batch.column("doc_id")
            set_by_run = number < plan.planned[length]
            sequence, offset = place(plan, length[set_by_run], number[set_by_run])
            kept = pa.array(set_by_run)
            columns = [names.filter(kept), *(pa.array(x[set_by_run]) for x in (start, length, crc, doc_tokens)), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)
            loose = np.flatnonzero(~set_by_run)
            if len(loose):
                out: list[list] = [[] for _ in kinds]
                ids = batch.column("ids")
                for i in loose.tolist():
                    raw = ids[i].as_py()
                    row = np.frombuffer(raw, np.uint16 if len(raw) == 2 * length[i] else np.uint32).astype("<u4")
                    for first, n, sequence_id, at in lay(plan, int(length[i]), int(number[i])):
                        value = zlib.crc32(row[first : first + n].tobytes())
                        for c, v in zip(out, (names[i].as_py(), int(start[i]) + first, n, value, int(doc_tokens[i]), sequence_id, at)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=kinds)

    return numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "number", "ids").mapInArrow(settle, PLACED)
