"""Repeated runs of lines: all of them, or those that are whole chunks cut by content.

``remove_runs`` cuts by content under two rules in one pass. A hash rolled over two lines that are
not blank decides under which rule a chunk ends with them; the rules complement each other, so every
two lines are an end of one of them. From every line a chunk begins under each rule, and ends with the
rule's next end, with the text, or after 64 lines. Where a chunk begins and ends thus depends on its own lines alone,
however they are shifted, and no repeated run of two lines lies inside longer chunks of both rules.
Chunks have two lines or more, two under one rule and four on average under the other; blank lines
count as none, but those between belong to a chunk.

A chunk that came before in the corpus, by (doc_id, place), without sharing a line with its first place,
is a repeat. Of a document's repeats the farthest reaching are taken, as many as cover all of them; their bytes are
compared with those of the first place, and the lines of equal ones go. So every run of two or more lines that came
earlier goes whole, and of every distinct line a copy stays. Two different chunks with one 64-bit hash are told apart by
the bytes: nothing goes that is not repeated, and a repeat may stay. The last line's feed is not compared, so a run at a text's end equals
one that text follows. Texts are read three times: for the hashes, for the first places' bytes, and to be cut. A text is worked on
whole in one task, and its arrays take some forty times its length.

``dedup`` removes whole chunks of one rule only. Each line gets a hash, and a hash rolled over two lines decides whether a chunk ends there:
about every third line, and at the same lines wherever the same lines occur, however they are
shifted. A chunk of at least two lines that are not blank, which occurs more than once in the
corpus, stays in its first place only, by (doc_id, place); all others are removed, after their
bytes were compared with those of the first.

Chunks travel as hashes in both; they are counted before the shuffle, so a chunk that a third of the
documents share is one row a task. The first places' bytes travel too, to the documents
that repeat them, and texts travel as zstandard frames. AQE splits a hot chunk's rows in the join.

Rows with the same id and text count as one document and are treated alike. Null text stays
null, text without a line feed is one line. Both keep every column and row, and replace
``text``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import text as T
from tidewell.operators.joins import join_on
from tidewell.session import scratch

ROLLED, EVERY, LEAST_LINES = 2, 3, 2
#: A chunk of either rule ends with so many lines at the latest, so that a text's chunks are not quadratic where lines repeat.
MOST_LINES = 64
_ROLL = T.constants(ROLLED, 31)
_FOLD = T.constants(2, 37)
_PAIR = T.constants(3, 41)


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash, first byte, end and lines (blank ones not counted) of every chunk of a block.

    A last line feed is part of the hash, as it is of the bytes that are compared.
    """
    starts, line, row = T.lines(data, offsets)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty, np.zeros(0, np.uint64), empty, empty, empty
    ends = np.append(starts[1:], len(data))
    blank = (ends - starts == 1) & (data[starts] == 10)
    rolled = line * _ROLL[0]
    rolled[1:] += np.where(row[1:] == row[:-1], line[:-1], np.uint64(0)) * _ROLL[1]
    close = T.mix(rolled) % np.uint64(EVERY) == 0
    close[:-1] |= row[1:] != row[:-1]
    close[-1] = True
    first = np.concatenate([[0], np.flatnonzero(close)[:-1] + 1])
    number = np.arange(len(line)) - np.repeat(first, np.diff(np.append(first, len(line))))
    value = (line ^ _FOLD[0]) * T.powers(int(number.max()) + 1)[number]
    stop = np.append(starts[first][1:], len(data))
    hashed = T.mix(np.add.reduceat(value, first) * _FOLD[1] + (data[stop - 1] == 10))
    return row[first], hashed, starts[first], stop, np.add.reduceat((~blank).astype(np.int64), first)


def _places(docs: DataFrame) -> DataFrame:
    """hash, did, rid, at, end of every chunk of enough lines; at and end are bytes of its text."""
    kinds = pa.schema([("hash", pa.int64()), ("did", pa.int64()), ("rid", pa.int64()), ("at", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did, rid = (batch.column(x).to_numpy() for x in ("did", "rid"))
            for at, data, offsets in T.blocks(*T.column(batch.column("text"))):
                row, hashed, begin, end, lines = chunks(data, offsets)
                kept = lines >= LEAST_LINES
                row = row[kept]
                columns = (hashed[kept].view(np.int64), did[at + row], rid[at + row], begin[kept] - offsets[row], end[kept] - offsets[row])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=kinds)

    return docs.mapInArrow(run, "hash long, did long, rid long, at long, end long")


def _packed(docs: DataFrame) -> DataFrame:
    """The same with each text as a zstandard frame, for the shuffles that move whole texts."""
    kinds = ", ".join(f"{f.name} {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            frames = [press.compress(x.as_buffer()) if x.is_valid else None for x in batch.column("text")]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(frames, pa.binary()))

    return docs.mapInArrow(run, kinds)


def _unpacked(frame: pa.Scalar) -> bytes | None:
    return zstandard.ZstdDecompressor().decompress(frame.as_buffer()) if frame.is_valid else None


def _first_bytes(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """hash and bytes of the chunks' first places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, parts = [], []
            for text, places in zip(batch.column("text"), batch.column("places").to_pylist()):
                raw = _unpacked(text)
                hashes.extend(p["hash"] for p in places)
                parts.extend(raw[p["at"] : p["end"]] for p in places)
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(parts, pa.binary())], names=["hash", "bytes"])

    wanted = firsts.groupBy("did", "rid").agg(F.collect_list(F.struct("hash", "at", "end")).alias("places"))  # a document's own chunks
    distinct = join_on(_packed(docs.select("did", "rid", "text")), wanted, ["did", "rid"], "inner").select("text", "places")
    return distinct.mapInArrow(run, "hash long, bytes binary").groupBy("hash").agg(F.first("bytes").alias("bytes"))


def _keyed(docs: DataFrame) -> DataFrame:
    """did, rid, text and all other columns as _rest."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"), F.xxhash64("doc_id", "text").alias("rid"),
        F.col("text"), F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("_rest"),
    )


def rolled_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash, first byte and end (without the line feed) of the chunks that begin at every line of a block, under either rule."""
    starts, line, row = T.lines(data, offsets)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    stops = ends - (data[ends - 1] == 10)
    solid = np.flatnonzero(stops > starts)
    starts, stops, line, row = starts[solid], stops[solid], line[solid], row[solid]
    if len(solid) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    apart = np.diff(solid).astype(np.uint64)
    rolled = T.mix(line[:-1] * _PAIR[0] + line[1:] * _PAIR[1] + apart * _PAIR[2])  # over this line and the next
    inside = row[1:] == row[:-1]
    rule = T.mix(rolled ^ _FOLD[1]) >> np.uint64(63)  # the rule under which a chunk may end with the next line
    final = np.append(row[1:] != row[:-1], True)[1:]  # the next line is its text's last
    total = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(rolled * T.powers(len(rolled)))])
    inverse = np.full(len(rolled), pow(int(T.BASE), -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    begin, close = [], []
    for which in (0, 1):
        marks = np.flatnonzero(inside & ((rule == which) | final))
        first = np.flatnonzero(inside)
        begin.append(first)
        close.append(np.minimum(marks[np.searchsorted(marks, first)], first + MOST_LINES - 2))
    first, last = np.concatenate(begin), np.concatenate(close)
    own = np.concatenate([np.ones(len(begin[0]), bool), close[0] != close[1]])  # a text's last lines are cut alike by both
    first, last = first[own], last[own]
    hashed = T.mix((total[last + 1] - total[first]) * inverse[first] + (last - first).astype(np.uint64) * _FOLD[0])
    return row[first], hashed, starts[first], stops[last + 1]


def _rolled_places(docs: DataFrame) -> DataFrame:
    """hash, did, rid, at, end of every chunk under either rule; at and end are bytes of its text."""
    kinds = pa.schema([(x, pa.int64()) for x in ("hash", "did", "rid", "at", "end")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did, rid = (batch.column(x).to_numpy() for x in ("did", "rid"))
            for at, data, offsets in T.blocks(*T.column(batch.column("text"))):
                row, hashed, begin, end = rolled_chunks(data, offsets)
                columns = (hashed.view(np.int64), did[at + row], rid[at + row], begin - offsets[row], end - offsets[row])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=kinds)

    return docs.mapInArrow(run, "hash long, did long, rid long, at long, end long")


def cover(places: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (first byte, end, hash) in order, few that cover the same bytes: from each place on, the one that reaches farthest."""
    kept: list[tuple[int, int, int]] = []
    reach, best = -1, None
    for place in places:
        if best is not None and place[0] > reach:  # the next one does not meet what is kept
            kept.append(best)
            reach, best = best[1], None
        if place[0] > reach:
            kept.append(place)
            reach = place[1]
        elif place[0] == kept[-1][0]:  # the longer of two from one line
            kept[-1], reach, best = place, place[1], None
        elif place[1] > reach and (best is None or place[1] > best[1]):
            best = place
    return kept if best is None else [*kept, best]


def _needed(later: DataFrame) -> DataFrame:
    """Of each document's repeated chunks, those that cover the same lines with few bytes to compare."""
    own = later.groupBy("did", "rid").agg(F.sort_array(F.collect_set(F.struct("at", "end", "hash"))).alias("chunks"))  # a document's own chunks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("chunks")
            parts = [x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten()]
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(size)]).tolist()
            kept = [cover(list(zip(*(x[a:b].tolist() for x in parts)))) for a, b in zip(bounds, bounds[1:])]
            of = np.repeat(np.arange(len(kept)), [len(x) for x in kept])
            columns = [np.array([p[j] for x in kept for p in x], np.int64) for j in (2, 0, 1)]
            did, rid = (batch.column(x).to_numpy()[of] for x in ("did", "rid"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (columns[0], did, rid, *columns[1:])], names=["hash", "did", "rid", "at", "end"])

    return own.mapInArrow(run, "hash long, did long, rid long, at long, end long")


def remove_runs(docs: DataFrame) -> DataFrame:
    """All columns, ``text`` without the repeated runs of lines, and the columns removed_chunks (runs) and removed_bytes."""
    spark, columns = docs.sparkSession, docs.columns
    keyed = _keyed(docs)
    path, needed_path = scratch(spark, "line-chunks"), scratch(spark, "repeated-chunks")
    _rolled_places(keyed.select("did", "rid", "text")).write.parquet(path)
    places = spark.read.parquet(path)
    place = F.struct("did", "rid", "at", "end")
    known = places.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(F.col("first") != F.col("last")).drop("last")
    own = (F.col("did") == F.col("first.did")) & (F.col("rid") == F.col("first.rid")) & (F.col("at") < F.col("first.end"))
    _needed(join_on(places, known, ["hash"], "inner").filter(~own).drop("first")).write.parquet(needed_path)
    needed = spark.read.parquet(needed_path)
    firsts = known.join(needed.select("hash").distinct(), "hash", "left_semi").select("hash", "first.*")
    compared = join_on(needed, _first_bytes(keyed, firsts), ["hash"], "inner")
    gone = compared.groupBy("did", "rid").agg(F.sort_array(F.collect_set(F.struct("at", "end", "bytes"))).alias("gone"))  # a document's own lines

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs_gone, bytes_gone = [], [], []
            for text, places_gone in zip(batch.column("text"), batch.column("gone")):
                runs: list[list[int]] = []
                raw = _unpacked(text)
                for p in places_gone.as_py() or ():
                    if raw[p["at"] : p["end"]] != p["bytes"]:
                        continue
                    end = min(p["end"] + 1, len(raw))  # with the last line's feed
                    if runs and p["at"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([p["at"], end])
                if runs:
                    kept, at = [], 0
                    for begin, end in runs:
                        kept.append(raw[at:begin])
                        at = end
                    texts.append(b"".join([*kept, raw[at:]]).decode())
                else:
                    texts.append(None if raw is None else raw.decode())
                runs_gone.append(len(runs))
                bytes_gone.append(sum(end - begin for begin, end in runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_rest"), pa.array(texts, pa.string()), pa.array(runs_gone, pa.int32()), pa.array(bytes_gone, pa.int64())],
                names=["_rest", "_text", "_chunks", "_bytes"],
            )

    return _restored(keyed, gone, run, columns)


def _restored(keyed: DataFrame, gone: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], columns: list[str]) -> DataFrame:
    """Every document cut by ``run``, with its columns in their order."""
    joined = join_on(_packed(keyed), gone, ["did", "rid"], "left").select("text", "gone", "_rest")
    cleaned = joined.mapInArrow(run, f"_rest {keyed.schema['_rest'].dataType.simpleString()}, _text string, _chunks int, _bytes long")
    restored = [F.col("_text").alias("text") if c == "text" else F.col(f"_rest.`{c}`").alias(c) for c in columns]
    return cleaned.select(*restored, F.col("_chunks").alias("removed_chunks"), F.col("_bytes").alias("removed_bytes"))


def dedup(docs: DataFrame) -> DataFrame:
    """All columns, ``text`` without the repeated chunks, and the columns removed_chunks and removed_bytes."""
    spark, columns = docs.sparkSession, docs.columns
    keyed = _keyed(docs)
    path = scratch(spark, "line-chunks")
    _places(keyed.select("did", "rid", "text")).write.parquet(path)
    places = spark.read.parquet(path)
    place = F.struct("did", "rid", "at")
    counted = places.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.min_by("end", place).alias("first_end"))
    counted = counted.filter(F.col("first") != F.col("last"))
    firsts = counted.select("hash", "first.did", "first.rid", "first.at", F.col("first_end").alias("end"))
    known = _first_bytes(keyed, firsts).join(counted.select("hash", "first"), "hash")
    later = join_on(places, known, ["hash"], "inner").filter(place != F.col("first")).select("did", "rid", "at", "end", "bytes").distinct()
    gone = later.groupBy("did", "rid").agg(F.sort_array(F.collect_list(F.struct("at", "end", "bytes"))).alias("gone"))  # a document's own chunks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, chunks_gone, bytes_gone = [], [], []
            for text, places_gone in zip(batch.column("text"), batch.column("gone")):
                raw = _unpacked(text)
                kept, at, n, size = [], 0, 0, 0
                for p in places_gone.as_py() or ():
                    if raw[p["at"] : p["end"]] == p["bytes"]:
                        kept.append(raw[at : p["at"]])
                        at, n, size = p["end"], n + 1, size + p["end"] - p["at"]
                texts.append(None if raw is None else b"".join([*kept, raw[at:]]).decode())
                chunks_gone.append(n)
                bytes_gone.append(size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_rest"), pa.array(texts, pa.string()), pa.array(chunks_gone, pa.int32()), pa.array(bytes_gone, pa.int64())],
                names=["_rest", "_text", "_chunks", "_bytes"],
            )

    return _restored(keyed, gone, run, columns)
