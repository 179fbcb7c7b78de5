"""How far the sources of a language differ in their words: exact counts, pair by pair.

A term is a run of letters: ASCII letters, of which A-Z are lower-cased, and all other characters beyond ASCII.
A language keeps the V terms that at least ``LEAST`` of its documents hold. A source of a language, a
*group*, gives each kept term p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), where N is its number of kept
terms; so does the language as a whole. Two such values differ by floor((p - q)^2 / (p + q)).

1. Tasks count the terms of their documents in dictionaries of bounded size; the sums per language,
   source and term are combined by Spark. A frequent term or a large source is a few rows a task.
2. Kept terms get numbers: a hash deals a language's terms into blocks of some ``BLOCK``, and each block is
   numbered by itself. A group has one sorted array of (number, count) a block, so no array grows with the data.
3. Each unordered pair of a language's groups is a task a block: the two arrays are co-grouped. The shorter array gallops
   through the longer one to find the overlap; terms of both, of one side and, over all blocks, of neither (the rest of the V)
   are priced by the counts of each side. The value is the same in both directions, which are put out as two rows.
4. The terms that a group overuses most are ranked against the language.

Sums are of 64-bit whole numbers; a count is scaled digit by digit, so that no product overflows below 9 * 10^15 kept
terms. Null text, lang and source are empty text. Documents are rows, whatever their ids, so repeated rows count each; a long
text is counted a window at a time; ties rank by the item's UTF-8 bytes. Other columns are not read. A group
without terms still has its rows, an empty table gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.joins import join_on
from tidewell.session import scratch

#: Documents that must hold a kept term; what a group's shares add up to, about; ranks of terms put out.
LEAST, SCALE, RANKS = 10, 1_000_000_000, 10
#: Terms of a block, on average; different terms a task holds before it passes them on; bytes of a text counted at once.
BLOCK, HELD, WINDOW = 40_000, 300_000, 1 << 22

#: ASCII letters in lower case, bytes of other characters as they are, all else a space.
LETTERS = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def windows(text: bytes, size: int = WINDOW) -> Iterator[list[bytes]]:
    """The terms of a text, a window of about ``size`` bytes at a time; windows end between terms."""
    text = text.translate(LETTERS)
    at = 0
    while len(text) - at > size:
        cut = text.rfind(b" ", at, at + size)
        if cut < 0:
            cut = text.find(b" ", at + size)
        if cut < 0:
            break
        yield text[at:cut].split()
        at = cut + 1
    yield text[at:].split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def drain() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = pa.array(n.keys(), pa.binary()).cast(pa.string())
            rows = len(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * rows, pa.string()), pa.array([source] * rows, pa.string()), terms, pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )
        counts.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            before, own = len(n), set()
            for terms in windows(text.as_buffer().to_pybytes()):
                n.update(terms)
                own.update(terms)
            docs.update(own)
            held += len(n) - before
            if held > HELD:
                yield from drain()
                held = 0
    yield from drain()


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of whole texts."""
    read = docs.select(_text("lang").alias("lang"), _text("source").alias("source"), _text("text").alias("text")).filter("text <> ''")
    partial = read.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, n: str, v: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (n + 2 v)), three digits at a time."""
    whole = f"({n} + 2 * {v})"
    first = f"(({count} + 2) * 1000)"
    second = f"(({first} % {whole}) * 1000)"
    third = f"(({second} % {whole}) * 1000)"
    return F.expr(f"1 + ({first} div {whole}) * 1000000 + ({second} div {whole}) * 1000 + ({third} div {whole})")


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """The same for the counts of a group."""
    whole, rest, out = n + 2 * v, counts + 2, np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def prices(p: np.ndarray, q: np.ndarray | int) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def gallop(short: np.ndarray, long: np.ndarray, stride: int = 64) -> np.ndarray:
    """Place in ``long`` of the first number that is not below each of ``short``; both are sorted.

    Every stride's first number is placed by itself; the others start at its place and double their
    steps until they are beyond, then halve them back.
    """
    heads = np.searchsorted(long, short[::stride])
    place = np.repeat(heads, stride)[: len(short)]
    step = np.ones(len(short), np.int64)
    low, moving = place.copy(), np.arange(len(short))
    while len(moving):  # long[low - 1] < number always holds
        ahead = low[moving] + step[moving] - 1
        moving = moving[(ahead < len(long)) & (long[np.minimum(ahead, len(long) - 1)] < short[moving])] if len(long) else moving[:0]
        low[moving] += step[moving]
        step[moving] *= 2
    while len(back := np.flatnonzero(step > 1)):
        step[back] //= 2
        ahead = low[back] + step[back] - 1
        can = back[(ahead < len(long)) & (long[np.minimum(ahead, len(long) - 1)] < short[back])]
        low[can] += step[can]
    return low


def pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted array of (number, count) as differences and counts, compressed."""
    gaps = np.diff(ids, prepend=0).astype("<u4")
    return zstandard.compress(gaps.tobytes() + counts.astype("<u8").tobytes(), 1)


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(payload)
    n = len(raw) // 12
    return np.cumsum(np.frombuffer(raw, "<u4", n)).astype(np.int64), np.frombuffer(raw, "<u8", n, 4 * n).astype(np.int64)


def price_pair(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n_a: int, n_b: int, v: int) -> tuple[int, int]:
    """Sum of the prices of the terms that one side or both have, and how many these are."""
    if len(a[0]) > len(b[0]):
        a, b, n_a, n_b = b, a, n_b, n_a
    place = gallop(a[0], b[0])
    both = np.flatnonzero(place < len(b[0]))
    both = both[b[0][place[both]] == a[0][both]]
    p, q = shares(a[1], n_a, v), shares(b[1], n_b, v)
    (p_none,), (q_none,) = shares(np.zeros(1, np.int64), n_a, v), shares(np.zeros(1, np.int64), n_b, v)
    only_a = np.ones(len(p), bool)
    only_a[both] = False
    only_b = np.ones(len(q), bool)
    only_b[place[both]] = False
    total = prices(p[both], q[place[both]]).sum() + prices(p[only_a], q_none).sum() + prices(q[only_b], p_none).sum()
    return int(total), len(p) + len(q) - len(both)


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payload = []
        for row in batch.column("terms"):
            entries = row.values.flatten()
            payload.append(pack(*[x.to_numpy().astype(np.int64) for x in entries]))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("lang", "source", "block")], pa.array(payload, pa.binary())], ["lang", "source", "block", "payload"])


PAIR = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64()), ("terms", pa.int64())])


def _price(left: pa.Table, right: pa.Table) -> pa.Table:
    nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    row = (left if left.num_rows else right).select(["lang", "a", "b", "n_a", "n_b", "v"]).to_pylist()[0]
    a, b = (unpack(t.column("payload")[0].as_py()) if t.num_rows else nothing for t in (left, right))
    value, terms = price_pair(a, b, row["n_a"], row["n_b"], row["v"])
    return pa.Table.from_pylist([{"lang": row["lang"], "a": row["a"], "b": row["b"], "value": value, "terms": terms}], PAIR)


def audit(docs: DataFrame, least: int = LEAST, ranks: int = RANKS, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group: its pairs, and the terms it overuses most."""
    spark = docs.sparkSession

    def saved(df: DataFrame, label: str) -> DataFrame:
        path = scratch(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    counted = saved(counts(docs), "term-counts")
    vocabulary = counted.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least).drop("docs")
    vocabulary = saved(vocabulary, "terms")
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    dealt = join_on(vocabulary, langs, ["lang"], "inner").withColumn("block", F.expr(f"cast(pmod(xxhash64(term), ceil(v / {block})) as int)"))
    dealt = dealt.repartition("lang", "block")  # a language's terms would stay together as they were joined
    numbers = dealt.withColumn("number", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1)
    kept = join_on(counted.select("lang", "source", "term", "n"), numbers.select("lang", "term", "total", "block", "number"), ["lang", "term"], "inner")
    kept = saved(kept, "kept-terms")

    groups = docs.select(_text("lang").alias("lang"), _text("source").alias("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    groups = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n_group", "v", "n_lang"])
    groups = saved(groups, "groups")

    def side(name: str) -> DataFrame:
        return groups.select("lang", F.col("source").alias(name), F.col("n_group").alias(f"n_{name}"), *["v"] * (name == "a"))

    paired = scratch(spark, "pairs")
    side("a").join(side("b"), "lang").filter("a < b").write.parquet(paired)
    pairs = spark.read.parquet(paired)
    listed = kept.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("number", "n"))).alias("terms"))
    arrays = scratch(spark, "arrays")
    listed.mapInArrow(_pack_rows, "lang string, source string, block int, payload binary").write.parquet(arrays)
    key = ["lang", "a", "b", "block"]

    def arrays_of(name: str) -> DataFrame:
        """The arrays of one side of every pair; read anew, as Spark can't tell the two sides apart otherwise."""
        dealt = spark.read.parquet(paired).join(spark.read.parquet(arrays).withColumnRenamed("source", name), ["lang", name])
        return dealt.select(*key, "n_a", "n_b", "v", "payload")

    left, right = arrays_of("a"), arrays_of("b")
    priced = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_price, "lang string, a string, b string, value long, terms long")
    priced = priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    priced = pairs.join(priced, ["lang", "a", "b"], "left").na.fill(0, ["value", "terms"])
    priced = priced.withColumn("p", F.when(F.col("v") > 0, share("0L", "n_a", "v"))).withColumn("q", F.when(F.col("v") > 0, share("0L", "n_b", "v")))
    price = F.expr("((p - q) * (p - q)) div (p + q)")
    priced = priced.withColumn("value", F.col("value") + F.coalesce((F.col("v") - F.col("terms")) * price, F.lit(0)))
    priced = saved(priced.select("lang", "a", "b", "value"), "priced-pairs")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = priced.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionAll(priced.select("lang", F.col("b"), F.col("a"), "value"))
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))

    used = kept.join(groups, ["lang", "source"]).withColumn("p", share("n", "n_group", "v")).withColumn("q", share("total", "n_lang", "v"))
    over = used.filter("p > q").select("lang", "source", F.col("term").alias("item"), price.alias("value"))
    over = over.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= ranks)
    return both.unionByName(over.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
