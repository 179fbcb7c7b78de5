"""Training documents that hold benchmark items, by BM25 with block-max pruning.

The benchmark is the index: for each term its postings (item, weight), cut into blocks of
neighbouring items with the largest weight of each block. Weights are BM25 scores divided by
the score of the item against itself, so 1 means every term of the item is there and one
threshold serves all items. Every passage of every document is a query. Passages are windows of
twice the longest item's words, half overlapping, so an item that occurs lies whole in one.

Passages are evaluated a batch at a time, as in block-max WAND: first the sum of the terms'
largest weights must reach the threshold, else no item can; then, for each block of items, the
sum of the terms' block maxima; only blocks that reach it are scored, and all items above the
threshold are retrieved. Those are verified on the words: of the shingles of the item's question,
and of its answer, at least ``overlap`` must be in the passage. Shingles have five words, and fewer
in parts of under 24 words, so that one edited word breaks a quarter of a part's shingles at most.
Shingles of one or two words can lie anywhere, so a part that has them must also be in the passage
as a run in which not more than 1 - ``overlap`` of its words are edited. The answer is the item's
last sentence, or its last third where no sentence ends, and five words at least; shorter items
than ten words are judged as a whole, and those under five words must be there as they are.

The number of items, their mean and largest length, and in how many items each term occurs are counted over the whole
benchmark in Spark, and written with the items' terms. The index goes to the tasks in shards of ``shard_items`` items, one pass over the documents for
each shard, so what is sent is bounded whatever the benchmark's size, and how the items are divided changes no score and no match. Documents are never shuffled.

Null or wordless texts and items, and items without an id, match nothing. Items with the same text are all reported.
Repeated rows are reported each. Empty tables give no rows. ``decontaminate`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import text as T
from tidewell.operators.joins import join_on
from tidewell.session import scratch

K1, B = 1.2, 0.75
SHINGLE = 5
ITEMS_IN_BLOCK = 16
#: Letters, digits and bytes beyond ASCII make words.
SEPARATORS = np.ones(256, bool)
SEPARATORS[0x30:0x3A] = SEPARATORS[0x41:0x5B] = SEPARATORS[0x61:0x7B] = SEPARATORS[0x80:] = False
_JOIN = T.constants(SHINGLE, 23)


class Index(NamedTuple):
    names: np.ndarray  # item ids
    terms: np.ndarray  # hashes in order
    most: np.ndarray  # by term: its largest weight
    block_at: np.ndarray  # by term: where its blocks begin
    block: np.ndarray
    block_most: np.ndarray
    post_at: np.ndarray  # by entry of ``block``: where its postings begin
    post: np.ndarray  # item within its block
    weight: np.ndarray
    question: list[np.ndarray]  # shingles by item
    answer: list[np.ndarray]
    size: list[tuple[int, int]]  # words in a shingle of the question, and of the answer
    loose: list[list[np.ndarray]]  # words of the parts whose shingles don't tell where they lie
    stride: int


def shingle_size(words: int) -> int:
    """So many words that one edit breaks a quarter of a part's shingles at most; all of them in a part under five."""
    return words if words < SHINGLE else min(SHINGLE, (words + 1) // 5)


def shingles(words: np.ndarray, n: int | tuple[int, int]) -> np.ndarray:
    """Hashes of all runs of n words, or of the two sizes."""
    if isinstance(n, tuple):
        return np.concatenate([shingles(words, k) for k in sorted(set(n))])
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words) - n + 1
    return T.mix(sum((words[k : k + size] * _JOIN[k] for k in range(n)), np.zeros(size, np.uint64)))


def edits(part: np.ndarray, words: np.ndarray) -> int:
    """The fewest words to replace, leave out or put in that make some run of the words the part."""
    at = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, np.int64)
    for k, word in enumerate(part, 1):
        here = np.append(k, np.minimum(row[:-1] + (words != word), row[1:] + 1))
        row = np.minimum.accumulate(here - at) + at
    return int(row.min())


def _text_words(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = T.LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, hashes, _ = T.words(data, np.array([0, len(data)]), SEPARATORS)
    return starts, hashes


def _split(text: str, starts: np.ndarray) -> int:
    """The answer's first word: that of the last sentence, or of the last third; both parts have five words or more."""
    raw = text.encode().rstrip()
    for at in range(len(raw) - 2, 0, -1):
        if raw[at : at + 1] in b".?!\n" and (raw[at + 1 : at + 2].isspace() or raw[at : at + 1] == b"\n"):
            k = int(np.searchsorted(starts, at))
            if SHINGLE <= k <= len(starts) - SHINGLE:
                return k
    return max(SHINGLE, min(2 * len(starts) // 3, len(starts) - SHINGLE))


class Totals(NamedTuple):
    items: int  # with a word
    mean: float  # words in one
    longest: int


def build(items: list[tuple[int, str]], totals: Totals | None = None, counts: tuple[np.ndarray, np.ndarray] | None = None) -> Index | None:
    """The index of some items; None if none has a word.

    ``counts`` are hashes of terms, all of these items', and the numbers of items that have them. Without it and ``totals``
    the items are all there are.
    """
    names, lists, parts = [], [], []
    for name, text in items:
        starts, hashes = _text_words(text or "")
        if len(hashes):
            names.append(name)
            lists.append(hashes)
            k = _split(text, starts)
            whole = len(hashes) < 2 * SHINGLE
            parts.append((hashes, hashes) if whole else (hashes[:k], hashes[k:]))
    if not names:
        return None
    lengths = np.array([len(x) for x in lists])
    terms, term = np.unique(np.concatenate(lists), return_inverse=True)
    item = np.repeat(np.arange(len(lists)), lengths)
    pairs, tf = np.unique(term.astype(np.int64) * len(lists) + item, return_counts=True)
    term, item = pairs // len(lists), pairs % len(lists)
    if totals is None:
        totals = Totals(len(lists), float(lengths.mean()), int(lengths.max()))
        df = np.bincount(term, minlength=len(terms))
    else:
        df = np.zeros(len(terms), np.int64)
        df[np.searchsorted(terms, counts[0])] = counts[1]
    idf = np.log1p((totals.items - df + 0.5) / (df + 0.5))
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / totals.mean))
    weight /= np.bincount(item, weight)[item]
    most = np.zeros(len(terms))
    np.maximum.at(most, term, weight)
    entry = term * (len(lists) // ITEMS_IN_BLOCK + 1) + item // ITEMS_IN_BLOCK
    first = np.flatnonzero(np.diff(entry, prepend=-1))
    return Index(
        np.array(names), terms, most, np.searchsorted(term[first], np.arange(len(terms) + 1)), (item // ITEMS_IN_BLOCK)[first],
        np.maximum.reduceat(weight, first), np.append(first, len(item)), (item % ITEMS_IN_BLOCK).astype(np.int64), weight,
        [shingles(q, shingle_size(len(q))) for q, _ in parts], [shingles(a, shingle_size(len(a))) for _, a in parts],
        [(shingle_size(len(q)), shingle_size(len(a))) for q, a in parts],
        [[x for x in (q, a) if len(x) >= SHINGLE and shingle_size(len(x)) <= 2] for q, a in parts], max(32, totals.longest),
    )


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, and the range each is from."""
    size = end - begin
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size), of


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, passages: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (passage, item, score) above the threshold, from distinct (passage, term) in order."""
    could = np.bincount(passage, index.most[term], passages) >= threshold
    kept = could[passage]
    passage, term = passage[kept], term[kept]
    at, of = _ranges(index.block_at[term], index.block_at[term + 1])
    blocks = int(index.block.max()) + 1
    place = passage[of] * blocks + index.block[at]
    keys, inverse = np.unique(place, return_inverse=True)
    live = np.bincount(inverse, index.block_most[at], len(keys)) >= threshold
    kept = live[inverse]
    at, inverse = at[kept], inverse[kept]
    post, of = _ranges(index.post_at[at], index.post_at[at + 1])
    score = np.bincount(inverse[of] * ITEMS_IN_BLOCK + index.post[post], index.weight[post], len(keys) * ITEMS_IN_BLOCK)
    hit = np.flatnonzero(score >= threshold)
    key = keys[hit // ITEMS_IN_BLOCK]
    return key // blocks, key % blocks * ITEMS_IN_BLOCK + hit % ITEMS_IN_BLOCK, score[hit]


def search(index: Index, data: np.ndarray, offsets: np.ndarray, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
    """Row, item, score, question and answer overlap of the verified matches of a block."""
    _, hashes, row = T.words(T.LOWER[data], offsets, SEPARATORS)
    if not len(hashes):
        return []
    term = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[term] == hashes)
    if not len(known):
        return []
    begin = np.searchsorted(row, np.arange(len(offsets)))  # first word of each row
    slots = (np.diff(begin) - 1) // index.stride + 1
    base = np.concatenate([[0], np.cumsum(slots)])
    within = (known - begin[row[known]]) // index.stride
    here = base[row[known]] + within  # a word is in the window that begins in its stride and in the one before
    both = np.concatenate([here, here[within > 0] - 1])
    terms = np.concatenate([term[known], term[known][within > 0]])
    pairs = np.unique(both << 32 | terms)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for passage, item, score in zip(*(x.tolist() for x in retrieve(index, pairs >> 32, pairs & 0xFFFFFFFF, int(base[-1]), threshold))):
        r = int(np.searchsorted(base, passage, "right")) - 1
        first = int(begin[r]) + (passage - int(base[r])) * index.stride
        words = hashes[first : min(first + 2 * index.stride, int(begin[r + 1]))]
        there = shingles(words, index.size[item])
        question = float(np.isin(index.question[item], there).mean())
        answer = float(np.isin(index.answer[item], there).mean())
        if question >= overlap and answer >= overlap and best.get((r, item), (0.0,))[0] < score:
            if all(edits(part, words) <= (1 - overlap) * len(part) for part in index.loose[item]):
                best[r, item] = (score, question, answer)
    return [(r, item, *values) for (r, item), values in best.items()]


MATCHES = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def _counted(benchmark: DataFrame) -> tuple[DataFrame, Totals]:
    """number (from 0, gapless), item_id, text, terms (hash, items that have it) of every item with a word, and the totals."""
    spark = benchmark.sparkSession
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_text_words(x.as_py())[1] for x in batch.column("text")]
            terms = pa.array([np.unique(x).view(np.int64) for x in hashes], pa.list_(pa.int64()))
            whole = pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(x) for x in hashes], pa.int64()), terms], names=["item_id", "text", "words", "terms"])
            yield whole.filter(pa.array([len(x) > 0 for x in hashes], pa.bool_()))

    path, counted_path = scratch(spark, "items"), scratch(spark, "item-terms")
    texts.mapInArrow(run, "item_id long, text string, words long, terms array<long>").select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("key")).write.parquet(path)
    items = spark.read.parquet(path)
    n, words, longest = items.agg(F.count("*"), F.sum("words"), F.max("words")).first()
    parts = items.groupBy("part").agg(F.min("key").alias("least"), F.count("*").alias("n"))  # a row a task that wrote
    before = parts.select("part", "least", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    each = items.select("key", F.explode("terms").alias("term"))
    known = join_on(each, each.groupBy("term").agg(F.count("*").alias("n")), ["term"], "inner")
    terms = known.groupBy("key").agg(F.collect_list(F.struct("term", "n")).alias("terms"))  # an item's own terms
    numbered = items.drop("terms").join(before, "part").join(terms, "key")
    numbered.select((F.col("before") + F.col("key") - F.col("least")).alias("number"), "item_id", "text", "terms").write.parquet(counted_path)
    return spark.read.parquet(counted_path), Totals(n, words / n if n else 0.0, longest or 0)


def shards(benchmark: DataFrame, shard_items: int) -> Iterator[Index]:
    """Indexes of so many items each; the next is read when the last is done."""
    items, totals = _counted(benchmark)
    for first in range(0, totals.items, shard_items):
        rows = items.filter(F.col("number").between(first, first + shard_items - 1)).orderBy("number").toArrow()  # a shard of all items
        known = rows.column("terms").combine_chunks().flatten()
        counts = tuple(known.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        yield build(list(zip(rows.column("item_id").to_pylist(), rows.column("text").to_pylist())), totals, (counts[0].view(np.uint64), counts[1]))


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.75, shard_items: int = 20_000) -> DataFrame:
    """The verified matches of all documents with all items, the best passage of each."""
    found = docs.sparkSession.createDataFrame([], MATCHES)
    for index in shards(benchmark, shard_items):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names, out = batch.column("doc_id"), []
                for at, data, offsets in T.blocks(*T.column(batch.column("text"))):
                    out.extend((names[at + r].as_py(), int(index.names[i]), *v) for r, i, *v in search(index, data, offsets, threshold, overlap))
                columns = zip(*out) if out else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        found = found.unionAll(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, MATCHES))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.75, shard_items: int = 20_000) -> DataFrame:
    """The documents, all columns, without any verified match. Filters in place, without a join."""
    kept = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_all"), F.col("text").alias("_text"))
    kind = f"_all {kept.schema['_all'].dataType.simpleString()}, _text string"
    for index in shards(benchmark, shard_items):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for at, data, offsets in T.blocks(*T.column(batch.column("_text"))):
                    for r, *_ in search(index, data, offsets, threshold, overlap):
                        clean[at + r] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(run, kind)
    return kept.select("_all.*")
