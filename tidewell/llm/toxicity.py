"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

A text's features are its distinct words and word beginnings of four to six bytes, lower-cased
and hashed. One weight vector is shared by all thresholds: the chance that a text's grade
exceeds k is ``sigmoid(w x - t_k)`` with ordered thresholds t. The result is the chance of each
grade and with it the expected severity.

The model is fitted on the driver from a bounded sample, drawn by a hash of the id: about
``sample_rows`` labelled documents, and more of the rare grades, so that up to ``rare_rows`` are
toxic, shared evenly among the grades above 0. Where that makes a grade more frequent than it is,
the thresholds are moved back by the logarithm of the odds, so chances are those of all labels.
Labels count as grades 0 to 16. Features are first cut to the ``keep`` most telling ones. Labels
without a toxic or without a clean document that has a text give no model and a warning.

A text is toxic from a chance of 0.3 on (:data:`THRESHOLD`), a fixed value: toxic texts that are let
through are held to be worse than clean ones that are looked at twice. Where the labels have several ordered values, those are the grades. Where they are only 0
and 1, the toxic texts of the sample are divided into three grades by how many telling features
they have per word (thirds), so that severity says how thick the toxicity lies. All texts are
scored whole, in one pass without a shuffle.

A null text is an empty one, an empty text has no feature and gets the grade's base rates. Rows
without an id are scored, but never learned from; repeated rows get equal scores; without labels
everything has severity 0. Other columns stay untouched in ``reject`` and are not read in ``score``.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import text as T

BITS = 18
PREFIXES = (4, 5, 6)
#: A text counts as toxic from this chance of any toxicity on.
THRESHOLD = 0.3
#: Labels above this grade count as this one.
HIGHEST = 16
SEPARATORS = np.ones(256, bool)
SEPARATORS[0x41:0x5B] = SEPARATORS[0x61:0x7B] = SEPARATORS[0x80:] = False


class Model(NamedTuple):
    index: np.ndarray  # by hashed feature: its place among the weights, -1 for none
    weights: np.ndarray
    thresholds: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hashed number of every feature of a block, and the words of each row."""
    data = T.LOWER[data]
    starts, hashes, row = T.words(data, offsets, SEPARATORS)
    found, rows = [hashes >> np.uint64(64 - BITS)], [row]
    if len(starts):
        apart = np.append(np.flatnonzero(SEPARATORS[data]), len(data))
        ends = np.minimum(apart[np.searchsorted(apart, starts)], offsets[row + 1])
        for k in PREFIXES:
            long = ends - starts > k
            value = np.full(int(long.sum()), k, np.uint64)
            for j in range(k):
                value = value << np.uint64(8) | data[starts[long] + j].astype(np.uint64)
            found.append(T.mix(value) >> np.uint64(64 - BITS))
            rows.append(row[long])
    return np.concatenate(rows), np.concatenate(found).astype(np.int64), np.bincount(row, minlength=len(offsets) - 1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def ordinal(rows: np.ndarray, columns: np.ndarray, grade: np.ndarray, width: int, steps: int = 400, penalty: float = 5e-3) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds by gradient descent with momentum (Adam).

    Thresholds are a first one and logarithms of the steps above it, so they stay in order.
    """
    n, levels = len(grade), int(grade.max())
    theta = np.concatenate([np.zeros(width), [2.0], np.zeros(levels - 1)])
    speed, size = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, first, gaps = theta[:width], theta[width], np.exp(np.clip(theta[width + 1 :], -5, 5))
        cut = np.concatenate([[np.inf], -(first + np.concatenate([[0], np.cumsum(gaps)])), [-np.inf]])
        z = np.bincount(rows, w[columns], n)
        above = sigmoid(z + cut[grade]) * (grade > 0) + (grade == 0)  # chance of this grade or more
        beyond = sigmoid(z + np.where(grade < levels, cut[np.minimum(grade + 1, levels)], 0)) * (grade < levels)
        chance = np.maximum(above - beyond, 1e-9)
        up, down = above * (1 - above) / chance / n, beyond * (1 - beyond) / chance / n
        slope = up - down
        by_cut = np.bincount(np.where(grade > 0, grade, 0), up, levels + 1)[1:] - np.bincount(np.minimum(grade + 1, levels), down * (grade < levels), levels + 1)[1:]
        by_gap = -np.cumsum(by_cut[::-1])[::-1]
        gradient = -np.concatenate([np.bincount(columns, slope[rows], width) - penalty / 10 * w, [by_gap[0]], by_gap[1:] * gaps])
        speed, size = 0.9 * speed + 0.1 * gradient, 0.999 * size + 0.001 * gradient**2
        theta = theta - 0.1 * (speed / (1 - 0.9**t)) / (np.sqrt(size / (1 - 0.999**t)) + 1e-8)
    w, first, gaps = theta[:width], theta[width], np.exp(np.clip(theta[width + 1 :], -5, 5))
    return w, first + np.concatenate([[0], np.cumsum(gaps)])


def _drawn(labels: DataFrame, sample_rows: int, rare_rows: int) -> DataFrame | None:
    """doc_id, toxic and the share of its grade that was drawn; of no labels, nothing."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    graded = marked.groupBy("doc_id").agg(F.least(F.greatest(F.max("toxic"), F.lit(0)), F.lit(HIGHEST)).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in graded.groupBy("toxic").count().collect()}  # at most HIGHEST + 1 rows
    if not counts:
        return None
    even, floor = min(1.0, sample_rows / sum(counts.values())), rare_rows / max(len(counts.keys() - {0}), 1)
    rates = {grade: max(even, min(1.0, floor / n)) if grade else even for grade, n in counts.items()}
    rate = F.element_at(F.create_map(*[F.lit(x) for pair in rates.items() for x in pair]), F.col("toxic"))
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("doc_id")), F.lit(1 << 30))
    return graded.withColumn("rate", rate).filter(draw < F.floor(F.col("rate") * (1 << 30)))


def base_shift(grade: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """How far each threshold moves so that a model of the sample has the base rates of all labels."""
    if (rate == rate[0]).all():
        return np.zeros(int(grade.max()))
    weight = 1 / rate
    above = [grade > k for k in range(int(grade.max()))]
    return np.array([np.log(a.sum() / (~a).sum()) - np.log(weight[a].sum() / weight[~a].sum()) for a in above])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, keep: int = 8192, rare_rows: int = 1_000) -> Model | None:
    """Fit on labelled documents; ``labels`` has doc_id and the ordered number ``toxic``."""
    sample = _drawn(labels, sample_rows, rare_rows)
    if sample is None:
        warnings.warn("no labels: every text has severity 0", stacklevel=2)
        return None
    # at most about sample_rows + rare_rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, at = [], 0
            for _, data, offsets in T.blocks(*T.column(batch.column("text"))):
                rows, numbers, words = features(data, offsets)
                pairs = np.unique(rows << BITS | numbers)
                bounds = np.searchsorted(pairs, np.arange(len(offsets)) << BITS)
                for i, part in enumerate(T.slices(pairs & ((1 << BITS) - 1), bounds)):
                    known = [batch.column(c)[at + i].as_py() for c in ("doc_id", "toxic", "rate")]
                    out.append((*known, int(words[i]), part.astype(np.int32).tobytes()))
                at += len(offsets) - 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, (pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.binary()))], names=["doc_id", "toxic", "rate", "words", "x"])

    got = sorted(texts.mapInArrow(extract, "doc_id long, toxic int, rate double, words long, x binary").collect())
    grade, rate = np.array([r["toxic"] for r in got], np.int64), np.array([r["rate"] for r in got])
    if not len(got) or not grade.any() or grade.all():
        warnings.warn(f"of {len(got)} labelled texts {int((grade > 0).sum())} are toxic: every text has severity 0", stacklevel=2)
        return None
    columns = np.concatenate([np.frombuffer(r["x"], np.int32) for r in got]).astype(np.int64)
    rows = np.repeat(np.arange(len(got)), [len(r["x"]) // 4 for r in got])
    toxic = grade > 0
    inside, outside = np.bincount(columns[toxic[rows]], minlength=1 << BITS), np.bincount(columns[~toxic[rows]], minlength=1 << BITS)
    share, base = (inside + 0.5) / (toxic.sum() + 1), (outside + 0.5) / ((~toxic).sum() + 1)
    gain = np.where((inside + outside >= 3) & (share > base), inside * np.log(share / base), 0)
    best = np.argsort(-gain, kind="stable")[:keep]
    best = best[gain[best] > 0]
    index = np.full(1 << BITS, -1, np.int32)
    index[best] = np.arange(len(best))
    kept = index[columns] >= 0
    rows, columns = rows[kept], index[columns[kept]].astype(np.int64)
    if grade.max() == 1:  # divide by how thick the telling features lie
        words = np.array([max(r["words"], 1) for r in got])
        strength = np.log(share / base)[best]
        thick = np.bincount(rows, strength[columns] * (strength[columns] > 2), len(got)) / words
        low, high = np.quantile(thick[toxic], [1 / 3, 2 / 3])
        grade = np.where(toxic, 1 + (thick > low) + (thick > high), 0)
    weights, thresholds = ordinal(rows, columns, grade, len(best))
    return Model(index, weights, np.maximum.accumulate(thresholds + base_shift(grade, rate)))


def chances(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text of a block the chance that its grade is above 0, 1, ..."""
    rows, numbers, _ = features(data, offsets)
    place = model.index[numbers]
    pairs = np.unique(rows[place >= 0] << BITS | place[place >= 0])
    z = np.bincount(pairs >> BITS, model.weights[pairs & ((1 << BITS) - 1)], len(offsets) - 1)
    return sigmoid(z[:, None] - model.thresholds[None, :])


def score(docs: DataFrame, model: Model | None, extra: list[str] | None = None) -> DataFrame:
    """doc_id, severity (expected grade), grade (most likely), toxic_probability; then ``extra`` columns."""
    extra = extra or []
    names = [f"_e{i}" for i in range(len(extra))]
    read = names[extra.index("text")] if "text" in extra else "_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = [np.zeros((0, 1))]
            if model is None:
                above = [np.zeros((batch.num_rows, 1))]
            else:
                above = [chances(model, data, offsets) for _, data, offsets in T.blocks(*T.column(batch.column(read)))] or above
            p = np.concatenate(above)
            full = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], 1)
            grade = (full[:, :-1] - full[:, 1:]).argmax(1)
            columns = [batch.column("doc_id"), pa.array(p.sum(1)), pa.array(grade.astype(np.int32)), pa.array(p[:, 0].copy())]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(x) for x in names], names=["doc_id", "severity", "grade", "toxic_probability", *names])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).alias(n) for c, n in zip([*extra, *([] if "text" in extra else ["text"])], [*names, "_text"])])
    kinds = ", ".join(["doc_id long, severity double, grade int, toxic_probability double", *(f"{n} {source.schema[n].dataType.simpleString()}" for n in names)])
    scored = source.mapInArrow(run, kinds)
    return scored.select("doc_id", "severity", "grade", "toxic_probability", *[F.col(n).alias(c) for c, n in zip(extra, names)])


def reject(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose chance of any toxicity is below the threshold."""
    rest = F.struct(F.lit(0).alias("_"), *[F.col(c) for c in docs.columns if c != "text"]).alias("_rest")
    # the text travels once: it is scored and comes back
    scored = score(docs.select("doc_id", "text", rest), model, ["_rest", "text"])
    kept = scored.filter(F.col("toxic_probability") < threshold)
    return kept.select(*["text" if c == "text" else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns])
