"""Language of whole texts: first the family, then the language within it.

Texts become hashed counts of byte trigrams over lower-cased letters, square-rooted and scaled
to length one. Linear support vector machines (squared hinge) tell families apart, one against
the rest; within the winning family one machine for each pair of languages votes, and the sum
of margins settles equal votes. The machines are fitted on the driver from a bounded sample,
``sample_rows`` labelled texts shared equally among the languages and drawn by a hash of the id;
every text is predicted whole. Only texts and their labels are learned from.

A text that is null or has no letter is ``und`` with score 0. If no labelled text is left to
learn from, every text is ``und``. Null ids are kept and never learned from; repeated rows get
equal results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import text as T

DIM, ROWS = 4096, 512
#: Language families by ISO 639-1 code; a language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "turkic": "tr az kk ky uz tt tk",
    "indic": "hi bn mr gu pa ne ur si",
    "uralic": "fi et hu",
    "baltic": "lt lv",
    "celtic": "ga cy br gd",
    "semitic": "ar he mt am",
    "austronesian": "id ms tl jv",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTERS[0x80:] = np.arange(0x80, 0x100)


class Model(NamedTuple):
    families: list[str]
    by_family: np.ndarray  # a row of weights for each family
    languages: list[list[str]]  # of each family
    pairs: list[list[tuple[int, int]]]
    by_pair: list[np.ndarray]


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A unit row of hashed trigram weights for each text of a block."""
    rows = len(offsets) - 1
    out = np.zeros((rows, DIM), np.float32)
    if len(data) > 2:
        b = LETTERS[data].astype(np.uint32)
        row = np.repeat(np.arange(rows), np.diff(offsets))
        key = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1) >> np.uint32(20)
        kept = (row[:-2] == row[2:]) & ((b[1:-1] != 0x20) | (b[:-2] != 0x20) & (b[2:] != 0x20))
        count = np.bincount(row[:-2][kept] * DIM + key[kept], minlength=rows * DIM)
        out = np.sqrt(count.astype(np.float32)).reshape(rows, DIM)
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out


def lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    sure = np.concatenate([[0], np.cumsum((LETTERS[data] != 0x20) & (data < 0x80))])
    out = sure[offsets[1:]] > sure[offsets[:-1]]
    raw = data.tobytes()
    for i in np.flatnonzero(~out & (offsets[1:] > offsets[:-1])).tolist():
        out[i] = any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].decode())
    return out


def small_blocks(array: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of a text column with a bounded number of rows too."""
    for _, data, offsets in T.blocks(*T.column(array)):
        for at in range(0, len(offsets) - 1, ROWS):
            part = offsets[at : at + ROWS + 1]
            yield data[part[0] : part[-1]], part - part[0]


def machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by accelerated descent."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], 1)
    x, y = x.astype(np.float32), y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1)).astype(np.float32)
    w = ahead = np.zeros(x.shape[1], np.float32)
    rate = 1 / (2 * 2.0 + penalty)  # rows have squared length 2 with the bias
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        moved = ahead - np.float32(rate) * (np.float32(penalty) * ahead - 2 * ((weight * y * slack) @ x))
        w, ahead = moved, moved + np.float32(t / (t + 3)) * (moved - w)
    return w


def fit(docs: DataFrame, learnable: Column, sample_rows: int = 2400) -> Model | None:
    """Fit on a sample of the rows where ``learnable`` holds and text and lang are not null."""
    known = docs.filter(learnable & F.col("text").isNotNull() & F.col("lang").isNotNull())
    found = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not found:
        return None
    share = max(sample_rows // len(found), 1)
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id")), F.lit(1 << 30))
    limits = F.create_map(*[F.lit(x) for lang, n in sorted(found.items()) for x in (lang, int((1 << 30) * min(1.0, share / n)))])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(x, h) for block in small_blocks(batch.column("text")) for x, h in zip(trigrams(*block), lettered(*block))]
            got = [(lang, x.astype(np.float16).tobytes()) for lang, (x, h) in zip(batch.column("lang").to_pylist(), rows) if h]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([g[0] for g in got], pa.string()), "x": pa.array([g[1] for g in got], pa.binary())})

    sample = known.filter(draw < limits[F.col("lang")]).select("text", "lang").mapInArrow(extract, "lang string, x binary").collect()
    if not sample:
        return None
    sample.sort()
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in sample]).astype(np.float32)
    lang = np.array([r["lang"] for r in sample])
    family = np.array([FAMILY.get(v, v) for v in lang])
    families = sorted(set(family.tolist()))
    by_family = np.stack([machine(x, np.where(family == f, 1.0, -1.0)) for f in families])
    languages = [sorted(set(lang[family == f].tolist())) for f in families]
    pairs = [list(combinations(range(len(names)), 2)) for names in languages]
    by_pair = []
    for names, ones in zip(languages, pairs):
        rows = []
        for a, b in ones:
            of = (lang == names[a]) | (lang == names[b])
            rows.append(machine(x[of], np.where(lang[of] == names[a], 1.0, -1.0)))
        by_pair.append(np.stack(rows) if rows else np.zeros((0, DIM + 1), np.float32))
    return Model(families, by_family, languages, pairs, by_pair)


def classify(model: Model, x: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each row of features."""
    margins = x @ model.by_family[:, :-1].T + model.by_family[:, -1]
    best = margins.argmax(1)
    names, score = [""] * len(x), 1 / (1 + np.exp(-3 * margins.max(1)))
    for f in np.unique(best).tolist():
        rows = np.flatnonzero(best == f)
        votes = np.zeros((len(rows), len(model.languages[f])))
        least = np.full(votes.shape, np.inf)
        for (a, b), w in zip(model.pairs[f], model.by_pair[f]):
            m = x[rows] @ w[:-1] + w[-1]
            votes[:, a] += (m > 0) + 1e-3 * np.tanh(m)
            votes[:, b] += (m <= 0) - 1e-3 * np.tanh(m)
            least[:, a], least[:, b] = np.minimum(least[:, a], m), np.minimum(least[:, b], -m)
        winner = votes.argmax(1)
        margin = least[np.arange(len(rows)), winner]
        score[rows] *= 1 / (1 + np.exp(-3 * margin))
        for i, k in zip(rows.tolist(), winner.tolist()):
            names[i] = model.languages[f][k]
    return names, score


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for block in small_blocks(batch.column("text")):
                has = lettered(*block) & (model is not None)
                got, score = classify(model, trigrams(*block)) if model else (["und"] * len(has), np.zeros(len(has)))
                names.extend(n if h else "und" for n, h in zip(got, has.tolist()))
                scores.extend(np.where(has, score, 0.0).tolist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out() -> Column:
    """Rows that are never learned from: a fifth by checksum of the id, and null ids."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def identify(docs: DataFrame, sample_rows: int = 2400) -> DataFrame:
    """Fit on the rows not held out, predict all: doc_id, held_out, lang_pred, score."""
    model = fit(docs, ~held_out(), sample_rows)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
