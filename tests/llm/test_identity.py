"""Words, sets and rows that weak hashes would take for each other."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import minhash, packing, suffix_dedup, token_files, tokens
from tidewell.llm import text as T

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
#: A Thue-Morse word of 1,024 letters and its complement: equal under every power sum modulo 2^64.
MORSE = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
OTHER = MORSE.translate(str.maketrans("ab", "ba"))


def test_hashes_of_runs():
    random = np.random.default_rng(1)
    texts = [MORSE, OTHER, MORSE * 9, OTHER * 9, MORSE * 4 + OTHER * 4, "a", "b", "ab", "a" * 5000, "a" * 5001, "a" * 9000] + ["".join(random.choice(list("ab"), 700)) for _ in range(50)]
    for gap in (" ", " " * 6000):
        data = np.frombuffer(gap.join(texts).encode(), np.uint8)
        _, hashes, _ = T.words(data, np.array([0, len(data)]), T.SPACES)
        assert len(set(hashes.tolist())) == len(texts)
        for text, h in zip(texts, hashes):  # the same alone as among others
            assert T.words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), T.SPACES)[1][0] == h


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("weak", [False, True])
def test_encoder(path, weak, monkeypatch):
    if weak:  # every piece has the same hash as many others
        monkeypatch.setattr(T, "hash_runs", lambda data, starts, skip=None: data[starts].astype(np.uint64) % np.uint64(3))
    library = Tokenizer.from_file(path)
    texts = [MORSE, OTHER, f"{MORSE} {OTHER}", "one two  three", "", "tea tee ten"]
    ids, bounds = tokens.Encoder(path).encode(pa.array(texts))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_files_and_packing(spark, tmp_path):
    docs = spark.createDataFrame([(1, MORSE), (2, OTHER)], "doc_id long, text string").coalesce(1)
    token_files.write(docs, str(tmp_path / "t"), BYTE, 2)
    library = Tokenizer.from_file(BYTE)
    for row in token_files.read_documents(spark, str(tmp_path / "t")).collect():
        want = library.encode([MORSE, OTHER][row["doc_id"] - 1], add_special_tokens=False).ids + [2]
        assert row["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
    library = Tokenizer.from_file(WORD)
    for row in packing.pack(docs, WORD, end_id=1, window=2048).collect():
        want = library.encode([MORSE, OTHER][row["doc_id"] - 1], add_special_tokens=False).ids + [1]
        piece = want[row["start"] : row["start"] + row["length"]]
        assert row["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())


def test_near_duplicates(spark):
    docs = spark.createDataFrame([(1, MORSE), (2, OTHER), (3, MORSE)], "doc_id long, text string")
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == {1: (1, True), 2: (2, True), 3: (1, False)}


def test_an_id_with_several_texts_is_one_node(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (9, b), (4, "alone")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(1, 1), (5, 1), (9, 1), (4, 4)}


def test_rows_without_an_id_share_no_spans(spark):
    passage = " ".join(f"shared{i}" for i in range(40))
    unlike = " ".join(f"other{i}" for i in range(40))
    hashed = spark.range(200_000).select(
        F.concat(F.lit("a"), F.col("id").cast("string"), F.lit(" " + passage)).alias("a"), F.concat(F.lit("b"), F.col("id").cast("string"), F.lit(" " + unlike)).alias("b")
    )
    left, right = hashed.select("a", F.hash("a").alias("h")), hashed.select("b", F.hash("b").alias("h"))
    twins = left.join(right, "h").limit(1).collect()
    assert twins  # two texts with one 32-bit hash
    docs = [(None, twins[0]["a"]), (None, twins[0]["b"]), (5, "z " + passage), (5, unlike.upper())]
    got = suffix_dedup.remove(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    gone = {r["text"]: r["n_removed"] for r in got}
    assert gone[twins[0]["b"]] == 0 and gone[unlike.upper()] == 0
    assert gone[twins[0]["a"]] == gone["z " + passage] == len(" " + passage)
