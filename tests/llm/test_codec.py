"""Rank-file encoding against the library on whole texts, and round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidewell.llm import bpe_codec as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


TEXTS = [
    "", " ", "it's we'll  two  spaces\n\n\nlines \t tabs ", "日本語のテキスト é ß Ñ <|endoftext|> it's", "a1b2 ,,, 33 x'sy", "x" * 5000, " " * 5000, " \n" * 999 + "x",
    "no spaces,but;marks:" * 200, "éà ü x　y " * 300, "🙂👍🏽 ​́" * 200, "tail   ", "'s't " * 400,
]


@pytest.mark.parametrize("long", [B.LONG, 1000, 40, 1])
def test_parts_are_encoded_as_whole_texts(library, long):
    codec = B.Codec(PATH, PATTERN, long)
    random.seed(long)
    letters = "ab Z9 .,'s\n\té日  "
    for text in TEXTS + ["".join(random.choices(letters, k=700)) for _ in range(60)]:
        assert ids(codec.encode(text)) == library.encode_ordinary(text), repr(text[:60])
        assert codec.decode(codec.encode(text)) == text.encode()
        assert "".join(part for part, _ in codec.parts(text)) == text


def test_runs_the_library_alone_fails_on():
    codec = B.Codec(PATH, PATTERN)
    for text in (" " * 2_500_000 + "x y", "word " + "\n" * 2_000_000, "a" * 600_000 + " b"):
        got = codec.encode(text)
        assert codec.decode(got) == text.encode()
    spaces = " " * 2_500_000
    assert ids(codec.encode(spaces + "x"))[-1] == ids(codec.encode(" x"))[0]


def test_decodes_raw_bytes():
    codec = B.Codec(PATH, PATTERN)
    half = codec.encode("日")
    assert len(half) > 4 and codec.decode(half[:4]) == "日".encode()[: len(codec.decode(half[:4]))]
    with pytest.raises(KeyError):
        codec.decode(np.array([60_000], "<u4").tobytes())


def test_columns(spark, messy, empty, library):
    encoded = B.encode(messy.withColumnRenamed("key", "IDS"), PATH, PATTERN)
    assert "IDS" not in encoded.columns and {"ids", "n_tokens", "lang", "rid"} <= set(encoded.columns)
    found = B.decode(encoded, PATH, PATTERN).collect()
    assert len(found) == messy.count()
    for r in found:
        text = r.text or ""
        assert ids(r.ids) == library.encode_ordinary(text) and r.n_tokens == len(r.ids) // 4
        assert bytes(r.decoded) == text.encode()
    assert B.decode(B.encode(empty, PATH, PATTERN), PATH, PATTERN).collect() == []


def test_query(spark, library):
    from tidewell.llm.queries import op12_rank_codec

    got = op12_rank_codec(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        want = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(want) // 4, hashlib.sha256(want).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
