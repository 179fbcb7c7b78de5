import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import MESSY
from tokenizers import Tokenizer

from tidewell.llm import packing, sharding, token_files, tokens

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ENCODERS = {p: tokens.Encoder(p) for p in (BYTE, WORD)}
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
TEXT = st.text(st.sampled_from("aZéßÑÇñ×÷ª²½ 09_'stdrlvem.-\n\t\r\x0b\x1f\x85\xa0<|>“”日ǅ"), max_size=40)


def ids_of(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXT, max_size=6))
def test_same_ids_as_the_library(path, texts):
    ids, bounds = ENCODERS[path].encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [ids_of(path, t) for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_rules_are_used_and_forgetting_is_harmless(path, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 20)
    encoder = tokens.Encoder(path)
    assert encoder.rule
    texts = [" ".join(f"w{i}x{j}" for j in range(i % 7)) + " Été" for i in range(60)]
    for part in (texts, texts[::-1], texts[10:20]):
        for text in part:
            ids, _ = encoder.encode(pa.array([text]))
            assert ids.tolist() == ids_of(path, text)
    assert len(encoder.keys) < 200


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n).astype("<u4")
    assert (token_files.join_planes(token_files.split_planes(ids, planes), n, planes) == ids).all()
    row = {"planes": planes, "n_tokens": n} | token_files.pack(ids, planes, 64)
    assert (token_files.unpack(row) == ids).all()
    assert (token_files.unpack(row, n // 3, n // 2) == ids[n // 3 : n // 2]).all()


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_files_hold_every_document_in_order(spark, messy, tmp_path, planes):
    path = str(tmp_path / "files")
    token_files.write(messy, path, BYTE, 2, planes=planes, chunk=1000, segment=5000)
    got = token_files.read_documents(spark, path, with_ids=True).orderBy("start").collect()
    order = sorted(MESSY, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    wanted = [(i, ids_of(BYTE, t) + [2]) for i, t in order]
    assert [(r["doc_id"], r["ids"]) for r in got] == wanted
    start = 0
    for row, (_, ids) in zip(got, wanted):
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    flat = [x for _, ids in wanted for x in ids]
    part = token_files.read_range(spark, path, 900, 6100).orderBy("position").collect()
    assert [r["id"] for r in part] == flat[900:6100]


def test_empty_token_files(spark, empty, tmp_path):
    path = str(tmp_path / "files")
    token_files.write(empty, path, BYTE, 2)
    assert token_files.read_documents(spark, path).count() == 0


def check_packing(rows, texts, window):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for name, pieces in by_doc.items():
        copies = [t for i, t in texts if i == name]
        ids = ids_of(WORD, copies[0]) + [1]
        if len(copies) == 1:
            at = 0
            for r in sorted(pieces, key=lambda r: r["start"]):
                assert (r["start"], r["doc_tokens"]) == (at, len(ids))
                assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
                at += r["length"]
            assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    padding = 0
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
        padding += 0 if end & (end - 1) == 0 else window - end
    assert padding == 0
    assert sum(r["length"] for r in rows) == sum(len(ids_of(WORD, t)) + 1 for _, t in texts)


def test_packing_places_every_id_once(spark, messy):
    rows = packing.pack(messy, WORD, 1, window=256).collect()
    check_packing(rows, MESSY, 256)


def test_packing_of_nothing(empty):
    assert packing.pack(empty, WORD, 1).count() == 0


@settings(max_examples=60, deadline=None)
@given(counts=st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=20))
def test_plan_fills_windows(counts):
    table = np.zeros(33, np.int64)
    for n, c in counts.items():
        table[n] = c
    plan, filled = packing.solve(table, 32), {}
    for n in counts:
        number = np.arange(table[n])
        run = number < plan.planned[n]
        for s, o in zip(*(x.tolist() for x in packing.place(plan, np.full(run.sum(), n), number[run]))):
            filled.setdefault(s, []).append((o, n))
        for k in number[~run].tolist():
            parts = list(packing.lay(plan, n, k))
            assert sum(p[1] for p in parts) == n
            for _, size, s, o in parts:
                filled.setdefault(s, []).append((o, size))
    assert sorted(filled) == list(range(len(filled)))
    for parts in filled.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end == 32 or end & (end - 1) == 0


def test_shards_are_a_shuffle_without_gaps(spark, messy):
    rows = sharding.shard(messy, shards=4).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in MESSY
    )
    assert sorted(r["row_number"] for r in rows) == list(range(len(MESSY)))
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()] + [0] * (4 - len(slots))
    assert max(sizes) - min(sizes) <= 1
    again = {(r["row_number"], r["shard"], r["slot"]) for r in sharding.shard(messy, shards=4).collect()}
    assert again == {(r["row_number"], r["shard"], r["slot"]) for r in rows}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 4097])
def test_permutation_is_one(spark, n):
    got = sharding.permute(spark.range(n).withColumnRenamed("id", "p"), "p", n, seed=5).collect()
    assert sorted(r["p"] for r in got) == list(range(n))
    assert n < 100 or sum(r["p"] == k for k, r in enumerate(got)) < n / 10


def test_sharding_stays_in_spark(spark, messy, empty):
    plan = sharding.shard(messy)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExternalRDD"))
    assert sharding.shard(empty).count() == 0
