import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.conftest import MESSY

from tidewell.llm import embeddings, graph, line_dedup, minhash, suffix_dedup
from tidewell.llm import text as T


def union_find(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 90)], [(i, (i * 7) % 50) for i in range(50)], [(5, 5), (3, 9), (9, 3)]])
def test_components(spark, edges):
    real = [e for e in edges if e[0] != e[1]]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == union_find({n for e in real for n in e}, real)


# ---- lines


def brute_lines(docs):
    """Chunks by a plain loop over lines; the first place of each stays."""
    cut = {}
    for key, text in docs:
        lines = re.findall(r"[^\n]*\n|[^\n]+", text or "")
        hashes = [int(T.lines(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]))[1][0]) for x in lines]
        parts, held = [], []
        for k, x in enumerate(lines):
            held.append(x)
            rolled = hashes[k] * int(line_dedup._ROLL[0]) + (hashes[k - 1] * int(line_dedup._ROLL[1]) if k else 0)
            if int(T.mix(np.array([rolled & (1 << 64) - 1], np.uint64))[0]) % line_dedup.EVERY == 0 or k == len(lines) - 1:
                parts.append(held)
                held = []
        cut[key] = parts
    seen, out = set(), {}
    for key in sorted(cut):
        kept = []
        for part in cut[key]:
            body = "".join(part)
            if sum(x != "\n" for x in part) >= 2:
                if body in seen:
                    continue
                seen.add(body)
            kept.append(body)
        out[key] = "".join(kept)
    return out


def test_line_chunks_are_those_of_brute_force(spark):
    rng = np.random.default_rng(4)
    lines = [f"line number {i} é\n" for i in range(30)] + ["\n"]
    shared = ["".join(rng.choice(lines, 12)) for _ in range(4)]
    docs = []
    for i in range(60):
        body = "".join(rng.choice(lines[:-1], rng.integers(0, 6))) + (shared[i % 4] if i % 2 else "") + f"own {i}\n" + "".join(rng.choice(lines, 5))
        docs.append((i, body.rstrip("\n") if i % 5 == 0 else body))
    docs += [(100, docs[3][1]), (101, docs[3][1] + "\n"), (102, None), (103, "")]
    got = {r["doc_id"]: r for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    wanted = brute_lines(docs)
    assert {i: r["text"] or "" for i, r in got.items()} == wanted
    assert got[102]["text"] is None
    assert sum(r["removed_chunks"] for r in got.values()) > 20
    for i, t in docs:
        assert got[i]["removed_bytes"] == len((t or "").encode()) - len((got[i]["text"] or "").encode())


def brute_runs(docs):
    """What stays when each line goes that lies in two lines which came before, not on the same lines; the runs that came before, and how many of them stay in part."""
    first, out, runs = {}, {}, []
    for key, text in sorted((k, t) for k, t in docs if t is not None):
        at, seen = 0, []
        for x in re.findall(r"[^\n]*\n|[^\n]+", text):
            seen.append((at, at + len(x), x.rstrip("\n")))
            at += len(x)
        solid = [k for k, x in enumerate(seen) if x[2]]
        gone = set()
        for a, b in zip(solid, solid[1:]):
            name = (seen[a][2], b - a, seen[b][2])
            if name not in first:
                first[name] = (key, b)
            elif first[name][0] != key or a > first[name][1]:
                gone |= set(range(a, b + 1))
                runs.append((key, a, b))
        out[key] = "".join(text[s:e] for k, (s, e, _) in enumerate(seen) if k not in gone)
    return out, runs


def test_every_repeated_run_of_lines_goes(spark):
    rng = np.random.default_rng(4)
    lines = [f"line number {i} é\n" for i in range(60)] + ["\n"]
    docs = []
    for i in range(80):
        body = f"own {i}\n" + "".join(rng.choice(lines, rng.integers(0, 9))) + f"also own {i}\n" + "".join(rng.choice(lines, 3))
        docs.append((i, body.rstrip("\n") if i % 3 == 0 else body))
    docs += [(100, docs[3][1]), (101, docs[4][1] + "\n"), (103, ""), (104, "q\n" * 3), (105, "q\n" * 6), (106, "two\nlines"), (107, "x\ntwo\nlines\ny"), (108, "two\n\nlines")]
    got = {r["doc_id"]: r for r in line_dedup.remove_runs(spark.createDataFrame([*docs, (102, None), docs[7]], "doc_id long, text string")).collect()}
    wanted, runs = brute_runs(docs)
    assert len(runs) > 30 and {i: r["text"] for i, r in got.items()} == {**wanted, 102: None}
    assert got[100]["text"] == got[101]["text"].strip("\n") == "" and got[107]["text"] == "x\ny" and got[108]["text"] == "two\n\nlines"
    for i, t in docs:
        assert got[i]["removed_bytes"] == len(t.encode()) - len(got[i]["text"].encode()) and (got[i]["removed_chunks"] > 0) == (got[i]["removed_bytes"] > 0)


def test_runs_of_the_given_table_and_edge_cases(spark, messy, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    wanted, runs = brute_runs([tuple(r) for r in docs.collect()])
    assert runs and {r["doc_id"]: r["text"] for r in line_dedup.remove_runs(docs).collect() if r["text"] is not None} == wanted
    out = line_dedup.remove_runs(messy.drop("removed_chunks"))
    assert out.columns == [*messy.drop("removed_chunks").columns, "removed_chunks", "removed_bytes"] and out.count() == len(MESSY)
    assert line_dedup.remove_runs(empty.drop("removed_chunks")).count() == 0


def rolled(text):
    """First byte, end and hash of the chunks of a text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    _, hashed, begin, end = line_dedup.rolled_chunks(raw, np.array([0, len(raw)]))
    return list(zip(begin.tolist(), end.tolist(), hashed.tolist()))


def test_chunks_of_both_rules_depend_on_their_own_lines():
    rng = np.random.default_rng(8)
    lines = [f"line {i} é" for i in range(300)]
    whole = "\n".join(lines)
    chunks = rolled(whole)
    sizes = [len(whole.encode()[a:b].split(b"\n")) for a, b, _ in chunks]
    assert min(sizes) == 2 and 3.5 < np.mean([n for n in sizes if n > 2]) < 5
    two = {whole.encode()[a:b].decode() for (a, b, _), n in zip(chunks, sizes) if n == 2}
    assert two == {f"{a}\n{b}" for a, b in zip(lines, lines[1:])}  # each by one of the rules
    named = {whole.encode()[a:b]: h for a, b, h in chunks}
    for _ in range(20):  # anything may stand before and after
        a, b = sorted(rng.integers(0, 300, 2).tolist())
        body = "\n".join([*(f"other {i}" for i in range(int(rng.integers(0, 9)))), *lines[a:b], "more", "still more"])
        inside = {body.encode()[x:y]: h for x, y, h in rolled(body) if b"other" not in body.encode()[x:y] and b"more" not in body.encode()[x:y]}
        assert all(named[x] == h for x, h in inside.items())
        wanted = {x for x in named if set(x.decode().split("\n")) <= set(lines[a : min(b, 299)])}
        assert wanted <= set(inside)
    assert max(len(("a\n" * 500).encode()[a:b].split(b"\n")) for a, b, _ in rolled("a\n" * 500)) == line_dedup.MOST_LINES
    assert rolled("") == rolled("one line") == rolled("\n\n") == rolled("one\n\n") == []


@settings(max_examples=200, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 40), st.integers(1, 12)), max_size=30))
def test_few_chunks_cover_the_same(spans):
    places = sorted((a, a + n, 0) for a, n in spans)
    kept = line_dedup.cover(places)
    assert set(kept) <= set(places)
    assert {x for a, b, _ in kept for x in range(a, b)} == {x for a, b, _ in places for x in range(a, b)}
    assert all(c[0] > a[1] for a, c in zip(kept, kept[2:]))  # no byte in three


def test_lines_that_repeat_without_end(spark):
    docs = [(i, "a\n" * (400 + i) + f"own {i}\n" + "b\nc\n" * (150 + i)) for i in range(6)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_runs(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_runs(docs)[0]


def test_repeated_rows_are_spread(spark):
    """Half of the rows are one; the join that cuts them is one whose keys may be split."""
    docs = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("x "), "id", F.lit("\ntwo\nlines"))).otherwise("two\nlines\nmore").alias("text"))
    out = line_dedup.remove_runs(docs)
    assert out.filter("text = 'two\\nlines\\nmore'").count() == 200  # one document by id and text, and the first of all
    assert out.filter("doc_id IS NOT NULL AND removed_bytes > 0").count() == 200


def test_a_hot_chunk(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a\nb\nc\nd\ne\nf\ng\nh\n"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("own "), "id")).otherwise("")).alias("text"))
    rows = line_dedup.dedup(docs).filter("removed_bytes > 0")
    assert rows.count() >= 2998


@pytest.mark.parametrize("first_ends", [True, False])
def test_a_footer_at_the_end_and_before_text(spark, first_ends):
    for k in range(100):  # one that is cut at its end, wherever it stands
        footer = "".join(f"footer line {k} {i}\n" for i in range(12))
        body = f"{footer}more".encode()
        *_, end, lines = line_dedup.chunks(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
        if end[-2:].tolist() == [len(footer), len(body)] and lines[-2] >= 2:
            break
    docs = [(i, f"own {i}\n{footer}" + (f"more {i}" if (i > 0) == first_ends and i != 9 else "")) for i in range(10)]
    docs = [(i, t.rstrip("\n")) for i, t in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup(frame).collect()} == brute_lines(docs)
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_runs(frame).collect()}
    assert footer.strip() in got[0] and not any("footer" in got[i] for i in range(1, 10))


def test_line_edge_cases(messy, empty):
    out = line_dedup.dedup(messy.drop("removed_chunks"))
    assert out.columns == [*messy.drop("removed_chunks").columns, "removed_chunks", "removed_bytes"]
    assert out.count() == len(MESSY)
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert kept[1] is None and kept[2] == "" and kept[8] == kept[7]  # single lines stay
    assert len(kept[-3]) < len(dict(MESSY)[-3])
    assert line_dedup.dedup(empty.drop("removed_chunks")).count() == 0


# ---- shingles


def sets_of(docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def near(spark, docs):
    sets = sets_of(docs)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    wanted = union_find(sets, links)
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(s) for i, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == wanted
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return wanted


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_are_those_of_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for g in range(12):
        base = list(rng.choice(words, rng.integers(3, 160)))
        for k in range(1 + g):
            copy = base.copy()
            for at in rng.integers(0, len(base), k % 4 * len(base) // 60):
                copy[at] = str(rng.choice(words))
            docs.append((len(docs) * 3 % 251, " ".join(copy).title() if k % 2 else "\n".join(copy)))
    docs += [(300, "a b c"), (301, "A  b\tc"), (302, "a b"), (303, None), (304, " "), (305, ""), (306, "\xa0")]
    wanted = near(spark, docs)
    assert len(set(wanted.values())) < len(wanted) - 10


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(200)]
    docs = [(k, " ".join(words[3 * k : 3 * k + 100])) for k in range(30)]  # each is near the next only
    assert set(near(spark, docs).values()) == {0}


def test_blocks_find_what_stars_miss(spark):
    rng = np.random.default_rng(2)
    kinds = {k: (rng.integers(0, 65535, minhash.REGISTERS).astype(np.uint16), np.sort(rng.integers(0, 1 << 62, 50).astype(np.uint64))) for k in (0, 1)}
    rows = []
    for i in range(9):
        sketch, shingles = kinds[i % 2]
        for low, high in sorted({tuple(sorted((i % 3, b))) for b in range(3)}):
            rows.append((i, 0, 1, i % 3, i, 50, sketch.tobytes(), shingles.tobytes(), low, high))
    frame = spark.createDataFrame(rows, "doc_id long, band int, key long, block int, component long, n long, sketch binary, shingles binary, low int, high int")
    seen = minhash._promising(frame.drop("shingles"))
    assert {r["doc_id"] for r in seen.collect()} == set(range(9))
    links = [(r["a"], r["b"]) for r in minhash._between(frame).collect()]
    top = union_find(range(9), links)
    assert all((top[a] == top[b]) == (a % 2 == b % 2) for a in range(9) for b in range(9))
    later = frame.withColumn("band", F.lit(3))  # every pair shares band 0, so it isn't looked at again
    assert minhash._promising(later.drop("shingles")).count() == 0


@pytest.mark.parametrize("size", [40, 70_000])
def test_intersections(size):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2 * size, size).astype(np.uint64) * np.uint64(1 << 40)) for _ in range(200 if size < 100 else 20)]
    i, j = np.array([0, 1, 5]), np.array([2, 3, 9])  # of different sets
    assert minhash.intersections(sets, i, j).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.75, 0.9):
        a = T.mix(rng.integers(0, 1 << 63, 2000).astype(np.uint64))
        b = np.concatenate([a[: int(2000 * 2 * share / (1 + share))], T.mix(rng.integers(0, 1 << 63, 2000 - int(2000 * 2 * share / (1 + share))).astype(np.uint64))])
        r = minhash.registers(np.concatenate([a, b]), np.array([0, 2000, 4000]))
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(minhash.estimate(r[:1], r[1:], np.array([2000.0]), np.array([2000.0]))[0] - truth) < 0.17
        merged = minhash.registers(np.concatenate([a, b]), np.array([0, 4000]))
        assert (merged == np.maximum(r[0], r[1])).all()


def test_near_duplicate_edge_cases(messy, empty):
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(messy).collect() if r["doc_id"] is not None}
    assert rows[5]["component_id"] == 4 and not rows[5]["kept"] and rows[8]["component_id"] == 7
    assert all(rows[i]["n_shingles"] == 0 and rows[i]["kept"] for i in (1, 2, 3))
    assert minhash.near_duplicates(messy).filter("doc_id IS NULL").collect()[0]["kept"]
    assert minhash.near_duplicates(messy).count() == len(MESSY)
    assert minhash.near_duplicates(empty).count() == 0


# ---- vectors


def test_vector_links_are_those_of_brute_force(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((900, 16))
    for k in range(0, 300, 3):
        x[k + 1] = x[k] + rng.standard_normal(16) * 0.25
    x[600:] = x[600] + rng.standard_normal((300, 16)) * 0.2  # a dense cluster beyond one window
    x[10] = x[20]
    x[30] = x[40] * 3
    rows = [(i * 7 % 1009, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
    bad = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [None] + [1.0] * 15), (2004, [float("nan")] + [1.0] * 15), (2005, [float("inf")] + [1.0] * 15), (2006, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<float>, key int")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame).collect()}
    assert len(got) == len(rows) + len(bad)
    ids = np.array([i for i, _ in rows])
    u = np.array([v for _, v in rows], np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = np.triu(u @ u.T >= 0.9, 1)
    degree = (near | near.T).sum(1)
    found = np.array([got[i]["n_links"] for i in ids.tolist()])
    assert (found <= degree).all() and found.sum() >= 0.99 * degree.sum()
    wanted = union_find(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near))])
    assert np.mean([got[i]["component_id"] == wanted[i] for i in ids.tolist()]) > 0.99
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] and got[i]["component_id"] == i for i, _ in bad)


def test_vector_recall_on_the_given_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = frame.toPandas().sort_values("vec_id")
    u = np.stack(table["embedding"]).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    degree = (u @ u.T >= 0.9).sum(1) - 1
    got = embeddings.near_duplicates(frame).toPandas().sort_values("vec_id")["n_links"].to_numpy()
    assert (got <= degree).all() and got.sum() >= 0.99 * degree.sum()


def test_links_in_a_cone_are_found(spark, tmp_path):
    rng = np.random.default_rng(12)
    n, dim, pairs = 100_000, 64, 2000
    axis = np.zeros(dim)
    axis[0] = 1

    def unit(v):
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    x = unit(0.8**0.5 * axis + 0.2**0.5 * unit(rng.standard_normal((n, dim))))  # mean cosine 0.8
    away = rng.standard_normal((pairs, dim))
    away = unit(away - (away * x[:pairs]).sum(1, keepdims=True) * x[:pairs])
    x[pairs : 2 * pairs] = 0.905 * x[:pairs] + (1 - 0.905**2) ** 0.5 * away
    degree = np.concatenate([(x[i : i + 500] @ x.T >= 0.9).sum(1) - 1 for i in range(0, n, 500)])
    path = str(tmp_path / "cone.parquet")
    pq.write_table(pa.table({"vec_id": pa.array(range(n), pa.int64()), "embedding": pa.array(list(x), pa.list_(pa.float64()))}), path, row_group_size=20_000)
    got = embeddings.near_duplicates(spark.read.parquet(path)).select("vec_id", "n_links").toPandas().sort_values("vec_id")["n_links"].to_numpy()
    assert len(got) == n and (got <= degree).all() and got.sum() >= 0.99 * degree.sum()


def test_vector_edge_cases(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(none).count() == 0
    odd = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<float>")
    rows = embeddings.near_duplicates(odd).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in rows) == [(0, 0, 0), (1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert embeddings.passes(10**10, 0.9) < 2000 and embeddings.passes(1, 0.9) == 3


# ---- passages


def brute_removal(texts, least):
    """What stays of each text once every byte of a string that starts twice is gone."""
    count = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - least + 1):
            if count[t[i : i + least]] > 1:
                gone[i : i + least] = True
        out.append((int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def passages(seed):
    rng = np.random.default_rng(seed)
    letters = list("abcdefgé \n")
    text = lambda n: "".join(rng.choice(letters, n))
    shared = [text(n) for n in (100, 190, 210, 260, 400, 900)]
    docs = [text(rng.integers(0, 500)) + (shared[i % 6] if i % 3 else "") + text(rng.integers(0, 300)) for i in range(60)]
    long = text(2000)
    docs += [long, long[:700] + "X" + long[701:], long[300:1400], long[:201], long[-199:], "ab" * 300, "q" * 500, "q" * 200, "q" * 199]
    docs += [shared[5] + shared[5][:450] + text(50) + shared[5], docs[1], docs[1]]
    return docs


@pytest.mark.parametrize("group", [5000, 2])
def test_removed_passages_are_those_of_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    docs = [(i, t, i) for i, t in enumerate(passages(group))] + [(500, None, 0), (501, "", 0)]
    out = suffix_dedup.remove(spark.createDataFrame(docs, "doc_id long, text string, pos int"))
    assert out.columns == ["doc_id", "text", "pos", "n_bytes", "n_removed", "n_spans", "kept"]
    got = {r["doc_id"]: r for r in out.collect()}
    for (i, t, _), (removed, spans, kept) in zip(docs, brute_removal([(t or "").encode() for _, t, _ in docs], 200)):
        assert (i, got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == (i, removed, spans, kept)
        assert got[i]["n_bytes"] == len((t or "").encode())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=8), st.text("ab", max_size=8)), min_size=2, max_size=7, unique=True))
def test_interval_trees_give_all_maximal_repeats(contexts):
    least = 5
    lefts = [a.encode()[::-1] for a, _ in contexts]
    rights = [b"#" + b.encode() for _, b in contexts]
    got = {(low, high, tuple(sorted(m))) for low, high, m in suffix_dedup.maximal_repeats(lefts, rights, least)}
    cover = {(m, k) for low, high, members in got for m in members for k in range(-low, high)}
    wanted = set()
    for x in range(len(contexts)):
        for y in range(len(contexts)):
            if x != y:
                low, high = suffix_dedup._common(lefts[x], lefts[y]), suffix_dedup._common(rights[x], rights[y])
                if low + high >= least:
                    wanted |= {(x, k) for k in range(-low, high)}
    assert cover == wanted
    for low, high, members in got:  # each is a repeat, maximal to both sides, with all its places
        words = {lefts[m][:low] + b"|" + rights[m][:high] for m in members}
        assert len(words) == 1
        all_places = [m for m in range(len(contexts)) if lefts[m][:low] + b"|" + rights[m][:high] in words and len(lefts[m]) >= low and len(rights[m]) >= high]
        assert sorted(members) == all_places


def test_anchors_are_shared_by_every_repeat():
    rng = np.random.default_rng(9)
    passage = bytes(rng.integers(97, 123, 200).astype(np.uint8))
    for cut in (0, 1, 57, 400):
        a, b = bytes(rng.integers(97, 123, cut).astype(np.uint8)) + passage, passage + bytes(rng.integers(97, 123, 90).astype(np.uint8))
        data, offsets = T.column(pa.array([a.decode(), b.decode()]))
        row, h, at, *_ = suffix_dedup.anchors(data, offsets)
        first = {(x, p - cut) for r, x, p in zip(row.tolist(), h.tolist(), at.tolist()) if r == 0}
        second = {(x, p - len(a)) for r, x, p in zip(row.tolist(), h.tolist(), at.tolist()) if r == 1}
        assert first & second


def test_passage_edge_cases(messy, empty):
    out = suffix_dedup.remove(messy)
    rows = out.collect()
    assert len(rows) == len(MESSY)
    assert {r["n_removed"] for r in rows if r["doc_id"] in (7, 8)} == {len(dict(MESSY)[7])}
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (1, 2, 3, 4, 6, 9, 10))
    assert suffix_dedup.remove(empty).count() == 0
    assert hashlib.sha256(b"").hexdigest() in {hashlib.sha256(bytes(r["kept"])).hexdigest() for r in rows}
