"""The source audit against whole dictionaries of exact numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import rows
from tidewell.llm import divergence as D


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(table, least, ranks):
    docs = [(lang or "", source or "", terms(text)) for lang, source, text in table]
    out = []
    for lang in {d[0] for d in docs}:
        within = Counter(t for x, _, ts in docs if x == lang for t in set(ts))
        kept = sorted(t for t in within if within[t] >= least)
        groups = defaultdict(Counter)
        for x, source, ts in docs:
            if x == lang:
                groups[source].update(t for t in ts if t in set(kept))
        whole = sum(groups.values(), Counter())

        def share(counts):
            n = sum(counts.values())
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        def price(p, q):
            return (p - q) * (p - q) // (p + q)

        shares, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            pairs = [(o, sum(price(shares[s][t], shares[o][t]) for t in kept)) for o in groups if o != s]
            over = [(t, price(shares[s][t], q[t])) for t in kept if groups[s][t] and shares[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", over, ranks)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found)]
    return sorted(out)


WORDS = ["the", "The", "été", "Été", "日本", "x", "y", "zeta", "omega", "don't", "a1b2", "𐐀", "_", "...", "7"]


def drawn(seed, n):
    random.seed(seed)
    table = []
    for _ in range(n):
        lang, source = random.choice(["en", "fr", None, ""]), random.choice(["s1", "s1", "s1", "s2", "s3", None])
        words = random.choices(WORDS[: random.choice([3, 9, 15])], k=random.randint(0, 12))
        table.append((lang, source, random.choice([" ".join(words), " ".join(words), None, ""])))
    return table + [("de", "alone", "one two"), ("de", "other", None), ("it", "s", "")]


def frame(spark, table):
    return spark.createDataFrame([(*t, "t", 1, "a", 5, 6) for t in table], "lang string, source string, text string, term string, n long, a string, block int, v long")


@pytest.mark.parametrize("block", [D.BLOCK, 2])
def test_audit(spark, block):
    table = drawn(4, 300)
    got = D.audit(frame(spark, table).repartition(5), least=10, ranks=4, block=block)
    assert sorted(rows(got)) == brute(table, 10, 4)


def test_small_vocabulary_ties_and_none(spark):
    table = [("en", s, "same") for s in ("a", "b", "c") for _ in range(10)] + [("xx", "a", "rare"), ("xx", "b", None)]
    assert sorted(rows(D.audit(frame(spark, table)))) == brute(table, 10, 10)
    assert rows(D.audit(frame(spark, table).limit(0))) == []


def test_messy(spark, messy):
    df = messy.withColumnRenamed("text_", "source")
    table = [tuple(r) for r in df.select("lang", "source", "text").collect()]
    assert sorted(rows(D.audit(df, least=2))) == brute(table, 2, 10)


def test_windows():
    random.seed(1)
    for size in (1, 5, 60, D.WINDOW):
        for _ in range(50):
            text = "".join(random.choices("abZé日1 .\n", k=200))
            assert [t.decode() for w in D.windows(text.encode(), size) for t in w] == terms(text)


def test_gallop_is_a_search():
    rng = np.random.default_rng(2)
    for n, m in ((0, 0), (0, 5), (5, 0), (1, 1000), (1000, 1000), (300, 50_000), (900, 3)):
        short, long = np.unique(rng.integers(0, 10 * (n + m) + 1, n)), np.unique(rng.integers(0, 10 * (n + m) + 1, m))
        for stride in (1, 7, 64):
            assert D.gallop(short, long, stride).tolist() == np.searchsorted(long, short).tolist()


def test_shares_are_exact(spark):
    counts = [0, 1, 7, 10**9, 10**12, 8 * 10**15 - 11]
    for n, v in ((8 * 10**15, 10**9), (8 * 10**15 - 11, 1), (10, 1)):
        fit = [c for c in counts if c <= n]
        want = [1 + 10**9 * (c + 2) // (n + 2 * v) for c in fit]
        assert D.shares(np.array(fit), n, v).tolist() == want
        df = spark.createDataFrame([(c, n, v) for c in fit], "c long, n long, v long")
        assert [r[0] for r in df.select(D.share("c", "n", "v")).collect()] == want


def test_price_pair():
    random.seed(9)
    for _ in range(30):
        v = 40
        a, b = ({i: random.randint(1, 9) for i in random.sample(range(v), random.randint(0, 30))} for _ in "ab")
        n_a, n_b = sum(a.values()), sum(b.values())
        arrays = [(np.array(sorted(x), np.int64), np.array([x[i] for i in sorted(x)], np.int64)) for x in (a, b)]
        assert all((p == q).all() for x in arrays for p, q in zip(D.unpack(D.pack(*x)), x))

        def share(c, n):
            return 1 + 10**9 * (c + 2) // (n + 2 * v)

        want = 0
        for i in a.keys() | b.keys():
            p, q = share(a.get(i, 0), n_a), share(b.get(i, 0), n_b)
            want += (p - q) ** 2 // (p + q)
        assert D.price_pair(*arrays, n_a, n_b, v) == (want, len(a.keys() | b.keys()))
        assert D.price_pair(*arrays[::-1], n_b, n_a, v) == (want, len(a.keys() | b.keys()))
