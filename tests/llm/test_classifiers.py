import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import MESSY

from tidewell.llm import decontamination, language_id, toxicity

SF = "/root/testdata/sf0.01"


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 100 and right / n > 0.97
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(language_id.identify(docs).collect()) == sorted(language_id.identify(changed).collect())


def test_language_edge_cases(messy, empty):
    rows = language_id.identify(messy).collect()
    assert len(rows) == len(MESSY)
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert {1, 2, 3, 6} <= und and not und & {4, 7, 9, 10}
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert language_id.identify(empty).count() == 0
    unlabelled = messy.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_one_language_and_several_families(spark):
    rows = [(i, w * 20, lang) for i, (w, lang) in enumerate([("the and ", "en"), ("der und ", "de"), ("sana ja ", "fi"), ("le et ", "fr")] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
    only = docs.filter("lang = 'fi'")
    assert {r["lang_pred"] for r in language_id.identify(only).collect()} == {"fi"}


def test_toxic_texts_have_severity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    got = toxicity.score(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    flagged = F.col("toxic_probability") >= toxicity.THRESHOLD
    wanted = (flagged & (F.col("toxic") == 1), ~flagged & (F.col("toxic") == 1), flagged & (F.col("toxic") == 0))
    hit, missed, false = got.agg(*map(F.count_if, wanted)).first()
    assert hit / (hit + missed) > 0.85 and false / (hit + false) < 0.1  # from about 220 toxic texts
    assert got.filter("severity < 0 OR grade < 0").count() == 0


def test_ordered_grades_share_weights():
    rng = np.random.default_rng(3)
    x = rng.random((600, 4)) < 0.5
    grade = np.clip(x[:, 0] * 2 + x[:, 1] * 1, 0, 3).astype(int)
    rows, columns = np.nonzero(x)
    w, t = toxicity.ordinal(rows, columns, grade, 4)
    assert w[0] > w[1] > max(abs(w[2]), abs(w[3])) and t[0] < t[1] < t[2]


def graded_docs(spark, n, grades):
    """Clean texts, with documents at the given ids that say worse words the higher their grade."""
    grade = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in grades.items() for x in pair]), F.col("id").cast("int")), F.lit(0))
    noise = F.concat_ws(" ", *[F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(300)).cast("string")) for k in range(20)])
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(noise, F.repeat(F.lit(" vilest rotten scum"), grade * 3)).alias("text"), grade.alias("toxic"))
    return docs.drop("toxic"), docs.select("doc_id", "toxic")


def test_rare_toxic_texts_are_learned(spark):
    docs, labels = graded_docs(spark, 20_000, {int(i): 1 for i in range(7, 20_000, 2_500)})
    drawn = toxicity._drawn(labels, 1_000, 200).groupBy("toxic").agg(F.count("*"), F.max("rate")).collect()
    assert {r[0]: (r[1], r[2]) for r in drawn}[1] == (8, 1.0) and sum(r[1] for r in drawn) < 1_200
    got = toxicity.score(docs, toxicity.fit(docs, labels, sample_rows=1_000, rare_rows=200)).join(labels, "doc_id")
    flagged = got.filter(F.col("toxic_probability") >= toxicity.THRESHOLD)
    assert sorted(r["toxic"] for r in flagged.collect()) == [1] * 8
    assert got.agg(F.avg("toxic_probability")).first()[0] < 0.01  # not the share in the sample but that in the labels


def test_base_rates_are_those_of_all_labels():
    grade = np.repeat([0, 1, 2], [60, 30, 10])
    rate = np.array([0.001, 0.1, 1.0])[grade]
    shift = toxicity.base_shift(grade, rate)
    odds = lambda p: np.log(p / (1 - p))
    assert np.allclose(shift, [odds(40 / 100) - odds(310 / 60_310), odds(10 / 100) - odds(10 / 60_310)])
    assert not toxicity.base_shift(grade, np.full(100, 0.3)).any()


def test_labels_without_a_model_warn(spark, messy):
    for rows in ([], [(4, 0), (5, 0)], [(4, 1)], [(999, 1), (998, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        with pytest.warns(UserWarning, match="severity 0"):
            assert toxicity.fit(messy, labels) is None
    labels = spark.createDataFrame([(4, 2_000_000_000), (5, -3), (10, 0), (7, 1)], "doc_id long, toxic int")
    assert len(toxicity.fit(messy, labels).thresholds) == toxicity.HIGHEST


def test_toxicity_edge_cases(spark, messy, empty):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (10, 0, 1), (7, 0, 1), (None, 1, 1), (9, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(messy, labels)
    scored = toxicity.score(messy, model)
    assert scored.count() == len(MESSY) and scored.filter("severity IS NULL").count() == 0
    assert toxicity.score(messy, toxicity.fit(messy, labels.limit(0))).agg(F.max("severity")).first()[0] == 0
    kept = toxicity.reject(messy, model)
    assert kept.columns == messy.columns and kept.schema["text"] == messy.schema["text"]
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0


WORDS = [f"w{i}" for i in range(400)]


def brute_matches(docs, items, index, threshold, overlap):
    """Every passage against every item, scored one by one."""
    found = set()
    stats = {}
    lists = {}
    for name, text in items:
        lists[name] = decontamination._text_words(text)[1].tolist()
    n, mean = len(lists), np.mean([len(x) for x in lists.values()])
    df = {}
    for x in lists.values():
        for t in set(x):
            df[t] = df.get(t, 0) + 1
    for name, x in lists.items():
        weights = {}
        for t in set(x):
            tf = x.count(t)
            weights[t] = np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / mean))
        stats[name] = (weights, sum(weights.values()))
    where = {int(v): k for k, v in enumerate(index.names)}
    for doc, text in docs:
        words = decontamination._text_words(text or "")[1]
        for at in range(0, max(len(words), 1), index.stride):
            passage = words[at : at + 2 * index.stride]
            have = set(passage.tolist())
            for name, (weights, most) in stats.items():
                if sum(w for t, w in weights.items() if t in have) / most >= threshold - 1e-12:
                    k = where[name]
                    there = decontamination.shingles(passage, index.size[k])
                    if np.isin(index.question[k], there).mean() >= overlap and np.isin(index.answer[k], there).mean() >= overlap:
                        found.add((doc, name))
    return found


@pytest.mark.parametrize("shard_items", [1000, 7])
def test_matches_are_those_of_brute_force(spark, shard_items):
    rng = np.random.default_rng(1)
    text = lambda n: " ".join(rng.choice(WORDS, n))
    items = [(i, f"{text(12)}? {text(8)}.") for i in range(40)] + [(40, "short one"), (41, "Short, one!")]
    docs = [(i, text(rng.integers(0, 200))) for i in range(60)]
    for i in range(60, 90):
        leak = items[i % 40][1].split()
        if i % 3 == 0:
            leak[5] = "changed"
        if i % 3 == 1:
            leak = leak[:12]
        docs.append((i, f"{text(rng.integers(0, 90))} {' '.join(leak).upper()} {text(40)}"))
    docs += [(90, "a SHORT one b"), (91, None), (92, "")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*items, (50, None), (51, " ")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(*frames, shard_items=shard_items).collect()}
    assert got == brute_matches(docs, items, decontamination.build(items), 0.6, 0.75)
    assert {(i, i % 40) for i in range(60, 90) if i % 3 == 2} <= got and {(90, 40), (90, 41)} <= got
    clean = {r["doc_id"] for r in decontamination.decontaminate(*frames, shard_items=shard_items).collect()}
    assert clean == {i for i, _ in docs} - {d for d, _ in got}


def test_the_division_into_shards_changes_nothing(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    n = items.count()
    leaks = items.select((F.col("item_id") + 10**6).alias("doc_id"), F.concat(F.lit("before it "), "text", F.lit(" and after")).alias("text"))
    docs = docs.select("doc_id", "text").unionAll(leaks)
    again = items.unionAll(items.limit(5))  # items of one id, in different shards
    one, many = (sorted(decontamination.matches(docs, again, shard_items=k).collect()) for k in (10 * n, n // 3))
    assert one == many and len(one) >= n  # scores and overlaps too


def test_items_are_numbered_and_counted(spark):
    items = spark.createDataFrame([(i % 3, f"common w{i} w{i % 5} common") for i in range(40)] + [(None, "x"), (7, None), (8, " ?")], "item_id long, text string").repartition(7)
    counted, totals = decontamination._counted(items)
    assert totals == (40, 4.0, 4)
    assert sorted(r["number"] for r in counted.collect()) == list(range(40))
    assert {max(t["n"] for t in r["terms"]) for r in counted.collect()} == {40}
    assert decontamination._counted(items.limit(0))[1].items == 0


def test_verbatim_items_of_every_length_match(spark):
    rng = np.random.default_rng(3)
    words = [f"v{i}" for i in range(3000)]
    items = [(n, " ".join(rng.choice(words, n, replace=False))) for n in range(1, 41)]
    items += [(n + 100, " ".join(rng.choice(words, n - 1, replace=False)) + "? yes") for n in range(2, 41)]
    docs = [(i, f"{' '.join(rng.choice(WORDS, 50))} {t} {' '.join(rng.choice(WORDS, 30))}") for i, t in items]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(*frames).collect()}
    assert {(i, i) for i, _ in items} - got == set()


def edited(words, rng, kind):
    """One word replaced, left out or put in."""
    at = int(rng.integers(0, len(words)))
    return words[:at] + {0: ["edited"], 1: [], 2: ["edited", words[at]]}[kind] + words[at + 1 :]


def test_one_edit_hides_no_item(spark):
    rng = np.random.default_rng(5)
    words = [f"v{i}" for i in range(3000)]
    items = [(n, list(rng.choice(words, n, replace=False))) for n in range(5, 61)]
    filler = lambda n: " ".join(rng.choice(WORDS, n))
    docs, wanted = [], set()
    for n, x in items:
        for k in range(6):
            docs.append((len(docs), f"{filler(50)} {' '.join(edited(x, rng, k % 3))} {filler(30)}"))
            wanted.add((docs[-1][0], n))
        if n >= 10:  # half of the answer, or its words in other places, are not the item
            at = decontamination._split(" ".join(x), np.arange(n))
            docs.append((len(docs), f"{filler(40)} {' '.join(x[: (at + n) // 2])} {filler(30)}"))
            mixed = " ".join(f"{w} {filler(1)}" for w in rng.permutation(x))
            docs.append((len(docs), f"{filler(10)} {mixed} {filler(10)}"))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(n, " ".join(x)) for n, x in items], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.matches(*frames).collect()} == wanted


def test_edits():
    rng = np.random.default_rng(6)
    for _ in range(200):
        part, words = rng.integers(0, 4, rng.integers(1, 7)), rng.integers(0, 4, rng.integers(0, 9))
        rows = [[0] * (len(words) + 1)]
        for i, p in enumerate(part, 1):
            rows.append([i])
            for j, w in enumerate(words, 1):
                rows[i].append(min(rows[i - 1][j - 1] + (p != w), rows[i - 1][j] + 1, rows[i][j - 1] + 1))
        assert decontamination.edits(part, words) == min(rows[-1])


def test_decontamination_edge_cases(spark, messy, empty):
    items = spark.createDataFrame([(1, "one two three four five six seven"), (None, "b"), (1, "a"), (2, None)], "item_id long, text string")
    pairs = decontamination.matches(messy, items)
    assert {(r["doc_id"], r["item_id"]) for r in pairs.collect()} >= {(4, 1), (5, 1), (None, 1), (10, 1)}
    kept = decontamination.decontaminate(messy, items)
    assert kept.columns == messy.columns and kept.count() == len([t for _, t in MESSY if not t or "one two" not in t and t != "a"])
    assert decontamination.matches(empty, items).count() == 0
    assert decontamination.decontaminate(messy, items.limit(0)).count() == len(MESSY)
