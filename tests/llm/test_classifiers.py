"""Held-out accuracy, odd rows, and models against plain computations."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrivalgate.llm import langid, quality, toxicity

SF = "/root/testdata/sf0.01"


def corpus(n=600, seed=1):
    r = random.Random(seed)
    say = lambda k: " ".join("".join(r.choice("aeioubdfglmnprst") for _ in range(r.randint(2, 7))) for _ in range(k))
    docs, labels = [], []
    for i in range(n):
        text = say(r.randint(5, 60))
        toxic, good = i % 6 == 0, i % 5 != 0
        if toxic:
            text = text + " " + r.choice(["zkrotten fool", "zkvile fool", "zkawful fool"]) + " " + say(4)
        if not good:
            text = text.upper().replace(" ", "!! ")
        docs.append((i, text, "x", "y"))
        labels.append((i, int(good), int(toxic)))
    docs += [(n, None, "x", "y"), (n + 1, "", "x", "y"), (n + 2, "fool " * 30000, "x", "y"), (None, "abc", "x", "y"), (3, docs[3][1], "x", "y")]
    labels += [(None, 1, 0), (n, 1, None), (n + 7, 0, 1)]
    return docs, labels


def frames(spark):
    docs, labels = corpus()
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, labels)


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def accuracy(got, truth, threshold):
    rows = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    for r in got:
        assert r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    return sum(r["predicted"] == truth[r["doc_id"]] for r in rows) / len(rows)


def test_toxicity(spark):
    df, labels, docs, rows = frames(spark)
    got = toxicity.classify(df, labels).collect()
    assert len(got) == len(docs)
    assert accuracy(got, {i: t for i, _, t in rows if i is not None and t is not None}, 0.5) > 0.95
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by[3]) == 1 and by[600] == by[601]


def test_toxicity_without_labels(spark):
    df, labels, _, _ = frames(spark)
    scores = {r["score"] for r in toxicity.classify(df, labels.where("false")).collect()}
    assert scores == {0.5}
    assert toxicity.classify(df.where("false"), labels).collect() == []


def test_machine_is_the_factorization_formula():
    keys = np.array(sorted({t for w in ("bad", "group", "insult") for t in toxicity.word_terms(w)}))
    r = np.random.default_rng(0)
    m = toxicity.Machine(keys, r.normal(size=len(keys)), r.normal(size=(len(keys), 3)), -0.5)
    on = [list(keys).index(t) for t in toxicity.terms("Insult, insult the group! other")if t in set(keys.tolist())]
    z = m.b + m.w[on].sum() + sum(m.v[a] @ m.v[b] for i, a in enumerate(on) for b in on[:i])
    assert abs(m.score("Insult, insult the group! other") - 1 / (1 + np.exp(-z))) < 1e-12


def test_pairs_beyond_additive_weights():
    """An insult counts only together with a group mention: no additive rule separates these."""
    r = np.random.default_rng(3)
    words = [f"w{chr(97 + i)}{chr(97 + j)}q" for i in range(10) for j in range(10)]
    texts, y = [], []
    for _ in range(800):
        a, b = r.random() < 0.5, r.random() < 0.5
        texts.append(" ".join([*r.choice(words, 6), *(["insultz"] if a else []), *(["groupz"] if b else [])]))
        y.append(float(a and b))
    t = [toxicity.terms(x) for x in texts]
    term, ends, y = np.concatenate(t).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in t])]), np.array(y)
    keys = np.unique(term)
    w, v, b = toxicity._train(term, ends, y, keys, 4, 12, 0.0, 1e-4, 1.0)
    m = toxicity.Machine(keys, w, v, b)
    assert np.mean([(m.score(x) >= 0.5) == k for x, k in zip(texts, y)]) > 0.97


def test_quality(spark):
    df, labels, docs, rows = frames(spark)
    got = quality.classify(df, labels).collect()
    assert len(got) == len(docs)
    assert accuracy(got, {i: q for i, q, _ in rows if i is not None}, 0.3) > 0.97
    assert quality.classify(df.where("false"), labels).collect() == []
    assert len({r["score"] for r in quality.classify(df, labels.where("false")).collect()}) == 1


def test_rules_compile_to_the_same_scores(spark):
    docs, labels = corpus()
    x = np.array([quality.statistics(t or "") for _, t, _, _ in docs])
    y = np.array([dict((i, q) for i, q, _ in labels).get(i, 1) or 0 for i, *_ in docs], float)
    model = quality.learn(x, y)
    assert 0 < len(model.rules) < 200
    z = model.bias + sum(w * quality._holds(r, x) for r, w in zip(model.rules, model.weights))
    df = spark.createDataFrame([(t,) for _, t, _, _ in docs], "text string")
    got = [r["s"] for r in quality.with_statistics(df, "st", "text").select(model.column("st").alias("s")).collect()]
    assert np.allclose(sorted(got), sorted(1 / (1 + np.exp(-z))))


def test_statistics_are_finite():
    for t in ("", " ", "\n\n", "|", "A", "é" * 10, "a a a", "\x00\ud800"):
        s = quality.statistics(t)
        assert len(s) == len(quality.STATISTICS) and np.isfinite(s).all()


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", "en"), (-3, "12 34 !!", "fr"), (-4, "the", None), (-5, "漢字" * 40, None), (None, "a", None)],
                                "doc_id long, text string, lang string")
    got = langid.classify(docs.select("doc_id", "text", "lang").union(odd).withColumn("score", F.lit("x"))).collect()
    assert len(got) == docs.count() + 6
    rows = [r for r in got if r["held_out"] and r["lang"] and r["doc_id"] is not None and r["doc_id"] >= 0]
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert np.mean([r["accepted"] for r in rows]) > 0.99
    by = {r["doc_id"]: r for r in got}
    for i in (-1, -2, -3):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["accepted"]) == ("und", 0.0, False)
    assert by[-4]["lang_pred"] in ("en", "de", "fr", "es") and not by[-5]["accepted"]
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1) for r in got)


def test_language_without_training(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["accepted"]) for r in langid.classify(df).collect()} == {("und", False)}
    assert langid.classify(df.where("false")).collect() == []


def test_kneser_ney_sums_to_one():
    codes = [langid.encode(t) for t in ("banana bandana", "cabana ban", "an abba")]
    u, n = np.unique(np.concatenate([langid.grams(c) for c in codes]), return_counts=True)
    m = langid.Model(u, n)
    for context in ("    ", "bana", "zzzz", "anan"):
        h = 0
        for ch in context:
            h = (h << langid.BITS) | ord(ch)
        p = np.exp(m.log_probability((h << langid.BITS) | np.arange(1 << langid.BITS)))
        assert abs(p.sum() - 1) < 1e-4


def test_rare_language_beside_a_hot_one_keeps_its_grams(spark):
    r = random.Random(4)
    say = lambda letters, k: " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(k))
    hot = say("abcdefghimnorst", 100)
    hot = [(i, hot, "hot") for i in range(300)]
    rare = [(1000 + i, say("βγδκλμνπρστω", 12), "rare") for i in range(12)]
    df = spark.createDataFrame(hot + rare, "doc_id long, text string, lang string")
    got = langid.classify(df, max_grams=300).collect()
    assert {r["doc_id"] for r in got if r["lang_pred"] == "rare"} == {i for i, _, _ in rare}
    assert all(r["lang_pred"] == "hot" for r in got if r["doc_id"] < 1000)


def test_sliced_models_equal_whole_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120).where("lang is not null and text is not null")
    docs = spark.createDataFrame(docs.select("doc_id", "text", "lang").collect(), "doc_id long, text string, lang string")
    counts = langid.count_grams(docs, "lang", "text").toPandas()
    whole = {x: langid.Model(p["gram"].to_numpy(), p["n"].to_numpy()) for x, p in counts.groupby("lang")}
    texts = [r["text"] for r in docs.limit(20).collect()] + ["", "12", "漢字 漢字", "é", "qqzzxx " * 5]
    fitted = langid.fit(docs, folds=1, held_out=1, max_grams=5000)
    assert fitted.langs == sorted(whole) and len(fitted.model.slices) > 3
    h, n = fitted.model.entropies(texts)
    for i, t in enumerate(texts):
        g = langid.grams(langid.encode(t))
        assert n[i] == len(g)
        for j, x in enumerate(fitted.langs):
            assert abs(h[i, j] - (-whole[x].log_probability(g).mean() if len(g) else 0)) < 1e-5


def test_every_language_has_a_limit_of_its_own(spark):
    r = random.Random(6)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(2, 6)))
    docs = [(i, " ".join(word("abcdef") for _ in range(3)), "hot") for i in range(6000)]
    rare = [f"l{c:02d}" for c in range(12)]
    docs += [(10000 + 10 * c + i, " ".join(word([chr(0x400 + 8 * c + x) for x in range(8)]) for _ in range(20)), x) for c, x in enumerate(rare) for i in range(4)]
    held = [sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _, x in docs if x == y) for y in rare]
    assert min(held) > 0
    fitted = langid.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert fitted.langs == ["hot", *rare]
    h, _ = fitted.model.entropies([t for _, t, _ in docs])
    assert np.isfinite(fitted.limit).all()
    own = np.array([fitted.langs.index(x) for *_, x in docs])
    train = np.array([zlib.crc32(str(i).encode()) % 3 != 1 for i, *_ in docs])
    for j in range(1, len(fitted.langs)):
        assert abs(fitted.limit[j] - 1.5 * h[train & (own == j), j].max()) < 1e-9


@pytest.mark.parametrize("rule", ["insult and group", "insult and not group"])
def test_fit_learns_pairs(spark, rule):
    """Through the whole fit: a label that no single term decides, in texts of random words."""
    rng = random.Random(11)
    common = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)]
    docs, labels = [], []
    for i in range(1500):
        words = [rng.choice(common) for _ in range(6)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["zinsult"] * insult + ["qgroup"] * group
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(insult and (group if rule == "insult and group" else not group))))
    got = toxicity.classify(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in got if r["held_out"]]
    truth = dict(labels)
    assert len(held) > 200 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.95 * len(held)
