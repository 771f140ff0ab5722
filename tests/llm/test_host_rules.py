"""Host-level rules against a plain Python version, on odd rows, and along both joins."""

import random
import re

import pytest

from arrivalgate.llm import host_rules as H

SCHEMA = "doc_id long, text string, source string, host string, n_words int"


def plain(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = {w for w in wins if wins.count(w) > 1}
    covered = {i + d for i, w in enumerate(wins) if w in often for d in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), len(lines))


def corpus(seed=3):
    rng = random.Random(seed)
    alphabet = ["a", "b", "ccc", "d#", "é", "日本", "x y", "|", "q<"]
    texts = [None, "", " \t\n ", "one", "\n\n#\n#\n", "a b c d e f g h i j", "a b c d e " * 3, "x " * 30_000, "é" * 50_000, "a\r\nb\r\na\r\nb\r\n"]
    for _ in range(120):
        n = rng.choice([0, 3, 9, 10, 12, 40, 90])
        texts.append("".join(rng.choice(alphabet[:rng.choice([2, 4, 9])]) + rng.choice([" ", "\n", "  ", "\t", " \n"]) for _ in range(n)))
    return texts


def test_measures_match_plain_python(spark):
    texts = corpus()
    texts = [t if t is None or len(t) < 20_000 else t[:3000] for t in texts]      # the plain version is quadratic
    docs = spark.createDataFrame([(i, t, "s", "clash", -1) for i, t in enumerate(texts)], SCHEMA)
    for r in H.measure(docs).collect():
        assert tuple(r[c] for c in H.STATS) == plain(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_very_long_texts(spark):
    docs = spark.createDataFrame([(1, "x " * 200_000, "s", "", 0), (2, "é" * 500_000, "s", "", 0)], SCHEMA)
    got = {r["doc_id"]: r for r in H.measure(docs).collect()}
    assert got[1]["n_words"] == got[1]["n_repeat_words"] == 200_000 and got[2]["word_chars"] == 500_000 and got[2]["n_words"] == 1


def hosts_fixture(spark):
    rng = random.Random(1)
    good = " ".join(str(i) for i in range(30))
    rows, truth = [], {}
    for h in range(60):
        n, rate = rng.choice([1, 2, 5, 40]), rng.choice([0.02, 0.05, 0.1])
        if h in (7, 8):
            n, rate = 200, 0.9
        rows += [(len(rows) + i, "short" if rng.random() < rate else good + f" {h}", f"h{h}") for i in range(n)]
    rows += [(100_000, "short", "once")]                    # one bad document is no bad host
    rows += [(200_000 + i, good if i % 10 else "short", "hot") for i in range(1500)]
    rows += [(300_000, good, None), (300_001, None, None), (None, good, "h7"), (300_002, good, ""), (300_003, good, "h1"), (300_003, good, "h1")]
    return spark.createDataFrame([(i, t, s, "x", 0) for i, t, s in rows], SCHEMA), rows


@pytest.mark.parametrize("options", [{}, {"broadcast_hosts": 0, "hot_share": 20}, {"broadcast_hosts": 0, "hot_share": 1}])
def test_hosts(spark, options):
    docs, rows = hosts_fixture(spark)
    got = H.judge(docs, **options).collect()
    assert len(got) == len(rows)
    assert sorted((str(r["doc_id"]), str(r["host"])) for r in got) == sorted((str(i), str(s)) for i, _, s in rows)
    bad = {r["host"] for r in got if r["host_ok"] is False}
    assert bad == {"h7", "h8"}
    for r in got:
        assert r["kept"] == (not r["base_failed"] and r["host"] not in bad)
        if r["host"] is None:
            assert r["host_ok"] is None and r["host_docs"] is None
    once = next(r for r in got if r["host"] == "once")
    assert once["base_failed"] and once["host_ok"] and 0.05 < once["rate_base"] < 0.5       # shrunk from 1


def test_prior_recovers_beta():
    np = pytest.importorskip("numpy")
    rng = np.random.default_rng(0)
    p, n = rng.beta(2, 8, 20_000), rng.integers(1, 200, 20_000)
    x = rng.binomial(n, p)
    mean, strength = H.prior(len(n), int(n.sum()), float((n * n).sum()), int(x.sum()), float((x * x / n).sum()))
    assert abs(mean - 0.2) < 0.01 and abs(strength - 10) < 0.7
    x = rng.binomial(n, 0.2)        # hosts that differ by chance only
    assert H.prior(len(n), int(n.sum()), float((n * n).sum()), int(x.sum()), float((x * x / n).sum()))[1] > 500
    assert H.prior(0, 0, 0.0, 0, 0.0)[0] == 0.0
    assert H.prior(3, 30, 300.0, 30, 30.0)[0] == 1.0


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    out = H.judge(docs)
    assert out.count() == 0 and {"doc_id", "kept", "rate_base"} <= set(out.columns)


def test_native_plan(spark):
    docs, _ = hosts_fixture(spark)
    out = H.judge(docs)
    plan = out._jdf.queryExecution().toString() + H.measure(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("PythonRDD", "")) and "Cartesian" not in plan and "NestedLoop" not in plan
