"""Block-Max MaxScore against exhaustive scoring, its shards by themselves, and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from arrivalgate.llm import lexical


def plain(docs, queries, k):
    cut = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), t or "")) if w]
    words = [cut(t) for _, t in docs]
    n_docs, total = sum(1 for w in words if w), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    out = []
    for q, text in queries:
        got = []
        for (i, _), w in zip(docs, words):
            tf = Counter(w)
            m = 25 + (75 * len(w) * n_docs) // total if w else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                    for t in cut(text) if tf[t])
            if s > 0:
                got.append((-s, i is None, i or 0, i))
        got.sort(key=lambda r: r[:3])
        out += [(q, r, i, -s) for r, (s, _, _, i) in enumerate(got[:k], 1)]
    return out


def make(rng, docs, words=60):
    vocabulary = [f"w{int(x)}" for x in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 30, 200]))) for _ in range(docs)]
    return texts, [" ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 20]))) for _ in range(25)]


@pytest.mark.parametrize("block", [2, 4, 128])
def test_shards_are_exact_and_skip_blocks(monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK", block)
    rng = random.Random(block)
    texts, queries = make(rng, 700)
    words = [lexical.terms(t) for t in texts]
    vocabulary = {t: i for i, t in enumerate(sorted({w for q in queries for w in lexical.terms(q)}))}
    n_docs, total = len(words), sum(map(len, words))
    asked = unpacked = 0
    shards = []
    for a in range(0, 700, 350):
        ids, m, term, tf, held = [], [], [], [], []
        for i in range(a, a + 350):
            count = Counter(words[i])
            mine = vocabulary.keys() & count.keys()
            if mine:
                ids.append(i)
                m.append(lexical.length_norm(len(words[i]), n_docs, total))
                held.append(len(mine))
                term += [vocabulary[w] for w in mine]
                tf += [count[w] for w in mine]
        shards.append(lexical.Shard(next(lexical._shard(ids, m, term, tf, held).itertuples(index=False))))
    df, top = Counter(), Counter()
    for s in shards:
        for t, x in s.lists.items():
            df[t] += x.count
            top[t] = max(top[t], int(x.top.max()))
            assert len(x.unpack()[0]) == x.count and x.top.max() == x.unpack()[1].max()
            x.whole = None
    for qi, q in enumerate(queries):
        at = [(vocabulary[t], c * lexical.weight(n_docs, df[vocabulary[t]]), top[vocabulary[t]]) for t, c in Counter(lexical.terms(q)).items() if df[vocabulary[t]]]
        at = sorted(((t, w, w * b) for t, w, b in at if w > 0), key=lambda x: -x[2])
        bound = np.cumsum([b for *_, b in at][::-1])[::-1].tolist()
        heap = []
        for s in shards:
            got = s.best([(t, w, b) for (t, w, _), b in zip(at, bound)], 10, -heap[-1][0] if len(heap) == 10 else 1)
            heap = sorted(heap + got)[:10]
            asked += sum(1 for t, *_ in at if t in s.lists)
            unpacked += sum(1 for t, *_ in at if t in s.lists and s.lists[t].whole is not None)
            for x in s.lists.values():
                x.whole = None
        want = plain(list(enumerate(texts)), [(qi, q)], 10)
        assert [(qi, r, i, -sc) for r, (sc, _, i) in enumerate(heap, 1)] == want
    assert unpacked < asked


SCHEMA = "doc_id long, text string, rank int, score string, item_id int"


def test_search_on_odd_rows(spark):
    rng = random.Random(9)
    texts, queries = make(rng, 300)
    docs = list(enumerate(texts)) + [(900, None), (901, ""), (902, "--- !"), (903, "ÀÉ w1 Àé w2"), (None, texts[0]), (7, texts[7]), (7, texts[8]),
                                     (904, "w3 " * 60_000), (905, texts[5]), (906, texts[5].upper())]
    asked = list(enumerate(queries)) + [(100, None), (101, ""), (102, "unknown-term"), (3, "w4 W4 w4"), (3, queries[3]), (None, "w1"), (103, "Àé w2")]
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], SCHEMA).repartition(5)
    q = spark.createDataFrame([(i, t, "x") for i, t in asked], "item_id long, text string, doc_id string")
    want = sorted(map(str, plain(docs, asked, 10)))
    for options in ({}, {"query_rows": 8}):
        got = lexical.search(d, q, 10, **options)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert lexical.search(d.where("doc_id < 0"), q).count() == 0 == lexical.search(d, q.where("item_id < 0")).count()
