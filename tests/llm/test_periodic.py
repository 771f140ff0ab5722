"""Periodic runs against brute force over all periods, the query against a plain version, odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from arrivalgate.llm import periodic
from arrivalgate.llm.queries import op12_periodic_runs

SF = "/root/testdata/sf0.001"


def brute(words, least=2, factor=2):
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        s = 0
        while s + p < n:
            if words[s] != words[s + p]:
                s += 1
                continue
            e = s
            while e + p < n and words[e] == words[e + p]:
                e += 1
            if e + p - s >= 2 * p:
                best.setdefault((s, e + p - s), p)      # the smallest period of the stretch comes first
            s = e + 1
    got = [(s, length, p) for (s, length), p in best.items() if length >= max(least, factor * p)]
    return sorted(got, key=lambda r: (r[0], r[2]))


def check(words):
    assert [tuple(r) for r in periodic.runs(np.array(words, np.int64)).tolist()] == brute(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 1), min_size=1, max_size=7), st.integers(1, 6)), max_size=8))
def test_runs_of_repeated_pieces(pieces):
    check([w for piece, times in pieces for w in piece * times])


def test_runs_of_hard_words():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    check(b)
    rng = random.Random(5)
    for n in (0, 1, 2, 11, 12, 13, 200):
        check([rng.randrange(2) for _ in range(n)])
    for cut in range(1, 40, 3):       # one periodic stretch in two phases: squares with many periods
        check(([0, 0, 1] * 14)[:cut] + [0, 0, 1] * 13)
    check([7] * 257)


def test_separators_part_texts():
    got = periodic.runs(np.array([1, 2, 1, 2, -1, 1, 2, -1, 5, 5, -1]))
    assert got.tolist() == [[0, 4, 2], [8, 2, 1]]


def plain_rows(docs):
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words, 12)
        out = {i for s, length, q in runs for i in range(s + q, s + length)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        yield (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
               hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
               hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in out).encode()).hexdigest())


def test_query_against_plain_version(spark, tmp_path):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = [(i, t if len(t) < 12_000 else t[:12_000]) for i, t in docs]       # the plain version is quadratic
    docs += [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "a b " * 40), (9005, "a b c " * 9 + "x " * 30), (None, "w " * 12), (9004, "a b " * 40),
             (9006, "é é " * 12), (9007, "x\r\nx\x0bx\x0cx " * 5)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect())))
    assert got == sorted(map(str, plain_rows(docs)))
    assert sum(1 for r in plain_rows(docs) if r[1]) > 20


def test_interface(spark):
    docs = spark.createDataFrame([(1, "a b a b a b x y x y x y", "old", "c"), (2, None, "old", "c"), (3, "k " * 150_000, "old", "c")],
                                 "doc_id long, text string, runs string, collapsed string")
    got = {r["doc_id"]: r for r in periodic.find_runs(docs, least=4, factor=3).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 6, 2), (6, 6, 2)] and got[1]["collapsed"] == "a b x y"
    assert got[2]["runs"] == [] and got[2]["collapsed"] == ""
    assert [tuple(r) for r in got[3]["runs"]] == [(0, 150_000, 1)] and got[3]["collapsed"] == "k"
    assert periodic.find_runs(docs.where("doc_id < 0")).count() == 0
