"""Tokens against the tokenizer library, places against the sequence limits."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from arrivalgate.llm import packing

PATH = public_tokenizers.path(packing.VOCABULARY)


def test_units_equal_the_whole_text():
    whole, units = Tokenizer.from_file(PATH), packing.UnitTokenizer(PATH)
    r = random.Random(2)
    bits = [" ", "  ", "\n", "\t", "a", "b's", "'ll", " 's", "é", "1", "23", "²", "_", "!", "\x1c", "\u00a0", "\u3000", "漢", "\u0301",
            "<|endoftext|>", ".\n", "🙂", "\r\n", "word", " word", "I'm"]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert np.frombuffer(units.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_plan_places_every_piece_as_plain_best_fit():
    r = random.Random(1)
    for _ in range(200):
        cap = r.choice([7, 20, 64])
        counts = {r.randint(1, cap): r.randint(1, 40) for _ in range(r.randint(1, 20))}
        seqs, got = {}, {}
        for length, first, n, b, per, off in packing.best_fit_plan(counts, cap):
            assert first == got.get(length, 0)
            got[length] = first + n
            for k in range(n):
                seqs.setdefault(b + k // per, []).append((off + k % per * length, length))
        assert got == counts
        for s in seqs.values():
            at = 0
            for off, length in sorted(s):
                assert off == at
                at += length
            assert at <= cap
        rooms = []
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fit = min((x for x in rooms if x >= length), default=None)
                if fit is not None:
                    rooms.remove(fit)
                rooms.append((cap if fit is None else fit) - length)
        assert len(seqs) == len(rooms)


def check(rows, docs, cap):
    whole = Tokenizer.from_file(PATH)
    by_doc = {}
    for d, t in docs:
        by_doc.setdefault(d, []).append(np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4"))
    seqs, seen = {}, {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        seen.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= cap
    want = {}
    for d, all_ids in by_doc.items():
        for ids in all_ids:
            first = len(ids) % cap or cap
            cuts = [0, *range(first, len(ids) + 1, cap)]
            want.setdefault(d, []).extend((i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert {d: sorted(x) for d, x in seen.items()} == {d: sorted(x) for d, x in want.items()}
    total = sum(n for s in seqs.values() for _, n in s)
    return len(seqs), -(-total // cap)


def test_documents(spark):
    r = random.Random(5)
    docs = [(i, " ".join(r.choice(["alpha", "beta", "gamma!", "naïve"]) for _ in range(r.randint(0, 90)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "x " * 900), (3, docs[3][1]), (None, "null id"), (None, "null id")]
    df = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, offset string")
    rows = packing.pack(packing.pieces(df, 64), 64).collect()
    used, least = check(rows, docs, 64)
    assert used <= least * 1.03 + 1
    direct = packing.pack_documents(df, 64).collect()
    assert check(direct, docs, 64) == (used, least) and set(direct[0].asDict()) == set(rows[0].asDict())
    full = packing.sequences(packing.pack_documents(df, 64)).collect()
    assert sum(len(x["ids"]) for x in full) == sum(x["length"] for x in rows) and max(len(x["ids"]) for x in full) <= 64


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(none)).collect() == []
    assert packing.pack_documents(none).collect() == []


@pytest.mark.parametrize("shift_tasks", [packing.SHIFT_TASKS, 0])
def test_hot_length(spark, shift_tasks):
    df = spark.createDataFrame([(i, 0, 10 if i % 3 else 7) for i in range(5000)], "doc_id long, piece int, length long")
    rows = packing.pack(df.repartition(7), 64, shift_tasks=shift_tasks).collect()
    ends = {}
    for x in sorted(rows, key=lambda x: (x["sequence_id"], x["offset"])):
        assert ends.get(x["sequence_id"], 0) == x["offset"]
        ends[x["sequence_id"]] = x["offset"] + x["length"]
    assert max(ends.values()) <= 64 and len(rows) == 5000
    assert {x["doc_id"] for x in rows} == set(range(5000))


def test_ranks_of_stored_rows_are_gapless(spark):
    r = random.Random(3)
    sizes = [r.choice([1, 5, 5, 5, 64, r.randint(1, 64)]) for _ in range(4000)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, length int").repartition(5)
    got = {}
    for x in packing.numbered(df, "length", 64).collect():
        got.setdefault((x["__part"], x["length"]), []).append(x["__nth"])
    assert all(sorted(v) == list(range(len(v))) for v in got.values()) and sum(map(len, got.values())) == 4000


def test_places_do_not_shuffle_the_ids(spark):
    df = spark.createDataFrame([(i, "alpha beta " * (i % 40)) for i in range(200)], "doc_id long, text string")
    plan = packing.pack(packing.pieces(df, 64), 64)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan     # over the sums per task and length
    physical = packing.pack(packing.pieces(df, 64), 64)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in physical and "ShuffledHashJoin" not in physical and physical.count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("bad", [None, 0, 65])
def test_lengths_out_of_range(spark, bad):
    df = spark.createDataFrame([(1, 3), (2, bad)], "doc_id long, length long")
    with pytest.raises(ValueError):
        packing.pack(df, 64)
