"""Near duplicates against brute force on sets of word tuples."""

import random

import numpy as np
import pytest

from arrivalgate.llm import neardup, shingles
from arrivalgate.llm.common import Scratch


def sets_of(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(component, kept) of each row; rows without shingles stand alone."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    s = [sets_of(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if s[i] and d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(s[i]), least.get(find(i)) if s[i] else d) for i, (d, _) in enumerate(rows)]


def family(r, words, n, edits):
    base = [r.choice(words) for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = r.choice(words)
        out.append(" ".join(w))
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, kept string")
    got = neardup.near_duplicates(df, **options).collect()
    for x in got:
        assert x["kept"] == (x["doc_id"] is not None and x["doc_id"] == x["component_id"])
    key = lambda x: tuple((v is None, v or 0) for v in x)
    return sorted([(x["doc_id"], x["n_shingles"], x["component_id"]) for x in got], key=key), key


def test_against_brute_force(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for edits in (1, 3, 5, 8, 12):
        texts += family(r, words, 30, edits)
    passage = " ".join(r.choice(words) for _ in range(60))
    texts += [passage + " " + " ".join(r.choice(words) for _ in range(40)) for _ in range(40)]     # a passage many share
    texts += [None, "", " \t ", "one two", "One  TWO", "one two three", "É one two three four five", "é one two three four five"]
    texts += [texts[0]] * 20 + [" ".join(r.choice(words) for _ in range(20000))]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    got, key = run(spark, rows)
    want = sorted(brute(rows), key=key)
    # at the very threshold a link may miss the match count; none may be invented
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert sum(g != w for g, w in zip(got, want)) <= 1


def test_hub_groups_are_finished_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SHORT", 2)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    r = random.Random(8)
    rows = list(enumerate(family(r, [f"w{i}" for i in range(200)], 90, 9)))
    got, key = run(spark, rows)
    assert got == sorted(brute(rows), key=key)


def test_repeated_and_null_ids(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = [(5, a), (5, a), (None, a), (3, a), (7, b), (7, a), (None, "x y z x y z"), (None, None)]
    got, key = run(spark, rows)
    assert got == sorted(brute(rows), key=key)


def test_empty(spark):
    assert run(spark, [])[0] == []


def test_shingle_sets_of_odd_texts():
    texts = ["", "a", "a b c d e", "a b c d e a b c d e", "x" * 100000 + " y z", "\x0b\x0c\r\n a", "é" * 70 + " b", "A b C d E"]
    raw = [t.encode().lower() for t in texts]
    _, n = shingles.shingle_sets(raw)
    assert n.tolist() == [len(sets_of(t)) for t in texts]
    s, n = shingles.shingle_sets([raw[2], raw[7]])
    assert n.tolist() == [1, 1] and s[0] == s[1]
    assert shingles.signatures(np.zeros(0, np.uint64), np.zeros(2, np.int64), 8).tolist() == [[0] * 8] * 2


@pytest.mark.parametrize("share", [0.75, 0.9])
def test_signatures_estimate_similarity(share):
    r = np.random.default_rng(0)
    common = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    own = int(3000 * (1 - share) / share / 2)
    a, b = (np.sort(np.concatenate([common, r.integers(0, 1 << 63, own, dtype=np.uint64)])) for _ in range(2))
    g = shingles.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), 512)
    assert abs((g[0] == g[1]).mean() - share) < 0.06


def finished(sets, roots, spark, blocks=1):
    """Components after _finish of one hub group with these sets and roots."""
    held = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "cid long, s array<long>")
    members = spark.createDataFrame([(0, i, r) for i, r in enumerate(roots)], "hub long, cid long, root long")
    found = neardup._finish(members, Scratch(spark, "t-finish"), held, 75, -(-len(sets) // blocks)).collect()
    assert all((roots[r["a"]], roots[r["b"]]) == (r["ra"], r["rb"]) for r in found)
    return {(r["a"], r["b"]) for r in found}


@pytest.mark.parametrize("blocks", [1, 3])
def test_hub_group_of_single_classes(spark, blocks):
    """No member is linked yet, so all components tie as the largest."""
    sets = [set(range(100 * i, 100 * i + 40)) for i in range(14)]
    sets[9] = set(sets[4]) | {5000}
    assert finished(sets, list(range(14)), spark, blocks) == {(4, 9)}


@pytest.mark.parametrize("blocks", [1, 2])
def test_hub_group_of_two_equal_components(spark, blocks):
    sets = [set(range(100 * i, 100 * i + 40)) for i in range(8)]
    sets[6] = set(sets[1]) | {5000}
    found = finished(sets, [0, 0, 0, 0, 4, 4, 4, 4], spark, blocks)
    assert found and all((a < 4) != (b < 4) for a, b in found)
    sets[7] = set(range(10000, 10040))
    assert finished(sets, [0, 0, 0, 4, 4, 4, 6, 7], spark, blocks) == {(1, 6)}


def test_finish_against_brute_force(spark):
    r = random.Random(5)
    for case in range(3):
        sets = [set(range(100 * (i % 9), 100 * (i % 9) + 30)) | {r.randrange(10 ** 6) for _ in range(r.randint(0, 8))} for i in range(40)]
        roots = [r.randrange(0, i % 9 + 1, 1) * 9 + i % 9 if i % 3 else i for i in range(40)]
        join = lambda links: _joined(40, links + [(i, roots.index(x)) for i, x in enumerate(roots)])
        want = [(i, j) for i in range(40) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        assert join(list(finished(sets, roots, spark, 1 + case))) == join(want)


def _joined(n, links):
    root = list(range(n))
    for a, b in links:
        x, y = root[a], root[b]
        root = [min(x, y) if v in (x, y) else v for v in root]
    return root


def test_components_of_parts(spark):
    """Contraction in one part, in several, and against a plain search."""
    from arrivalgate.llm.graph import components
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1080)] + [(5, 5)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for i in sorted(near):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = i
                todo += near[x]
    want = {i: r for i, r in want.items() if near[i] != {i}}
    scratch = Scratch(spark, "t-components")
    table = scratch.save(spark.createDataFrame(edges, "a long, b long").repartition(6), "edges")
    for n, per_task in enumerate((10**6, 40, 7)):
        assert {r["id"]: r["root"] for r in components(table, scratch, f"c{n}", per_task).collect()} == want
    assert components(table.where("a = 5 and b = 5"), scratch, "none").count() == 0


def test_stray_members_meet_the_largest_component(spark):
    """Variants of one template: a large component, strays that link to it or to each other only, and one that links with nothing."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]

    def variant(words, n):
        words = list(words)
        for i in rng.sample(range(0, len(words), 6), n):
            words[i] = f"x{rng.randrange(10**6)}"
        return " ".join(words)

    docs = [(i, variant(base, rng.choice([1, 2, 3]))) for i in range(40)]
    docs += [(100 + i, variant(base, rng.choice([4, 5, 6]))) for i in range(30)]
    docs += [(200 + i, variant(base, 9)) for i in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df).collect()}
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in docs)}
    comp = {i: i for i, _ in docs}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if comp[a] > comp[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    comp[a], changed = comp[b], True
    assert got == comp and len(set(comp.values())) > 3
