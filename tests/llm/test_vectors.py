"""Near-duplicate and nearest vectors against brute force in double precision."""

import numpy as np
import pytest

from arrivalgate.llm import ann, nndescent

ODD = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0] * 3]


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vectors(seed=1, dense=120):
    r = np.random.default_rng(seed)
    base = r.normal(size=(300, 16))
    near = [base[i] + r.normal(size=16) * 0.06 for i in range(40) for _ in range(3)]
    border = [base[i] + r.normal(size=16) * 0.33 for i in range(40, 120)]
    hot = [base[0] + r.normal(size=16) * 0.04 for _ in range(dense)]
    wide = [base[1] + r.normal(size=16) * 0.25 for _ in range(60)]
    same = [base[2]] * 30 + [base[2] * 5.0, base[3] * 1e-150, base[4] * 1e150]
    return [x.tolist() for x in np.concatenate([base, near, border, hot, wide, same])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<double>, kept string")


def brute_links(rows, threshold=0.95):
    """{position: (links, component)} where a position is a row."""
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([rows[i][1] for i in ok], float)
    x = unit(x / np.abs(x).max(axis=1, keepdims=True))
    near = x @ x.T >= threshold
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*np.nonzero(near)):
        p, q = find(ok[a]), find(ok[b])
        root[max(p, q)] = min(p, q)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    links = dict(zip(ok, near.sum(axis=1) - 1))
    return sorted(((d is None, d or 0), int(links.get(i, 0)), ids.get(find(i), -1)) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_links_against_brute_force(spark, seed):
    rows = list(enumerate(vectors(seed)))
    rows += [(2000 + i, v) for i, v in enumerate(ODD)] + [(5, rows[5][1]), (5, rows[200][1]), (None, rows[6][1])]
    got = nndescent.near_duplicates(frame(spark, rows)).collect()
    have = sorted(((g["vec_id"] is None, g["vec_id"] or 0), g["n_links"], -1 if g["component_id"] is None else g["component_id"]) for g in got)
    want = brute_links(rows)
    assert [h[0] for h in have] == [w[0] for w in want]
    assert sum(h[1] for h in have) >= 0.995 * sum(w[1] for w in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want))
    assert sum(h[1:] != w[1:] for h, w in zip(have, want)) <= 0.01 * len(want)
    for g in got:
        assert g["kept"] == (g["vec_id"] is not None and g["vec_id"] == g["component_id"])


def test_links_of_odd_tables(spark):
    assert nndescent.near_duplicates(frame(spark, [])).collect() == []
    got = nndescent.near_duplicates(frame(spark, [(i, v) for i, v in enumerate(ODD[:6])])).collect()
    assert sorted((g["vec_id"], g["n_links"], g["component_id"], g["kept"]) for g in got) == [(i, 0, i, True) for i in range(6)]
    got = nndescent.near_duplicates(frame(spark, [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0])])).collect()
    assert sorted((g["vec_id"], g["n_links"], g["component_id"]) for g in got) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def brute_nearest(rows, k=5, every=10):
    use = [(d, np.array(v, float)) for d, v in rows if d is not None and v is not None and len(v) == 16 and None not in v
           and np.isfinite(v).all() and any(v)]
    x = np.array([v for _, v in use])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    out = {}
    for i, (d, _) in enumerate(use):
        if d % every == 0:
            s = (x * x[i]).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((x[i] * x[i]).sum()))
            order = sorted((-s[j], use[j][0]) for j in range(len(use)) if j != i)
            out[d] = order[:k]
    return out


def test_nearest_against_brute_force(spark):
    rows = list(enumerate(vectors(3))) + [(5000 + 10 * i, v) for i, v in enumerate(ODD)] + [(None, vectors(3)[0])]
    got = ann.nearest(frame(spark, rows).withColumnRenamed("kept", "rank"), 5, 10, sample_rows=400, leaf_rows=8).collect()
    want = brute_nearest(rows)
    by = {}
    for g in got:
        by.setdefault(g["query_id"], []).append((g["rank"], g["vec_id"], g["score"]))
    assert set(by) == set(want)
    hit = 0
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 6))
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(found, found[1:]))
        truth = {d: -s for s, d in want[q]}
        hit += sum(f[1] in truth for f in found)
        assert all(abs(truth[f[1]] - f[2]) < 1e-12 for f in found if f[1] in truth)
    assert hit >= 0.9 * 5 * len(want)
    # equal vectors: ties go to the smaller ids
    copies = [i for i, (d, v) in enumerate(rows) if v == rows[2][1]]
    ties = [f for q, fs in by.items() if q in copies for f in fs]
    assert all(f[1] in copies for f in ties)


def test_nearest_of_odd_tables(spark):
    assert ann.nearest(frame(spark, [])).collect() == []
    assert ann.nearest(frame(spark, [(0, None), (50, [0.0, 0.0])])).collect() == []
    got = ann.nearest(frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])])).collect()
    assert [(g["query_id"], g["rank"], g["vec_id"]) for g in sorted(got, key=lambda g: g["rank"])] == [(0, 1, 1), (0, 2, 2)]
    hot = [(i, [1.0, 0.0]) for i in range(300)] + [(1000, [0.0, 1.0])]
    got = ann.nearest(frame(spark, hot), 5, 50).collect()
    assert [g["vec_id"] for g in sorted(got, key=lambda g: (g["query_id"], g["rank"])) if g["query_id"] == 50] == [0, 1, 2, 3, 4]
    assert len([g for g in got if g["query_id"] == 1000]) == 5


def test_nearest_where_a_third_of_the_rows_are_equal(spark):
    """Equal rows ask and answer as rows of their own, and are searched once."""
    r = np.random.default_rng(11)
    x = np.concatenate([r.normal(size=(400, 16)), np.tile(r.normal(size=16), (300, 1)), r.normal(size=(100, 16))])
    x[20:30] = x[10:20]
    x[30:40] = 2 * x[10:20]
    rows = [(int(i), v.tolist()) for i, v in zip(r.permutation(len(x)), x)] + [(10, x[5].tolist()), (10, x[5].tolist())]
    got = {}
    for g in ann.nearest(frame(spark, rows), 5, 10, sample_rows=300, leaf_rows=8, recall=1.0).collect():
        got.setdefault(g["query_id"], []).append((g["rank"], g["vec_id"], g["score"]))
    u = unit(np.array([v for _, v in rows]))
    ids = np.array([i for i, _ in rows])
    hit = total = 0
    for q in np.flatnonzero(ids % 10 == 0):
        same = got[ids[q]]
        assert sorted(rank for rank, _, _ in same) == sorted(list(range(1, 6)) * (ids == ids[q]).sum())
        if (ids == ids[q]).sum() == 1:
            sim = np.round(u @ u[q], 12)
            sim[q] = -3
            want = [int(ids[i]) for i in np.lexsort((ids, -sim))[:5]]
            have = [(i, s) for _, i, s in sorted(same)]
            assert have == sorted(have, key=lambda h: (-h[1], h[0]))
            hit += len(set(want) & {i for i, _ in have})
            total += 5
            if 400 <= q < 700:
                assert [i for i, _ in have] == want and all(abs(s - 1) < 1e-12 for _, s in have)
    assert hit >= 0.97 * total


def _descended(spark, x, **options):
    """(u, v) found by the descent itself, at cosine 0.95."""
    df = spark.createDataFrame([(i, v.tolist(), 0.95 - nndescent.SLACK) for i, v in enumerate(unit(x))], "nid long, v array<double>, wide double")
    scratch = nndescent.Scratch(spark, "test-descend")
    codes = scratch.save(nndescent.sketched(df, x.shape[1]), "codes")
    got = nndescent.descend(df, codes, x.shape[1], len(x), 0.95, scratch, **options)
    return {(min(r["u"], r["v"]), max(r["u"], r["v"])) for r in got.select("u", "v").collect()}


def test_last_round_below_the_recall_is_completed(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(400, 16))
    x = np.concatenate([x, x + r.normal(size=x.shape) * 0.2])
    u = unit(x)
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(u @ u.T >= 0.95)) if a < b}
    assert len(want) > 100
    assert want <= _descended(spark, x, k=1, rounds=1)


def test_audit_is_enlarged_until_it_has_links(spark):
    r = np.random.default_rng(7)
    x = r.normal(size=(600, 16))
    x[500:510] = x[:10] * 1.5 + r.normal(size=(10, 16)) * 0.01
    slim = spark.createDataFrame([(i, v.astype(np.float16).tobytes(), 0.95) for i, v in enumerate(unit(x))], "nid long, h binary, wide double")
    got = nndescent._audit(slim, 16, 600, 20, nndescent.Scratch(spark, "test-audit"))
    assert {(g["u"], g["v"]) for g in got.collect()} >= {(i, 500 + i) for i in range(10)} | {(500 + i, i) for i in range(10)}


def test_tables_grow_with_the_prefix():
    assert nndescent.tables_for(1000, 0.95) == nndescent.TABLES < nndescent.tables_for(10 ** 7, 0.95) < nndescent.tables_for(10 ** 9, 0.95)


def test_every_length_is_compared_with_its_own(spark):
    r = np.random.default_rng(9)
    rows = [(0, [1.0, 2.0, 3.0])] + [(i, v.tolist()) for i, v in enumerate(r.normal(size=(60, 16)), 1)]
    rows += [(100 + i, rows[i][1]) for i in range(1, 31)] + [(200 + i, v.tolist()) for i, v in enumerate(r.normal(size=(20, 8)))]
    rows += [(300 + i, [2 * c for c in rows[91 + i][1]]) for i in range(5)]
    got = {g["vec_id"]: (g["n_links"], g["component_id"]) for g in nndescent.near_duplicates(frame(spark, rows)).collect()}
    assert len(got) == len(rows) and got[0] == (0, 0)
    assert all(got[100 + i] == (1, i) for i in range(1, 31)) and all(got[300 + i] == (1, 200 + i) for i in range(5))
    near = ann.nearest(frame(spark, rows), 5, 10).collect()
    size = {d: len(v) for d, v in rows}
    assert all(size[g["query_id"]] == size[g["vec_id"]] for g in near)
    assert {g["query_id"] for g in near} == {d for d, _ in rows if d and d % 10 == 0}
    assert {(g["query_id"], g["vec_id"]) for g in near if g["rank"] == 1} >= {(110, 10), (120, 20), (130, 30), (300, 200)}


def _partners(r, x, cos):
    away = r.normal(size=x.shape)
    away = unit(away - (away * x).sum(axis=1, keepdims=True) * x)
    return cos * x + np.sqrt(1 - cos * cos) * away


def test_rare_links_are_audited_without_comparing_all_with_all(spark, monkeypatch):
    r = np.random.default_rng(21)
    x = unit(r.normal(size=(5000, 32)))
    x[4980:] = _partners(r, x[:20], 0.96)
    asked, scan = [], nndescent._scan
    monkeypatch.setattr(nndescent, "_scan", lambda slim, queries, *a: asked.append(len(queries)) or scan(slim, queries, *a))
    got = _descended(spark, x)
    assert {(i, 4980 + i) for i in range(20)} <= got
    assert all(0 <= u < v < 5000 for u, v in got)       # planted vectors are not returned
    assert 0 < sum(asked) <= 2000


def test_sketches_are_added_until_the_audit_finds_the_links(spark):
    r = np.random.default_rng(22)
    x = unit(r.normal(size=(2500, 32)))
    x = np.concatenate([x, _partners(r, x, 0.951)])
    df = spark.createDataFrame([(i, v.tolist(), 0.95 - nndescent.SLACK) for i, v in enumerate(x)], "nid long, v array<double>, wide double")
    scratch = nndescent.Scratch(spark, "test-sketches")
    codes = scratch.save(nndescent.sketched(df, 32, 1), "codes")
    got = {(g["u"], g["v"]) for g in nndescent.descend(df, codes, 32, len(x), 0.95, scratch).collect()}
    assert sum((i, 2500 + i) in got for i in range(2500)) >= 0.985 * 2500


def test_class_larger_than_a_cell(spark):
    r = np.random.default_rng(23)
    centre = unit(r.normal(size=(2, 32)))
    x = np.concatenate([r.normal(size=(1500, 32)), centre[0] + r.normal(size=(2400, 32)) * 0.022, centre[1] + r.normal(size=(60, 32)) * 0.03])
    x = np.concatenate([x, x[1490:1510]])
    order = r.permutation(len(x))
    assert len(x) > nndescent.CELL
    got = {g["vec_id"]: g for g in nndescent.near_duplicates(frame(spark, [(int(i), x[j].tolist()) for i, j in enumerate(order)])).collect()}
    u = unit(x[order])
    want = (u @ u.T >= 0.95).sum(axis=1) - 1
    have = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (have <= want).all() and have.sum() >= 0.998 * want.sum() and (have != want).sum() <= 0.01 * len(x)
    big = np.flatnonzero((order >= 1500) & (order < 3900))
    assert {got[i]["component_id"] for i in big} == {min(big.min(), *np.flatnonzero(order >= 3970))}
