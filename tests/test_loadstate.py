"""The load state equals the full fold whatever the order of arrival; replays and streams change nothing."""

import datetime as dt
import os
import random

from arrivalgate.operators import files as FS
from arrivalgate.operators.loadstate import LoadState, fact_rows, fold_rows, merge_states, stream_into

SCHEMA = ("batchrundate date, regionname string, filename string, processname string, executionstatus string, "
          "scriptpath string, sourcename string, errormessage string")
DAYS = [dt.date(2024, 2, d) for d in (1, 2, 3)]


def _log(n=400, seed=4):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)      # noqa: E731
    rows = [(pick(*DAYS), pick("A", "B"), pick("f1", "f2", "f3", None), pick(FS.CURATED, FS.PUBLISHED, FS.VALIDATION, None),
             pick(FS.SUCCEEDED, FS.FAILED, "Running", None), pick("p1", "p2", None), pick("x.dat", "x.csv", None),
             pick("list empty", "other", None)) for _ in range(n)]
    hot = (DAYS[0], "A", "f1", FS.CURATED, FS.FAILED, "p1", "x.dat", None)
    return rows + [hot] * (n // 2)


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def _same(spark, state, rows):
    log = spark.createDataFrame(rows, SCHEMA)
    assert _rows(fact_rows(state.facts())) == _rows(fact_rows(FS.load_facts(log, "list empty")))
    assert _rows(state.scripts()) == _rows(FS.published_scripts(log).where("stored_procedure_name is not null"))


def test_any_order_and_replays(spark, scratch):
    rows = _log()
    for seed in (1, 2):
        state = LoadState(spark, os.path.join(scratch, f"s{seed}"), "list empty")
        assert state.facts().count() == 0 and state.scripts().count() == 0
        random.Random(seed).shuffle(rows)
        parts = [rows[:50], rows[40:300], rows[300:]]            # the second repeats rows of the first
        for v, part in enumerate(parts):
            state.advance(spark.createDataFrame(part, SCHEMA), v)
            _same(spark, state, rows[:max(50, 300 * v) if v < 2 else None])
            state.advance(spark.createDataFrame([r[:4] + (FS.SUCCEEDED,) + r[5:] for r in rows], SCHEMA), v)     # a replay is not taken in
        _same(spark, state, rows)


def test_merge_folds_and_places_in_one_shuffle(spark, scratch):
    """Large dates are cut into parts, small and null ones stay whole; each key has one row, and none is shuffled twice."""
    log = spark.createDataFrame(_log() + [(None,) + r[1:] for r in _log(seed=9)], SCHEMA)
    for name, part in (("a", log.where("executionstatus = 'Failed'")), ("b", log.where("scriptpath is not null"))):
        fold_rows(part, "list empty").write.parquet(f"{scratch}/{name}")
    a, b = (spark.read.parquet(f"{scratch}/{x}") for x in "ab")
    whole = fold_rows(log.where("executionstatus = 'Failed' or scriptpath is not null"), "list empty")
    for per_task in (3, 1_000_000):
        got = merge_states(a, b, per_task)
        assert got.columns == whole.columns and _rows(got) == _rows(whole)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in x and "processname" in x for x in plan.splitlines()) == 0


def test_facts_of_some_files(spark, scratch):
    rows = _log()
    state = LoadState(spark, os.path.join(scratch, "s"), "list empty")
    state.advance(spark.createDataFrame(rows, SCHEMA), 0)
    files = spark.createDataFrame([("A", "f2"), ("B", "f2"), ("A", "gone")], "regionname string, filename string")
    some = spark.createDataFrame([r for r in rows if r[2] == "f2"], SCHEMA)
    assert _rows(fact_rows(state.facts(files=files))) == _rows(fact_rows(FS.load_facts(some, "list empty")))
    assert _rows(fact_rows(FS.load_facts(FS.of_files(spark.createDataFrame(rows, SCHEMA), files), "list empty"))) \
        == _rows(fact_rows(FS.load_facts(some, "list empty")))


def test_only_touched_dates_are_written(spark, scratch):
    state = LoadState(spark, os.path.join(scratch, "s"), "list empty")
    rows = _log()
    state.advance(spark.createDataFrame(rows, SCHEMA), 0)
    day = [r for r in _log(seed=8) if r[0] == DAYS[1]]
    state.advance(spark.createDataFrame(day, SCHEMA), 1)
    _same(spark, state, rows + day)
    files = state.read().inputFiles()
    assert all(("v=000000000001/" in f) == (str(DAYS[1]) in f) for f in files) and len({f.split("/")[-2] for f in files}) == 3
    assert {r["batchrundate"] for r in state.facts([DAYS[2]]).collect()} == {DAYS[2]}


def test_stream_restarts(spark, scratch):
    state, src, name = LoadState(spark, os.path.join(scratch, "s"), "list empty"), os.path.join(scratch, "log"), "ls-" + os.path.basename(scratch)
    rows = _log()
    for i, part in enumerate((rows[:200], rows[200:])):
        spark.createDataFrame(part, SCHEMA).write.parquet(os.path.join(src, str(i)))
        stream_into(spark.readStream.schema(SCHEMA).parquet(os.path.join(src, "*")), state, name).awaitTermination()
    _same(spark, state, rows)
    assert state.table.versions() == [0, 1]
