"""Tables stored by date: only touched dates are written, replays leave one version, streams restart."""

import datetime as dt
import os

import pytest

from arrivalgate.operators import gate as G
from arrivalgate.session import ensure_checkpoint_dir
from arrivalgate.sources import fs
from arrivalgate.sources.dated import DatedTable
from arrivalgate.streaming import streams as ST

SCHEMA = "regionname string, batchrundate date, report_source string, execution_status string, gluejob string"
PART = "batchrundate date, regionname string, report_source string, execution_status string"
D = [dt.date(2024, 1, d) for d in range(1, 8)]


def _log(spark):
    rows = [(r, d, s, "Yet to start", f"job-{s}") for d in D[:5] for r in ("A", "B") for s in ("BMT", "SPDST")]
    return spark.createDataFrame(rows + [("A", None, "BMT", "Delay", "none")], SCHEMA)


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def _files(table):
    return {f.split("/data/")[1] for f in table.read().inputFiles()}


def test_update_touches_only_its_dates(spark, scratch):
    table = DatedTable(spark, os.path.join(scratch, "log"))
    assert table.read() is None and table.versions() == []
    table.replace(_log(spark), 0)
    assert _rows(table.read()) == _rows(_log(spark)) and table.read().schema.names == _log(spark).schema.names
    before = _files(table)
    changes = spark.createDataFrame([(D[1], "A", "BMT", "Submitted"), (D[6], "C", "BMT", "Yet to start"), (D[3], "B", "SPDST", None)], PART)
    table.update(changes, G.merge_log, 1)
    assert _rows(table.read()) == _rows(G.merge_log(_log(spark), changes))
    after = _files(table)
    new = {f for f in after if f.startswith("v=000000000001/")}
    assert {f.split("/")[1] for f in new} == {f"batchrundate={d}" for d in (D[1], D[3], D[6])}
    assert after - new == {f for f in before if not any(f"batchrundate={d}/" in f for d in (D[1], D[3]))}
    assert _rows(table.read(version=0)) == _rows(_log(spark))              # the old version still reads as it was
    assert _rows(table.read([D[1], dt.date(1999, 1, 1)])) == _rows(G.merge_log(_log(spark), changes).where(f"batchrundate = date'{D[1]}'"))
    assert all(f"batchrundate={D[1]}" in f for f in table.read([D[1]]).inputFiles())
    assert table.read([dt.date(1999, 1, 1)]).count() == 0


def test_replays_and_failures(spark, scratch):
    table = DatedTable(spark, os.path.join(scratch, "log"))
    table.replace(_log(spark), 0)
    change = lambda state: spark.createDataFrame([(D[0], "A", "BMT", state)], PART)      # noqa: E731
    # a run that died after its data and before its commit
    change("Broken").write.partitionBy("batchrundate").parquet(f"{table.base}/data/v=000000000001")
    assert table.versions() == [0] and _rows(table.read()) == _rows(_log(spark))
    table.update(change("Submitted"), G.merge_log, 1)
    once = _rows(table.read())
    files = _files(table)
    table.update(change("Other"), G.merge_log, 1)           # a replay of a committed version
    assert _rows(table.read()) == once and _files(table) == files and table.versions() == [0, 1]
    with pytest.raises(ValueError, match="should not touch"):
        table.update(change("x"), lambda rows, ch: _log(spark), 2)
    assert table.versions() == [0, 1]
    table.update(change("gone"), lambda rows, ch: rows.where("false"), 3)       # a date that loses all its rows
    assert table.read([D[0]]).count() == 0 and table.read().count() == len(once) - 4
    assert table.read(version=1).count() == len(once)
    assert table.expire(1) > 0 and table.versions() == [3] and table.read().count() == len(once) - 4
    assert not fs.exists(spark, f"{table.base}/data/v=000000000000/batchrundate={D[0]}")


def test_first_update_and_new_columns(spark, scratch):
    table = DatedTable(spark, os.path.join(scratch, "log"))
    table.update(spark.createDataFrame([(D[0], "A", "BMT", "Submitted")], PART), G.merge_log, 0)
    more = spark.createDataFrame([(D[1], "A", "BMT", "Delay", "late")], PART + ", note string")
    table.update(more, G.merge_log, 1)
    assert {(r["batchrundate"], r["note"]) for r in table.read().collect()} == {(D[0], None), (D[1], "late")}


def test_stream_merges_by_date_and_restarts(spark, scratch):
    table, keys = DatedTable(spark, os.path.join(scratch, "log")), G.KEYS
    table.replace(_log(spark), 0)
    chdir, name = os.path.join(scratch, "changes"), "dated-" + os.path.basename(scratch)
    schema = PART + ", decided_at timestamp_ntz"
    at = lambda m: dt.datetime(2024, 1, 9, 12, m)      # noqa: E731
    drops = [[(D[0], "A", "BMT", "Delay", at(1)), (D[0], "A", "BMT", "Submitted", at(2))], [(D[0], "A", "BMT", "Finished", at(9)), (D[6], "Z", "BMT", "Delay", at(1))]]
    run = lambda: ST.merge_into_dates(spark, spark.readStream.schema(schema).parquet(os.path.join(chdir, "*")), table, G.merge_log, name, keys).awaitTermination()
    want = _log(spark)
    for i, rows in enumerate(drops):
        ch = spark.createDataFrame(rows, schema)
        ch.write.parquet(os.path.join(chdir, str(i)))
        run()
        want = G.merge_log(want, ST.newest_per_key(ch, keys))
        assert _rows(table.read()) == _rows(want) and table.versions() == list(range(i + 2))
    # the last batch is done again, as after a failure between its commit and the stream's
    commits = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "streams", name, "commits")
    for f in os.listdir(commits):
        if f.strip(".").split(".")[0] == "1":
            os.remove(os.path.join(commits, f))
    files = _files(table)
    run()
    assert table.versions() == [0, 1, 2] and _files(table) == files and _rows(table.read()) == _rows(want)
    assert sum(f.startswith("v=000000000000/") for f in files) >= 5        # untouched dates keep their first files
