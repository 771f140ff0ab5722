"""Appends exactly once: repeated and failed cycles leave each row once, streams too."""

import os

import pytest

from arrivalgate.session import ensure_checkpoint_dir
from arrivalgate.sources.once import AppendOnce, stream_once

SCHEMA = "kind string, regionname string, body string"


def _messages(spark, n, tag="m"):
    return spark.createDataFrame([("delay", "EMEA", f"{tag}{i}") for i in range(n)], SCHEMA)


def _bodies(table):
    got = table.read()
    return [] if got is None else sorted((r["run"], r["batch"], r["body"]) for r in got.collect())


def test_repeats_and_failures(spark, scratch):
    table = AppendOnce(spark, os.path.join(scratch, "notes"))
    assert table.read() is None
    assert table.append(_messages(spark, 3), "cycle-1", 0)
    once = _bodies(table)
    assert [b for _, _, b in once] == ["m0", "m1", "m2"]
    assert not table.append(_messages(spark, 5, "again"), "cycle-1", 0)          # the same cycle once more
    assert _bodies(table) == once
    # a cycle that died between its rows and its commit: not read, then written whole
    _messages(spark, 4, "half").write.parquet(f"{table.base}/data/run=cycle-1/batch=000000000001")
    assert _bodies(table) == once
    assert table.append(_messages(spark, 2, "whole"), "cycle-1", 1)
    assert _bodies(table) == once + [("cycle-1", 1, "whole0"), ("cycle-1", 1, "whole1")]
    assert table.append(_messages(spark, 0), "cycle-2", 0) and table.batches() == [("cycle-1", 0), ("cycle-1", 1), ("cycle-2", 0)]
    assert len(_bodies(table)) == 5
    with pytest.raises(ValueError, match="name of a run"):
        table.append(_messages(spark, 1), "../x", 0)


def test_a_task_that_fails_leaves_nothing(spark, scratch):
    table = AppendOnce(spark, os.path.join(scratch, "notes"))
    bad = _messages(spark, 3).selectExpr("kind", "regionname", "if(body = 'm2', raise_error('no'), body) as body")
    with pytest.raises(Exception, match="no"):
        table.append(bad, "r", 0)
    assert table.read() is None and table.append(_messages(spark, 3), "r", 0) and len(_bodies(table)) == 3


def test_stream_replay(spark, scratch):
    table, src = AppendOnce(spark, os.path.join(scratch, "notes")), os.path.join(scratch, "src")
    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams", "once-" + os.path.basename(scratch))
    run = lambda: stream_once(spark, spark.readStream.schema(SCHEMA).parquet(os.path.join(src, "*")), table, "s", ckpt).awaitTermination()
    for i in range(2):
        _messages(spark, 2, f"b{i}-").write.parquet(os.path.join(src, str(i)))
        run()
    once = _bodies(table)
    commits = os.path.join(ckpt.removeprefix("file:"), "commits")
    for f in os.listdir(commits):
        if f.strip(".").split(".")[0] == "1":
            os.remove(os.path.join(commits, f))
    run()
    assert _bodies(table) == once and len(once) == 4
