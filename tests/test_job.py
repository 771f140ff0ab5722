"""The trigger cycle job writes the same rows the registered queries compute."""

import os

from pyspark.sql import functions as F

from arrivalgate.plans import params as P
from arrivalgate.plans import queries as Q
from arrivalgate.plans.jobs import trigger_cycle
from arrivalgate.sources.fixtures import ControlTables

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_trigger_cycle(spark, scratch):
    ct = ControlTables(spark, SF)
    t = {"schedule": ct.d_schedule, "trigger_log": ct.d_trigger_log, "expected_files": ct.d_file_property,
         "load_log": ct.d_audit_log, "file_procs": ct.d_sp_map, "landing": Q.zones(ct),
         "dependency": ct.d_dependency, "job_runs": ct.d_job_runs}
    paths = trigger_cycle(t, ct.d_batch_dates, Q.gate_now(), os.path.join(scratch, "out"), 1, env=P.ENV, jobs=P.JOBS,
                          cutoff=P.CUTOFF, force_extra=P.FORCE_EXTRA, delay_window=P.DELAY_WINDOW,
                          metadata_prefix=P.FIXTURE_METADATA_PREFIX, empty_error=P.FIXTURE_EMPTY_ERROR)
    assert _rows(spark.read.parquet(paths["trigger_log"])) == _rows(Q.q27_merged_log(spark, SF))
    assert _rows(spark.read.parquet(paths["start_requests"])) == _rows(Q.q37_start_requests(spark, SF))
    notes = Q.q36_notifications(spark, SF).where(F.col("run_id").isNull())
    assert _rows(spark.read.parquet(paths["notifications"])) == _rows(notes)


def _job(spark, t, dates, scratch, **more):
    return trigger_cycle(t, dates, Q.gate_now(), os.path.join(scratch, "out"), 1, env=P.ENV, jobs=P.JOBS, cutoff=P.CUTOFF,
                         force_extra=P.FORCE_EXTRA, delay_window=P.DELAY_WINDOW, metadata_prefix=P.FIXTURE_METADATA_PREFIX,
                         empty_error=P.FIXTURE_EMPTY_ERROR, **more)


def _tables(ct):
    return {"schedule": ct.d_schedule, "trigger_log": ct.d_trigger_log, "expected_files": ct.d_file_property,
            "load_log": ct.d_audit_log, "file_procs": ct.d_sp_map, "landing": Q.zones(ct), "curated_ref": ct.d_curated_ref,
            "dependency": ct.d_dependency, "job_runs": ct.d_job_runs, "report_master": ct.d_report_master}


def test_a_new_day_starts_on_an_empty_log(spark, scratch):
    """Only the given day is touched, and every scheduled region gets complete first rows."""
    ct = ControlTables(spark, SF)
    t = _tables(ct)
    t["trigger_log"] = t["trigger_log"].where("false")
    t["schedule"] = t["schedule"].where("regionname in ('ASIA', 'EUROPE')")
    dates = spark.sql("select date '2031-05-01' as batchrundate")
    paths = _job(spark, t, dates, scratch, today=P.TODAY, report_now=P.NOW)
    rows = spark.read.parquet(paths["trigger_log"]).collect()
    assert len(rows) == 4 and {(r.regionname, r.report_source) for r in rows} == {
        (x, y) for x in ("ASIA", "EUROPE") for y in ("BMT", "SPDST")}
    for r in rows:
        assert r.execution_status == "Yet to start" and r.gluejob == P.JOBS[r.report_source]
        assert r.expected_start_time is not None and r.expected_end_time is not None
    assert spark.read.parquet(paths["start_requests"]).count() == 0
    assert spark.read.parquet(paths["report_master"]).count() == t["report_master"].count()


def test_other_days_are_left_alone(spark, scratch):
    ct = ControlTables(spark, SF)
    t = _tables(ct)
    day = ct.d_batch_dates.agg(F.max("batchrundate").alias("batchrundate"))
    paths = _job(spark, t, day, scratch, spdst_rule="legacy", legacy_delay_window=P.LEGACY_DELAY_WINDOW,
                 legacy_delay_step={"months": 1}, today=P.TODAY, report_now=P.NOW)
    d = day.first()[0]
    old = _rows(t["trigger_log"].where(F.col("batchrundate") != F.lit(d)))
    new = spark.read.parquet(paths["trigger_log"])
    assert new.columns == t["trigger_log"].columns
    assert _rows(new.where(F.col("batchrundate") != F.lit(d))) == old
    notes = Q.q43_legacy_alerts(spark, SF).where(F.col("batchrundate") == F.lit(d))
    legacy = spark.read.parquet(paths["notifications"]).where("subject like '%SPDST%'")
    assert _rows(legacy) == _rows(notes)


def test_refuses_to_overwrite_its_input(spark, scratch):
    import pytest
    ct = ControlTables(spark, SF)
    t = _tables(ct)
    path = os.path.join(scratch, "out", "trigger_log", "v=000000000001")
    t["trigger_log"].write.parquet(path)
    t["trigger_log"] = spark.read.parquet(path)
    with pytest.raises(ValueError, match="read from"):
        _job(spark, t, ct.d_batch_dates, scratch, today=P.TODAY, report_now=P.NOW)


def test_cycle_on_kept_tables_equals_the_full_one(spark, scratch):
    """The load log's facts from the state, the trigger log by date: same outputs, and a repeated cycle changes nothing."""
    from arrivalgate.operators.loadstate import LoadState
    from arrivalgate.sources.dated import DatedTable
    ct = ControlTables(spark, SF)
    t = _tables(ct)
    dates = ct.d_batch_dates.orderBy(F.col("batchrundate").desc()).limit(5)
    full = _job(spark, t, dates, os.path.join(scratch, "full"), today=P.TODAY, report_now=P.NOW)
    state, log = LoadState(spark, os.path.join(scratch, "state"), P.FIXTURE_EMPTY_ERROR), DatedTable(spark, os.path.join(scratch, "log"))
    half = F.pmod(F.xxhash64(*ct.d_audit_log.columns), F.lit(2)) == 0
    state.advance(ct.d_audit_log.where(half), 0)
    state.advance(ct.d_audit_log.where(~half), 1)
    log.replace(ct.d_trigger_log, 0)
    kept = {k: v for k, v in t.items() if k not in ("load_log", "trigger_log")}
    before = set(log.read().inputFiles())
    for _ in range(2):
        got = _job(spark, kept, dates, os.path.join(scratch, "kept"), today=P.TODAY, report_now=P.NOW, load_state=state, log_table=log)
        for kind in ("decisions", "start_requests", "notifications", "report_master"):
            assert _rows(spark.read.parquet(got[kind])) == _rows(spark.read.parquet(full[kind])), kind
        assert _rows(log.read()) == _rows(spark.read.parquet(full["trigger_log"]))
        assert log.versions() == [0, 1]
    new = {f for f in log.read().inputFiles() if f not in before}
    assert {f.split("batchrundate=")[1][:10] for f in new} == {str(r[0]) for r in dates.collect()}


def test_a_repeated_cycle_sends_each_message_once(spark, scratch, monkeypatch):
    """A cycle that fails after its messages and before its log, and is run again."""
    from arrivalgate.sources.dated import DatedTable
    from arrivalgate.sources.once import AppendOnce
    ct = ControlTables(spark, SF)
    t = _tables(ct)
    dates = ct.d_batch_dates.orderBy(F.col("batchrundate").desc()).limit(12)
    full = _job(spark, t, dates, os.path.join(scratch, "full"), today=P.TODAY, report_now=P.NOW)
    log = DatedTable(spark, os.path.join(scratch, "log"))
    log.replace(ct.d_trigger_log, 0)
    notes, starts = (AppendOnce(spark, os.path.join(scratch, k)) for k in ("notes", "starts"))
    run = lambda: _job(spark, {k: v for k, v in t.items() if k != "trigger_log"}, dates, os.path.join(scratch, "kept"), today=P.TODAY,
                       report_now=P.NOW, log_table=log, messages=notes, requests=starts)
    update = DatedTable.update
    monkeypatch.setattr(DatedTable, "update", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    try:
        run()
    except RuntimeError:
        pass
    monkeypatch.setattr(DatedTable, "update", update)
    assert log.versions() == [0] and notes.batches() == [("cycle", 1)]
    for _ in range(2):
        run()
        assert log.versions() == [0, 1] and _rows(log.read()) == _rows(spark.read.parquet(full["trigger_log"]))
        for table, kind in ((notes, "notifications"), (starts, "start_requests")):
            want = spark.read.parquet(full[kind])
            assert _rows(table.read().select(*want.columns)) == _rows(want)
    assert notes.read().count() > 0


def test_legacy_cycle_on_curated_tables_of_their_own(spark, scratch):
    from arrivalgate.sources.named import NamedTables, in_folder
    ct = ControlTables(spark, SF)
    t = _tables(ct)
    more = {"spdst_rule": "legacy", "legacy_delay_window": P.LEGACY_DELAY_WINDOW, "legacy_delay_step": {"months": 1}, "today": P.TODAY, "report_now": P.NOW}
    one = _job(spark, t, ct.d_batch_dates, os.path.join(scratch, "one"), **more)
    tables = NamedTables(spark, in_folder(spark, ct.folders_of("d_curated_ref", "table_name"), "table_name="))
    own = _job(spark, {k: v for k, v in t.items() if k != "curated_ref"}, ct.d_batch_dates, os.path.join(scratch, "own"), curated_tables=tables, **more)
    for kind in one:
        assert _rows(spark.read.parquet(own[kind])) == _rows(spark.read.parquet(one[kind])), kind
    legacy = spark.read.parquet(own["decisions"]).where("report_source = 'SPDST'")
    assert _rows(legacy) == _rows(Q.q26_decide_legacy(spark, SF).select(*legacy.columns))
