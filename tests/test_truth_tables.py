"""Every combination of the file-state inputs, and the decision chain, as
literal DataFrames checked against a direct reading of the rules."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from arrivalgate.operators import files as FS
from arrivalgate.operators import gate as G

KEY = "batchrundate date, regionname string, filename string"
D = dt.date(2024, 1, 15)


def expected_state(rule, pub, rec, failed, empty, pnd=False, ref_ok=False):
    if rule == "current":
        return "done" if pub and (rec or failed) else "missing"
    if rule == "legacy" and pub and pnd:
        return "done" if ref_ok else "failed"
    if pub or empty:
        return "done"
    if failed:
        return "failed"
    return "in_progress" if rec else "missing"


def test_file_state_truth_table(spark):
    combos = list(itertools.product([False, True], repeat=6))  # pub rec failed empty pnd ref_ok
    names = [f"F{i:03d}" + ("PND" if c[4] else "STD") for i, c in enumerate(combos)]
    exp = spark.createDataFrame([(D, "R", n) for n in names], KEY)
    pick = lambda j: spark.createDataFrame([(D, "R", n) for n, c in zip(names, combos) if c[j]], KEY)
    failed = spark.createDataFrame([(D, n, "P1") for n, c in zip(names, combos) if c[2]],
                                   "batchrundate date, filename string, failed_processes string")
    empty = spark.createDataFrame([(D, n) for n, c in zip(names, combos) if c[3]], "batchrundate date, filename string")
    refd = spark.createDataFrame([(D, "R", n, c[5]) for n, c in zip(names, combos) if c[4]], KEY + ", ref_ok boolean")
    for rule in ("current", "bmt", "legacy"):
        got = {r.filename: r.state for r in
               FS.file_state(exp, pick(0), pick(1), failed, empty, refd, rule).collect()}
        for n, c in zip(names, combos):
            want = expected_state(rule, c[0], c[1], c[2], c[3], c[4], c[5])
            assert got[n] == want, (rule, n, c)
        st = FS.readiness(FS.file_state(exp, pick(0), pick(1), failed, empty, refd, rule), rule).first()
        assert st.done + st.failed + st.in_progress + st.missing == st.expected == len(names)


def _decide(spark, rule, status, done, expected, busy=False, upstream=True, now="2024-01-15 12:45:00"):
    win = spark.createDataFrame([(D, "R", "BMT" if rule == "bmt" else "SPDST",
                                  dt.datetime(2024, 1, 15, 12, 0), dt.datetime(2024, 1, 15, 13, 0))],
                                "batchrundate date, regionname string, report_source string, "
                                "expected_start timestamp_ntz, expected_end timestamp_ntz")
    log = spark.createDataFrame([(D, "R", r.report_source, status) for r in win.collect() if status],
                                "batchrundate date, regionname string, report_source string, execution_status string")
    ready = spark.createDataFrame([(D, "R", expected, done, expected - done, "A,B", "A,B")],
                                  "batchrundate date, regionname string, expected bigint, done bigint, missing bigint, "
                                  "names string, missing_names string")
    busy_df = spark.createDataFrame([("R", busy)], "regionname string, busy boolean")
    up = spark.createDataFrame([(D, "R", upstream)], "batchrundate date, regionname string, upstream_finished boolean")
    now_c = F.lit(now).cast("timestamp_ntz")
    return G.decide(rule, win, log, ready, busy_df, None if rule == "bmt" else up, now_c,
                    (12, 30, 13, 0), (1, 0), (12, 40, 13, 20)).first()


def test_decision_chain(spark):
    r = _decide(spark, "current", None, 0, 2)
    assert (r.action, r.execution_status) == ("insert", "Yet to start")
    r = _decide(spark, "current", "Submitted", 0, 2)
    assert (r.action, r.execution_status) == ("none", "Submitted")
    r = _decide(spark, "current", "Delay", 0, 2, busy=True)
    assert (r.action, r.execution_status, r.error_message) == ("blocked", "Delay", G.MSG_BUSY)
    r = _decide(spark, "current", "Yet to start", 2, 2)
    assert (r.action, r.execution_status, r.error_message) == ("start", "Submitted", "NA")
    assert r.actual_start_time == dt.datetime(2024, 1, 15, 12, 45)
    r = _decide(spark, "current", "Yet to start", 1, 2)
    assert (r.action, r.error_message) == ("cutoff", "Cut off time Reached: Missing 1 files")
    r = _decide(spark, "current", "Yet to start", 1, 2, now="2024-01-15 12:10:00")
    assert (r.action, r.error_message) == ("pending", "Pending files: 1")
    # not past the expected start: no change of state
    r = _decide(spark, "current", "Yet to start", 1, 2, now="2024-01-15 11:10:00")
    assert (r.action, r.execution_status, r.error_message) == ("pending", "Yet to start", None)


def test_upstream_only_missing(spark):
    r = _decide(spark, "current", "Yet to start", 2, 2, upstream=False)
    assert (r.action, r.execution_status, r.error_message) == ("pending", "Delay", "Pending files: 0")


def test_bmt_forced_and_names(spark):
    r = _decide(spark, "bmt", "Yet to start", 0, 2, now="2024-01-15 13:35:00")
    assert (r.action, r.priority_files_received, r.error_message) == ("forced_start", "N", "NULL")
    r = _decide(spark, "bmt", "Yet to start", 2, 2)
    assert (r.action, r.priority_files_received) == ("start", "Y")
    r = _decide(spark, "bmt", "Yet to start", 1, 2)
    assert r.error_message == "Cut off time Reached and priority files not receivedA,B"
    r = _decide(spark, "legacy", "Yet to start", 1, 2, now="2024-01-15 12:10:00")
    assert r.error_message == "PF Missing A,B"


def test_empty_expected_is_ready(spark):
    r = _decide(spark, "legacy", "Yet to start", 0, 0)
    assert r.action == "start"
