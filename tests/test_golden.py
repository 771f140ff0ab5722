"""Golden cases taken from the sample values in the reference's comments."""

import re
import datetime as dt

from pyspark.sql import functions as F

from arrivalgate.functions import text as T
from arrivalgate.functions import timecols as TC
from arrivalgate.operators import runs as R
from arrivalgate.operators import schedule as S


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_window_end(spark):
    r = one(spark, s=TC.at_clock(F.lit("2022-07-05").cast("date"), F.lit("11:15:00")),
            e=TC.window_end(F.lit("2022-07-05").cast("date"), F.lit("11:15:00"), F.lit(55)))
    assert r.s == dt.datetime(2022, 7, 5, 11, 15) and r.e == dt.datetime(2022, 7, 5, 12, 10)


def test_window_wraps_same_date(spark):
    d = F.lit("2022-07-05").cast("date")
    r = one(spark, w=TC.window_end(d, F.lit("22:15:00"), F.lit(125)),
            t=TC.window_end(d, F.lit("22:15:00"), F.lit(125), wrap=False))
    assert r.w == dt.datetime(2022, 7, 5, 0, 20)
    assert r.t == dt.datetime(2022, 7, 6, 0, 20)


def test_cutoff_forms(spark):
    r = one(spark, a=TC.in_window(TC.ts_lit("2024-01-15 07:20:00"), 7, 15, 7, 59, form="fields"),
            b=TC.in_window(TC.ts_lit("2024-01-15 08:05:00"), 7, 50, 8, 10, form="fields"),
            c=TC.in_window(TC.ts_lit("2024-01-15 08:05:00"), 7, 50, 8, 10, form="clock"))
    assert r.a is True and r.b is False and r.c is True


def test_object_name_and_errors(spark):
    r = one(spark, n=T.landed_file_name(F.lit("LandingZone/dt=2024-01-15/FILE_A_20240115101500.dat")),
            s=T.error_second_part(F.lit("ERROR: relation 7: missing")),
            t=T.error_tail(F.lit("ERROR: relation 7: missing")),
            s2=T.error_second_part(F.lit("timeout")), t2=T.error_tail(F.lit("timeout")),
            names=T.comma_list(F.array(F.lit("B"), F.lit("A"))))
    assert r.n == "FILE_A"
    assert r.s == " relation 7" and r.t == " relation 7: missing"
    assert r.s2 == "timeout" and r.t2 == "timeout"
    assert r.names == "A,B"


def test_report_status_cases(spark):
    rows = [
        ("a", "Null", dt.datetime(2024, 1, 15, 1, 0), dt.datetime(2024, 1, 15, 13, 0)),
        ("b", "InProgress", dt.datetime(2024, 1, 15, 1, 0), dt.datetime(2024, 1, 15, 11, 0)),
        ("c", "Null", None, dt.datetime(2024, 1, 15, 13, 0)),
        ("d", None, dt.datetime(2024, 1, 15, 1, 0), dt.datetime(2024, 1, 15, 13, 0)),
        ("e", "Completed", dt.datetime(2024, 1, 15, 1, 0), dt.datetime(2024, 1, 15, 11, 0)),
        ("f", "Null", dt.datetime(2024, 1, 14, 1, 0), dt.datetime(2024, 1, 15, 13, 0)),
    ]
    df = spark.createDataFrame(rows, "report_name string, status string, actual_start_time timestamp_ntz, "
                                     "expected_start timestamp_ntz")
    got = {r.report_name: r.status for r in S.report_status(df, "2024-01-15 12:00:00").collect()}
    assert got == {"a": "Yet to start", "b": "Delay", "c": "Null", "d": "None", "e": "Completed", "f": "Null"}


def _plan(spark, rows):
    df = spark.createDataFrame(
        [(1, str(5 * (i + 1)), f"SP_{i}", src, "Y", st, err) for i, (src, st, err) in enumerate(rows)],
        "run_id bigint, exec_order string, stored_procedure_name string, file_datasource string, "
        "codebase string, status string, error string")
    return R.plan_order(df)


def _outcomes(spark, rows, halt):
    out = R.step_outcomes(_plan(spark, rows), halt).orderBy("order_key").collect()
    return [r.outcome for r in out]


def test_halt_strict(spark):
    rows = [("OTHER", "FINISHED", None), ("OTHER", "FAILED", "E: x"), ("OTHER", "FINISHED", None)]
    assert _outcomes(spark, rows, "strict") == ["Completed", "Failed", "Skipped"]


def test_halt_critical(spark):
    rows = [("OTHER", "FAILED", "E: a"), ("SPDST", "FINISHED", None), ("SPDST", "FAILED", "E: b"),
            ("OTHER", "FINISHED", None)]
    assert _outcomes(spark, rows, "critical") == ["Failed", "Completed", "Failed", "Skipped"]


def test_aborted_is_success(spark):
    assert _outcomes(spark, [("OTHER", "ABORTED", None)], "strict") == ["Completed"]


def test_run_outcome_texts(spark):
    p = _plan(spark, [("OTHER", "FINISHED", None), ("SPDST", "FAILED", "ERROR: relation 7: missing")])
    strict = R.run_outcome(R.step_outcomes(p, "strict"), "strict").first()
    assert (strict.execution_status, strict.report_status, strict.error_message) == \
        ("Failed", "Failed", " relation 7: missing")
    crit = R.run_outcome(R.step_outcomes(p, "critical"), "critical").first()
    assert (crit.report_status, crit.error_message) == ("Failed", " relation 7")
    ok = R.run_outcome(R.step_outcomes(_plan(spark, [("OTHER", "FINISHED", None)]), "strict"), "strict").first()
    assert (ok.execution_status, ok.report_status, ok.error_message) == ("Finished", "Completed", "Null")


def test_retry_fold_limit_3(spark):
    t = dt.datetime(2024, 1, 15, 10, 0)
    rows = [(1, dt.date(2024, 1, 15), t + dt.timedelta(minutes=i), i, st)
            for i, st in enumerate(["FAILED", "FAILED", "FINISHED", "FAILED"])]
    df = spark.createDataFrame(rows, "step_id bigint, batchrundate date, started timestamp_ntz, seq bigint, status string")
    r = R.fold_attempts(df, 3).first()
    assert (r.final_state, r.attempts_used, r.attempts_recorded) == ("Completed", 3, 4)
    r2 = R.fold_attempts(df, 2).first()
    assert (r2.final_state, r2.attempts_used) == ("Failed", 2)


def test_duplicate_order_keys(spark):
    df = spark.createDataFrame([(1, "5", "SP_B", "X", "Y", "FINISHED", None), (1, "5.0", "SP_A", "X", "Y", "FAILED", "e"),
                                (1, "x", "SP_C", "X", "Y", "FINISHED", None), (1, "10", "SP_D", "X", "Y", "FINISHED", None)],
                               "run_id bigint, exec_order string, stored_procedure_name string, file_datasource string, "
                               "codebase string, status string, error string")
    rows = R.plan_order(df).orderBy("pos").collect()
    assert [r.stored_procedure_name for r in rows] == ["SP_A", "SP_D", "SP_C"]
    assert [r.duplicate_keys for r in rows] == [2, 1, 1]


def test_select_plan_and_text_order(spark):
    df = spark.createDataFrame([(1, "10", "SP_A", "BMT", "Y", "FINISHED", None), (1, "9", "SP_B", "BMT", "N", "FINISHED", None),
                                (1, "2", "SP_C", "SPDST", "Y", "FINISHED", None), (1, "1", "SP_D", None, "Y", "FINISHED", None)],
                               "run_id bigint, exec_order string, stored_procedure_name string, file_datasource string, "
                               "codebase string, status string, error string")
    assert [r.stored_procedure_name for r in R.select_plan(df, "bmt", "Y").collect()] == ["SP_A"]
    assert [r.stored_procedure_name for r in R.select_plan(df, "other").collect()] == ["SP_C"]
    bmt = R.select_plan(df, "bmt")
    assert [r.stored_procedure_name for r in R.plan_order(bmt).orderBy("pos").collect()] == ["SP_B", "SP_A"]
    assert [r.stored_procedure_name for r in R.plan_order(bmt, numeric=False).orderBy("pos").collect()] == ["SP_A", "SP_B"]


def test_close_and_start_runs(spark):
    from arrivalgate.operators import gate as G
    p = _plan(spark, [("OTHER", "FAILED", "ERROR: relation 7: missing")])
    out = R.run_outcome(R.step_outcomes(p, "strict"), "strict")
    keys = spark.createDataFrame([(1, dt.date(2024, 1, 15), "EMEA", "SPDST", "SPDST")],
                                 "run_id bigint, batchrundate date, regionname string, report_source string, identifier string")
    log_changes, master_changes = R.close_runs(out, keys, "2024-01-15 13:00:00")
    log = spark.createDataFrame([(dt.date(2024, 1, 15), "EMEA", "SPDST", "Submitted", None, "NA")],
                                "batchrundate date, regionname string, report_source string, execution_status string, "
                                "actual_end_time timestamp_ntz, error_message string")
    merged = G.merge_log(log, log_changes, cols=["execution_status", "actual_end_time", "error_message"]).first()
    assert (merged.execution_status, merged.error_message) == ("Failed", " relation 7: missing")
    assert merged.actual_end_time == dt.datetime(2024, 1, 15, 13, 0)
    master = spark.createDataFrame([("EMEA", "SPDST", "Yet to start", None)],
                                   "regionname string, identifier string, status string, actual_start_time timestamp_ntz")
    started = G.merge_log(master, R.start_runs(keys, "2024-01-15 12:00:00"), ["regionname", "identifier"],
                          ["status", "actual_start_time"]).first()
    assert started.status == "InProgress" and started.actual_start_time == dt.datetime(2024, 1, 15, 12, 0)
    closed = G.merge_log(master, master_changes, ["regionname", "identifier"], ["status"]).first()
    assert closed.status == "Failed"


def test_statement_states_poll_error(spark):
    t = dt.datetime(2024, 1, 15, 10, 0)
    ev = spark.createDataFrame([("q1", t, 1, "SUBMITTED"), ("q1", t, 2, "POLL_ERROR"), ("q1", t, 3, "FINISHED"),
                                ("q2", t, 1, "SUCCEEDED")],
                               "statement_id string, started timestamp_ntz, seq bigint, state string")
    older = {r.statement_id: r.final_state for r in R.statement_states(ev, aliases={"SUCCEEDED": "FINISHED"}).collect()}
    newer = {r.statement_id: r.final_state for r in
             R.statement_states(ev, poll_error_fails=True, aliases={"SUCCEEDED": "FINISHED"}).collect()}
    assert older == {"q1": "FINISHED", "q2": "FINISHED"}
    assert newer == {"q1": "FAILED", "q2": "FINISHED"}


def test_procedure_name_forms(spark):
    r = one(spark, a=T.is_no_arg_call(F.lit("PUBLISHED.SP_X ();")), b=T.is_no_arg_call(F.lit("PUBLISHED.SP_X ('EMEA')")))
    assert r.a is True and r.b is False


def test_empty_plan_closes_finished(spark):
    p = _plan(spark, [("OTHER", "FINISHED", None)])
    out = R.run_outcome(R.step_outcomes(p, "strict"), "strict")
    keys = spark.createDataFrame([(2, dt.date(2024, 1, 15), "APJ", "SPDST", "SPDST")],
                                 "run_id bigint, batchrundate date, regionname string, report_source string, identifier string")
    log_changes, master_changes = R.close_runs(out, keys, "2024-01-15 13:00:00")
    r = log_changes.first()
    assert (r.execution_status, r.error_message) == ("Finished", "Null")
    assert master_changes.first().status == "Completed"


def test_merge_keeps_all_columns_and_rows(spark):
    import pytest
    from pyspark.errors import PySparkException

    from arrivalgate.operators import gate as G
    master = spark.createDataFrame([("r1", "EMEA", "BMT", "Null", 5), ("r2", "EMEA", "BMT", "Delay", 6), ("r3", "APJ", "BMT", "Null", 7)],
                                   "report_name string, regionname string, identifier string, status string, average_runtime int")
    new = spark.createDataFrame([("EMEA", "BMT", "InProgress"), ("AMS", "BMT", "Completed")],
                                "regionname string, identifier string, status string")
    got = G.merge_log(master, new, ["regionname", "identifier"])
    assert got.columns == master.columns
    assert sorted((r.report_name or "", r.regionname, r.status, r.average_runtime) for r in got.collect()) == [
        ("", "AMS", "Completed", None), ("r1", "EMEA", "InProgress", 5), ("r2", "EMEA", "InProgress", 6), ("r3", "APJ", "Null", 7)]
    with pytest.raises(PySparkException, match="two changes of the key"):
        G.merge_log(master, new.union(new), ["regionname", "identifier"]).collect()


def test_critical_failure_message_lists_every_failed_step(spark):
    import json

    from arrivalgate.operators import outputs as O
    rows = [("OTHER", "FAILED", "E: a"), ("SPDST", "FAILED", "E: b"), ("OTHER", "FINISHED", None)]
    out = R.run_outcome(R.step_outcomes(_plan(spark, rows), "critical"), "critical")
    body = json.loads(O.run_alerts(out, "dev", "url", F.lit("EMEA")).where("kind = 'run_failed'").first().body)
    assert [(x["Stored Procedure Name"], x["Error"], x["Data Source"]) for x in body["Error Message"]] == [
        ("SP_0", "E: a", "SPDST/Others"), ("SP_1", "E: b", "SPDST")]


def test_hot_run_and_hot_step_are_spread(spark):
    """One run and one step hold a third of all rows: they get parts by their size, the others one, and the results stay right."""
    steps = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("run_id"), F.col("id").cast("string").alias("exec_order"),
        F.concat(F.lit("SP_"), "id").alias("stored_procedure_name"), F.lit("OTHER").alias("file_datasource"), F.lit("Y").alias("codebase"),
        F.when(F.col("id") == 15000, "FAILED").otherwise("FINISHED").alias("status"), F.lit(None).cast("string").alias("error"))
    plan = R.plan_order(steps)
    for per_task in (100, 1000, 1_000_000):
        out = R.step_outcomes(plan, "strict", per_task=per_task)
        got = {r["outcome"]: r["count"] for r in out.where("run_id = 0").groupBy("outcome").count().collect()}
        assert got == {"Completed": 5000, "Failed": 1, "Skipped": 4999}
        size = out.groupBy("run_id", "_part").count()
        assert size.where("run_id = 0").count() == max(1, 10_000 // per_task)      # as many parts as the run's size asks for
        assert size.where("run_id <> 0").agg(F.max("_part")).first()[0] == 0
        assert size.agg(F.max("count")).first()[0] <= max(1.5 * per_task, 100) or per_task > 10_000
        end = R.run_outcome(out, "strict").where("run_id = 0").first()
        assert (end.n_steps, end.n_failed, end.n_skipped, end.execution_status) == (10_000, 1, 4999, "Failed")
        assert [x["procedure"] for x in end.failed_steps] == ["SP_15000"]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(run_id" in text and "_part" in text
    t = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    att = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("step_id"),
                                    F.to_date(F.lit("2024-01-15")).alias("batchrundate"), t.alias("started"), F.col("id").alias("seq"),
                                    F.when(F.col("id") < 21, "FAILED").otherwise("FINISHED").alias("status"))
    r = R.fold_attempts(att, 8).where("step_id = 0").first()
    assert (r.final_state, r.attempts_used, r.attempts_recorded) == ("Completed", 8, 10000)
    r = R.fold_attempts(att, 7).where("step_id = 0").first()
    assert (r.final_state, r.attempts_used) == ("Failed", 7)


def test_parts_of_a_run_add_up_without_another_shuffle(spark):
    """The list of a hot run's failed steps is assembled from its parts, in plan order, where the join left them."""
    steps = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("run_id"), F.col("id").cast("string").alias("exec_order"),
        F.concat(F.lit("SP_"), "id").alias("stored_procedure_name"), F.lit("OTHER").alias("file_datasource"), F.lit("Y").alias("codebase"),
        F.when(F.col("id") % 2 == 0, "FAILED").otherwise("FINISHED").alias("status"), F.lit("E: x").alias("error"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        whole, cut = (R.run_outcome(R.step_outcomes(R.plan_order(steps), "critical", per_task=n), "critical") for n in (10**6, 50))
        assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))
        assert [x["procedure"] for x in cut.where("run_id = 0").first().failed_steps] == [f"SP_{i}" for i in range(0, 3000, 6)]
        plan = cut._jdf.queryExecution().executedPlan().toString()
        lines = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
        by_part = [x for x in lines if "_part#" in x]
        assert len(by_part) == 2, lines         # the join's two sides; adding up the parts needs none of its own
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_step_sends_a_few_rows_per_task(spark):
    """The limit on attempts reaches the tasks before the shuffle; ties of start and sequence count the success first."""
    t = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    att = spark.range(0, 20000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("step_id"), F.to_date(F.lit("2024-01-15")).alias("batchrundate"),
        t.alias("started"), (F.col("id") / 2).cast("long").alias("seq"), F.when(F.col("id") == 9, "FINISHED").otherwise("FAILED").alias("status"))
    got = R.fold_attempts(att, 4)
    r = got.where("step_id = 0").first()
    assert (r.final_state, r.attempts_used, r.attempts_recorded) == ("Completed", 4, 6667)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit .*, 4, Partial", plan) and plan.index("Final") < plan.index("Partial")
    tie = spark.sql("select 1 step_id, date'2024-01-15' batchrundate, timestamp_ntz'2024-01-15 00:00:00' started, 5 seq, explode(array('FAILED', 'FINISHED')) status"
                    " union all select null, date'2024-01-15', timestamp_ntz'2024-01-15 00:00:00', 6, 'FINISHED'")
    rows = {x.step_id: (x.final_state, x.attempts_used, x.attempts_recorded) for x in R.fold_attempts(tie, 3).collect()}
    assert rows == {1: ("Completed", 1, 2), None: ("Completed", 1, 1)}
