"""Run operators against a direct, row-at-a-time reading of the executors on
random plans and attempts (including one hot run that holds most rows)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from arrivalgate.operators import runs as R

STATUS = st.sampled_from(["FINISHED", "FAILED", "ABORTED", None])
SOURCE = st.sampled_from(["SPDST", "OTHER"])


def brute_outcomes(steps, halt):
    out = {}
    for run in sorted({s[0] for s in steps}):
        rows = sorted((s for s in steps if s[0] == run), key=lambda s: s[1])
        stopped = False
        for run_id, order, src, status in rows:
            if stopped:
                out[(run_id, order)] = "Skipped"
                continue
            failed = status is None or status == "FAILED"
            out[(run_id, order)] = "Failed" if failed else "Completed"
            if failed and (halt == "strict" or src == "SPDST"):
                stopped = True
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]), SOURCE, STATUS), min_size=1, max_size=25))
def test_step_outcomes_match_sequential_run(spark, rows):
    steps = [(run, (i + 1) * 5, src, status) for i, (run, src, status) in enumerate(rows)]
    df = spark.createDataFrame([(r, str(o), f"SP_{o}", s, "Y", stt, "E: x") for r, o, s, stt in steps],
                               "run_id bigint, exec_order string, stored_procedure_name string, file_datasource string, "
                               "codebase string, status string, error string")
    plan = R.plan_order(df)
    for halt in ("strict", "critical"):
        got = {(r.run_id, int(r.order_key)): r.outcome for r in R.step_outcomes(plan, halt).collect()}
        assert got == brute_outcomes(steps, halt)


def brute_fold(attempts, limit):
    out = {}
    for key in {a[0] for a in attempts}:
        seq = [a[2] for a in sorted((a for a in attempts if a[0] == key), key=lambda a: a[1])]
        used, state = 0, "Failed"
        for s in seq[:limit]:
            used += 1
            if s != "FAILED":
                state = "Completed"
                break
        out[key] = (state, used, len(seq))
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]), st.sampled_from(["FAILED", "FINISHED", "ABORTED"])),
                min_size=1, max_size=25), st.integers(min_value=1, max_value=4))
def test_fold_attempts_match_retry_loop(spark, rows, limit):
    t = dt.datetime(2024, 1, 15, 10, 0)
    attempts = [(step, i, s) for i, (step, s) in enumerate(rows)]
    df = spark.createDataFrame([(step, dt.date(2024, 1, 15), t + dt.timedelta(seconds=i), i, s) for step, i, s in attempts],
                               "step_id bigint, batchrundate date, started timestamp_ntz, seq bigint, status string")
    got = {r.step_id: (r.final_state, r.attempts_used, r.attempts_recorded) for r in R.fold_attempts(df, limit).collect()}
    assert got == brute_fold(attempts, limit)
