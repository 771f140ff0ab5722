"""Ordered runs of stored procedures, from recorded step states.

The reference calls the steps of a plan one at a time and stops on a failure.
Here the states are recorded events; the outcome of a step depends only on
whether an *earlier* step of its run failed, so it is computed from a
per-run aggregate (first failing position) joined back to the steps -- no
window over a run. The aggregate is reduced map-side and also counts the run's
steps; the join back is on (run, part), where a run has as many parts as its
size asks for (see ``skew``), so one that holds a third of all steps is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrivalgate.functions import text as T
from arrivalgate.operators.skew import PART, ROWS_PER_TASK, deal, each_part

# Fixed values of the reference: statement states and the critical source.
FINISHED, FAILED_ST, ABORTED = "FINISHED", "FAILED", "ABORTED"
TERMINAL = (FINISHED, FAILED_ST, ABORTED)
CRITICAL_SOURCE = "SPDST"
COMPLETED, FAILED, SKIPPED = "Completed", "Failed", "Skipped"
LOG_FINISHED, LOG_FAILED = "Finished", "Failed"
UNKNOWN_ERROR = "Unknown error"


def select_plan(run_plan: DataFrame, kind: str = "other", files_received: str | None = None) -> DataFrame:
    """S08 + P04/P05/P21: the steps an executor runs. ``bmt``: data source
    containing 'BMT' and ``codebase`` equal to the priority-files flag;
    ``other``: data source NOT LIKE '%BMT%' (NULL sources drop out, as in SQL)."""
    src = F.col("file_datasource")
    if kind == "bmt":
        df = run_plan.where(src.contains("BMT"))
        if files_received is not None:
            df = df.where(F.col("codebase") == files_received)
        return df
    if kind == "other":
        return run_plan.where(~src.contains("BMT"))
    raise ValueError(f"unknown plan kind {kind!r}")


def order_position(numeric: bool = True):
    """Numeric order key, non-numeric keys last (by text).
    L02 (``numeric=False``): the stored text order of ``exec_order``."""
    if not numeric:
        return F.struct(F.lit(False).alias("non_numeric"), F.lit(None).cast("double").alias("order_key"),
                        F.col("exec_order").alias("order_text"))
    key = F.expr("try_cast(exec_order AS DOUBLE)")
    return F.struct(key.isNull().alias("non_numeric"), key.alias("order_key"),
                    F.when(key.isNull(), F.col("exec_order")).alias("order_text"))


def plan_order(steps: DataFrame, run_col: str = "run_id", numeric: bool = True) -> DataFrame:
    """L01/L02 + W03 + J16 + R11: one step per (run, order key). Duplicate keys run
    one procedure (the smallest name) and are counted in ``duplicate_keys``."""
    pos = order_position(numeric)
    payload = [c for c in steps.columns if c not in (run_col,)]
    first = F.min(F.struct("stored_procedure_name", *[c for c in payload if c != "stored_procedure_name"]))
    return (steps.withColumn("pos", pos)
            .groupBy(run_col, "pos")
            .agg(first.alias("s"), F.count(F.lit(1)).alias("duplicate_keys"))
            .select(run_col, "pos", F.col("pos.order_key").alias("order_key"),
                    *[F.col(f"s.{c}").alias(c) for c in payload], "duplicate_keys"))


def step_outcomes(plan: DataFrame, halt: str = "strict", run_col: str = "run_id",
                  per_task: int = ROWS_PER_TASK) -> DataFrame:
    """D10 + W04 / W05: Completed, Failed or Skipped per step.

    ``strict``: any failure halts the run. ``critical``: only a failure of
    the critical source halts it; other failures are recorded and the run
    goes on. FINISHED and ABORTED count as success; a step without a
    state counts as FAILED (R15). The part of the run that a step was dealt to
    stays as a column: ``run_outcome`` adds up the parts where they are.
    """
    failed = F.coalesce(F.col("status") == FAILED_ST, F.col("status").isNull())
    if halt == "strict":
        halting = failed
    elif halt == "critical":
        halting = failed & F.coalesce(F.col("file_datasource") == CRITICAL_SOURCE, F.lit(False))
    else:
        raise ValueError(f"unknown halt rule {halt!r}")
    runs = plan.groupBy(run_col).agg(F.min(F.when(halting, F.col("pos"))).alias("_halt_at"), F.count(F.lit(1)).alias("_n"))
    steps = deal(plan, runs, [run_col], "_n", F.xxhash64("pos"), per_task)
    stops = each_part(runs.where(F.col("_halt_at").isNotNull()), "_n", per_task).drop("_n")
    df = steps.join(stops, [run_col, PART], "left")
    outcome = (F.when(F.col("_halt_at").isNotNull() & (F.col("pos") > F.col("_halt_at")), SKIPPED)
               .when(failed, FAILED).otherwise(COMPLETED))
    return df.withColumn("outcome", outcome).drop("_halt_at")


def run_outcome(outcomes: DataFrame, rule: str = "strict", run_col: str = "run_id") -> DataFrame:
    """D11 + A09 + A10 + F07/F08: the closing values of both audit tables.

    strict (newer executors): any failed step -> 'Failed'/'Failed' and F08 of
      the failed step's error (or 'Unknown error'); else 'Finished'/'Completed'/'Null'.
    strict_older: same with F07 and 'NULL'.
    critical: log 'Failed' if any step failed; report state and error text
      from the last step that ran (F07 of its error, or 'Null').
    All failed steps (procedure, source, raw error, in plan order) are carried for
    the failure notification, so alerts need no second pass over the steps.
    """
    st = F.col("outcome")
    err = F.coalesce(F.col("error"), F.lit(UNKNOWN_ERROR))
    # Two levels: each part of a run by itself (its rows are together already after
    # the join that dealt them), then one small row per part.
    part = F.col(PART) if PART in outcomes.columns else F.lit(0).alias(PART)
    parts = outcomes.groupBy(run_col, part).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.count_if(st == FAILED).alias("n_failed"),
        F.count_if(st == SKIPPED).alias("n_skipped"),
        F.min(F.when(st == FAILED, F.struct("pos", err.alias("e"), F.col("stored_procedure_name").alias("p"),
                                            F.col("file_datasource").alias("d")))).alias("_first_fail"),
        # Every failed step, for the failure message (a plan's failed steps only).
        F.collect_list(F.when(st == FAILED, F.struct("pos", F.col("stored_procedure_name").alias("p"),
                                                     F.col("file_datasource").alias("d"), err.alias("e")))).alias("_failed"),
        F.max(F.when(st != SKIPPED, F.struct("pos", st.alias("o"), err.alias("e")))).alias("_last_ran"),
    )
    agg = parts.groupBy(run_col).agg(
        F.sum("n_steps").alias("n_steps"), F.sum("n_failed").alias("n_failed"), F.sum("n_skipped").alias("n_skipped"),
        F.min("_first_fail").alias("_first_fail"), F.max("_last_ran").alias("_last_ran"),
        F.array_sort(F.flatten(F.collect_list("_failed"))).alias("_failed"))
    any_failed = F.col("n_failed") > 0
    log_state = F.when(any_failed, LOG_FAILED).otherwise(LOG_FINISHED)
    if rule in ("strict", "strict_older"):
        report = F.when(any_failed, FAILED).otherwise(COMPLETED)
        fn = T.error_tail if rule == "strict" else T.error_second_part
        ok_text = "Null" if rule == "strict" else "NULL"
        text = F.when(any_failed, fn(F.col("_first_fail.e"))).otherwise(F.lit(ok_text))
    elif rule == "critical":
        last_failed = F.coalesce(F.col("_last_ran.o") == FAILED, F.lit(False))
        report = F.when(last_failed, FAILED).otherwise(COMPLETED)
        text = F.when(last_failed, T.error_second_part(F.col("_last_ran.e"))).otherwise(F.lit("Null"))
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return agg.select(run_col, F.lit(rule).alias("rule"), log_state.alias("execution_status"),
                      report.alias("report_status"), text.alias("error_message"),
                      "n_steps", "n_failed", "n_skipped",
                      F.transform("_failed", lambda x: F.struct(
                          x["p"].alias("procedure"), x["d"].alias("source"), x["e"].alias("error"))).alias("failed_steps"))


OUTCOME_COLS = ["run_id", "rule", "execution_status", "report_status", "error_message", "n_steps", "n_failed",
                "n_skipped"]


def fold_attempts(attempts: DataFrame, limit: int, keys: list[str] | None = None) -> DataFrame:
    """Up to ``limit`` attempts per step, success at the first non-failed
    attempt (by start, then sequence); attempts after a success are ignored.

    Only a step's first ``limit`` attempts decide, so only these are ranked: Spark
    keeps at most ``limit`` rows per step in each task before it shuffles (the limit
    on ``row_number`` is pushed into the window), and the number of attempts is
    a count reduced map-side. However many attempts a hot step has, it sends a
    few rows per task. Of attempts with one start and sequence a success comes first.
    """
    keys = keys or ["step_id", "batchrundate"]
    ok = F.coalesce(F.col("status") != FAILED_ST, F.lit(False))
    order = Window.partitionBy(*keys).orderBy("started", "seq", F.col("_ok").desc())
    head = (attempts.select(*keys, "started", "seq", ok.alias("_ok")).withColumn("_nth", F.row_number().over(order))
            .where(F.col("_nth") <= limit).groupBy(*keys).agg(F.min(F.when(F.col("_ok"), F.col("_nth"))).alias("_ok_at")))
    all_ = attempts.groupBy(*keys).agg(F.count(F.lit(1)).alias("attempts_recorded"))
    df = all_.join(head.select(*[F.col(k).alias(f"_{k}") for k in keys], "_ok_at"), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    completed = F.col("_ok_at").isNotNull()
    used = F.when(completed, F.col("_ok_at")).otherwise(F.least(F.col("attempts_recorded"), F.lit(limit)))
    return df.select(*keys, F.when(completed, COMPLETED).otherwise(FAILED).alias("final_state"),
                     used.cast("bigint").alias("attempts_used"), "attempts_recorded")


def statement_states(events: DataFrame, id_col: str = "statement_id", poll_error_fails: bool = False,
                     aliases: dict[str, str] | None = None) -> DataFrame:
    """S12 + W02 + R18: first terminal state of each statement from its state
    events (FINISHED, FAILED, ABORTED). ``aliases`` renames states first (e.g.
    a job service's SUCCEEDED). A poll error is terminal only when
    ``poll_error_fails`` (newer executors)."""
    st = F.col("state")
    for k, v in (aliases or {}).items():
        st = F.when(st == k, v).otherwise(st)
    df = events.withColumn("state", st)
    terminal = F.col("state").isin(*TERMINAL)
    if poll_error_fails:
        df = df.withColumn("state", F.when(F.col("state") == "POLL_ERROR", FAILED_ST).otherwise(F.col("state")))
        terminal = F.col("state").isin(*TERMINAL)
    first = F.min(F.when(terminal, F.struct("started", "seq", "state")))
    return (df.groupBy(id_col)
            .agg(first.alias("_t"), F.count(F.lit(1)).alias("n_events"))
            .select(id_col, F.col("_t.state").alias("final_state"), F.col("_t.started").alias("terminal_at"),
                    "n_events"))


def error_texts(steps: DataFrame) -> DataFrame:
    """F07 / F08 over the distinct error texts of failed steps."""
    return (steps.where(F.col("error").isNotNull()).select("error").distinct()
            .select("error", T.error_second_part("error").alias("second_part"),
                    T.error_tail("error").alias("tail")))


def close_runs(outcomes: DataFrame, run_keys: DataFrame, ended_at) -> tuple[DataFrame, DataFrame]:
    """K04 + K06: the closing changes of a run for both audit tables.

    ``run_keys`` maps ``run_id`` to (batchrundate, regionname, report_source,
    identifier). Returns (trigger-log changes keyed by date, region and
    source: state, actual end, error text; report-master changes keyed by
    region and identifier: status). Apply them with ``gate.merge_log``.
    """
    end = ended_at if isinstance(ended_at, Column) else F.lit(str(ended_at)).cast("timestamp_ntz")
    # A run with an empty plan has no outcome row and closes as
    # 'Finished' / 'Completed' with zero steps.
    j = run_keys.join(outcomes.select("run_id", "execution_status", "report_status", "error_message"),
                      "run_id", "left")
    log = j.select("batchrundate", "regionname", "report_source",
                   F.coalesce("execution_status", F.lit(LOG_FINISHED)).alias("execution_status"),
                   end.alias("actual_end_time"), F.coalesce("error_message", F.lit("Null")).alias("error_message"))
    master = j.select("regionname", "identifier",
                      F.coalesce("report_status", F.lit(COMPLETED)).alias("status"))
    return log, master


def start_runs(run_keys: DataFrame, started_at) -> DataFrame:
    """Report-master changes at run start: 'InProgress' and the actual start."""
    start = started_at if isinstance(started_at, Column) else F.lit(str(started_at)).cast("timestamp_ntz")
    return run_keys.select("regionname", "identifier", F.lit("InProgress").alias("status"),
                           start.alias("actual_start_time"))
