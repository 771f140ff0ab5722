"""Trigger gate: busy jobs, upstream completion, the three decision rules,
delay alerts, and the keyed merge of decisions into the trigger log.

One row per (batchrundate, regionname, report_source). ``now`` is a Column
(a literal, or per row, e.g. derived from the batch date).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivalgate.functions import timecols as TC

# Fixed values of the reference: trigger states, busy job states, messages.
YET, SUBMITTED, DELAY, FINISHED, FAILED = "Yet to start", "Submitted", "Delay", "Finished", "Failed"
TRIGGERED = (FINISHED, SUBMITTED)
BUSY_STATES = ("STARTING", "RUNNING", "STOPPING")
MSG_BUSY = "Other Region Report Refresh is already running"
MSG_INIT = {
    "current": "SPDST report refresh pending initialization",
    "bmt": "BMT report refresh yet to start",
    "legacy": "SPDST report refresh yet to start",
}
MSG_CUTOFF_COUNT = "Cut off time Reached: Missing %d files"
MSG_PENDING_COUNT = "Pending files: %d"
MSG_CUTOFF_NAMES = "Cut off time Reached and priority files not received"
MSG_PENDING_NAMES = "PF Missing "
MSG_START = {"current": "NA", "bmt": "NULL", "legacy": "NA"}
RULE_SOURCE = {"current": "SPDST", "bmt": "BMT", "legacy": "SPDST"}
UPSTREAM_SOURCE = "BMT"

KEYS = ["batchrundate", "regionname", "report_source"]
DAY_REGION = ["batchrundate", "regionname"]


def latest_runs(job_runs: DataFrame) -> DataFrame:
    """Newest run state of every job (by start, then sequence). A grouped
    max_by, so a job with a third of all runs is reduced map-side first."""
    return (job_runs.groupBy("job_name")
            .agg(F.max_by("job_run_state", F.struct("started", "seq")).alias("job_run_state")))


def busy_regions(dependency: DataFrame, job_runs: DataFrame) -> DataFrame:
    """S11 + J11 + A08: a region is busy when the newest run of any job it
    depends on is starting, running or stopping. Jobs without runs are idle."""
    latest = latest_runs(job_runs)
    busy = F.coalesce(F.col("job_run_state").isin(*BUSY_STATES), F.lit(False))
    return (dependency.join(latest, "job_name", "left")
            .groupBy("regionname")
            .agg(F.bool_or(busy).alias("busy"), F.count_if(busy).alias("busy_jobs")))


def already_triggered(trigger_log: DataFrame) -> DataFrame:
    """S02 + P09: log rows with a flag for 'Finished' or 'Submitted'."""
    return trigger_log.withColumn("already_triggered",
                                  F.coalesce(F.col("execution_status").isin(*TRIGGERED), F.lit(False)))


def upstream_finished(trigger_log: DataFrame, cal: DataFrame, upstream: str = UPSTREAM_SOURCE) -> DataFrame:
    """For every (date, region), has the upstream source finished that day?"""
    fin = (trigger_log.where((F.col("report_source") == upstream) & (F.col("execution_status") == FINISHED))
           .select(*DAY_REGION).distinct().withColumn("upstream_finished", F.lit(True)))
    return (cal.select(*DAY_REGION).join(fin, DAY_REGION, "left")
            .withColumn("upstream_finished", F.coalesce("upstream_finished", F.lit(False))))


def initial_rows(windows: DataFrame, trigger_log: DataFrame, jobs: dict[str, str],
                 messages: dict[str, str] | None = None) -> DataFrame:
    """K01 + J12: the day's first log row ('Yet to start') where none exists."""
    messages = messages or {"BMT": MSG_INIT["bmt"], "SPDST": MSG_INIT["current"]}
    job = F.create_map(*[x for k, v in jobs.items() for x in (F.lit(k), F.lit(v))])
    msg = F.create_map(*[x for k, v in messages.items() for x in (F.lit(k), F.lit(v))])
    return (windows.join(trigger_log.select(*KEYS), KEYS, "left_anti")
            .select("batchrundate", "regionname", F.lit(YET).alias("execution_status"),
                    job[F.col("report_source")].alias("gluejob"), "report_source",
                    F.col("expected_start").alias("expected_start_time"),
                    F.col("expected_end").alias("expected_end_time"),
                    msg[F.col("report_source")].alias("error_message")))


def next_step_status(trigger_log: DataFrame, source: str) -> DataFrame:
    """The source's log rows keyed by the batch date they follow from."""
    return trigger_log.where(F.col("report_source") == source).select(
        "regionname", F.col("batchrundate").alias("_next"), F.col("execution_status").alias("next_status"))


DELAY_CHECKED = ("start", "cutoff", "pending")


def with_next_day_delay(decisions: DataFrame, trigger_log: DataFrame, now: Column, window: tuple,
                        source: str = "SPDST", months: int = 0, days: int = 1) -> DataFrame:
    """The decisions with ``next_status``, ``in_window`` and ``alert``. D12 (legacy): delay alert when in the delay window (field form, minute <
    end minute) and the next batch's row (``months`` or ``days`` later) is
    missing or 'Failed'. The reference gets that far only for a day that has
    its row, is not triggered yet and has no busy job, so only the legacy
    ``decisions`` start, cutoff and pending can alert."""
    d = F.col("batchrundate")
    nxt_day = F.add_months(d, months) if months else F.date_add(d, days)
    df = (decisions.withColumn("_next", nxt_day)
          .join(next_step_status(trigger_log, source), ["regionname", "_next"], "left").drop("_next"))
    inside = TC.in_window(now, *window, form="fields_strict_end")
    alert = F.col("action").isin(*DELAY_CHECKED) & inside & (F.col("next_status").isNull() | (F.col("next_status") == FAILED))
    return df.withColumn("in_window", inside).withColumn("alert", alert)


def next_day_delay(decisions: DataFrame, trigger_log: DataFrame, now: Column, window: tuple, **step) -> DataFrame:
    """D12 (legacy): the delay check of every decision (see ``with_next_day_delay``)."""
    return with_next_day_delay(decisions, trigger_log, now, window, **step).select(
        *DAY_REGION, "next_status", "in_window", "alert")


def decide(rule: str, windows: DataFrame, trigger_log: DataFrame, ready: DataFrame, busy: DataFrame,
           upstream: DataFrame | None, now: Column, cutoff: tuple, force_extra: tuple | None = None,
           delay_window: tuple | None = None) -> DataFrame:
    """D05 to D07 + W07 + P15: one decision per region and batch date of the rule's
    source, as a single ordered ``when`` chain (first match wins):

    1 no log row: insert 'Yet to start'; 2 'Finished'/'Submitted': nothing;
    3 a dependent job busy: 'Delay' if past the expected start;
    4 (bmt) forced start after cutoff + extra; 5 ready: 'Submitted';
    6 not all done and in the cutoff window: 'Delay' if past, cutoff message;
    7 else 'Delay' if past, pending message.
    The upstream 'Delay' text of current/legacy is always overwritten by 6 or 7
    in the reference, so it is not a step here.
    """
    src = F.col("report_source") == RULE_SOURCE[rule]
    df = _situation(windows.where(src), trigger_log.where(src), ready, DAY_REGION, busy, upstream, now)
    return _decided(df, {RULE_SOURCE[rule]: rule}, cutoff, force_extra, delay_window)


def decide_both(windows: DataFrame, trigger_log: DataFrame, ready: DataFrame, busy: DataFrame, upstream: DataFrame,
                now: Column, cutoff: tuple, force_extra: tuple | None = None, delay_window: tuple | None = None,
                spdst_rule: str = "current") -> DataFrame:
    """D05 to D07 for both triggers in one pass: the decisions that ``decide`` makes
    under ``bmt`` and under ``spdst_rule``, from readiness per rule
    (``files.readiness(..., "each")``)."""
    rules = {RULE_SOURCE[rule]: rule for rule in ("bmt", spdst_rule)}
    both = F.col("report_source").isin(*rules)
    source = F.coalesce(*[F.when(F.col("rule") == rule, F.lit(src)) for src, rule in rules.items()])
    df = _situation(windows.where(both), trigger_log.where(both), ready.withColumn("report_source", source), KEYS, busy, upstream, now)
    return _decided(df, rules, cutoff, force_extra, delay_window)


def _situation(windows: DataFrame, log: DataFrame, ready: DataFrame, ready_keys: list[str], busy: DataFrame,
               upstream: DataFrame | None, now: Column) -> DataFrame:
    """Every window with what is known when it is decided."""
    log_cols = [F.col("execution_status").alias("old_status")]
    log_cols.append((F.col("error_message") if "error_message" in log.columns
                     else F.lit(None).cast("string")).alias("old_message"))
    log_cols.append((F.col("actual_start_time") if "actual_start_time" in log.columns
                     else F.lit(None).cast("timestamp_ntz")).alias("old_actual_start"))
    df = (windows.join(log.select(*KEYS, *log_cols, F.lit(True).alias("_has_row")), KEYS, "left")
          .join(ready.select(*ready_keys, "expected", "done", "missing", "names", "missing_names",
                             *(["failed_files"] if "failed_files" in ready.columns else [])),
                ready_keys, "left")
          # One row per region: bounded by the region catalog, so broadcast.
          .join(F.broadcast(busy.select("regionname", "busy")), "regionname", "left"))
    if upstream is not None:
        df = df.join(upstream.select(*DAY_REGION, "upstream_finished"), DAY_REGION, "left")
    else:
        df = df.withColumn("upstream_finished", F.lit(True))
    return df.withColumn("_now", now)


def _early(busy: Column) -> Column:
    """Steps 1 to 3, which need no file states."""
    return (F.when(F.col("_has_row").isNull(), "insert")
            .when(F.col("old_status").isin(*TRIGGERED), "none")
            .when(F.coalesce(busy, F.lit(False)), "blocked"))


def early_actions(rule: str, windows: DataFrame, trigger_log: DataFrame, busy: DataFrame) -> DataFrame:
    """The decisions of a rule as far as they need no file states: ``insert``, ``none``,
    ``blocked``, and ``pending`` for all that go on to the files (where the full
    decision is ``start``, ``cutoff`` or ``pending``)."""
    src = F.col("report_source") == RULE_SOURCE[rule]
    log = trigger_log.where(src).select(*KEYS, F.col("execution_status").alias("old_status"), F.lit(True).alias("_has_row"))
    df = windows.where(src).join(log, KEYS, "left").join(F.broadcast(busy.select("regionname", "busy")), "regionname", "left")
    return df.select(*KEYS, _early(F.col("busy")).otherwise("pending").alias("action"))


def _decided(df: DataFrame, rules: dict[str, str], cutoff: tuple, force_extra: tuple | None,
             delay_window: tuple | None) -> DataFrame:
    """The decision columns over ``_situation``; ``rules`` maps a report source to its rule."""
    def by_rule(of) -> Column:
        got = {src: of(rule) for src, rule in rules.items()}
        if len(got) == 1:
            return next(iter(got.values()))
        return F.coalesce(*[F.when(F.col("report_source") == src, c) for src, c in got.items()])

    n = F.col("_now")
    past = n > F.col("expected_start")
    expected = F.coalesce("expected", F.lit(0))
    done = F.coalesce("done", F.lit(0))
    missing = F.coalesce("missing", F.lit(0))
    names = F.coalesce("names", F.lit(""))
    up = F.coalesce("upstream_finished", F.lit(False))

    def action(rule: str) -> Column:
        in_cut = TC.in_window(n, *cutoff, form="clock" if rule == "current" else "fields")
        is_ready = done >= expected if rule == "bmt" else (done == expected) & up
        got = _early(F.col("busy"))
        if rule == "bmt" and force_extra is not None:
            got = got.when(TC.after_cutoff_plus(n, cutoff[0], cutoff[1], *force_extra), "forced_start")
        return got.when(is_ready, "start").when((done != expected) & in_cut, "cutoff").otherwise("pending")

    df = df.withColumn("action", by_rule(action))
    a = F.col("action")
    cut_msg = by_rule(lambda rule: F.format_string(MSG_CUTOFF_COUNT, missing) if rule == "current"
                      else F.concat(F.lit(MSG_CUTOFF_NAMES), names))
    pend_msg = by_rule(lambda rule: F.format_string(MSG_PENDING_COUNT, missing) if rule == "current"
                       else F.concat(F.lit(MSG_PENDING_NAMES), names))
    delayed = a.isin("blocked", "cutoff", "pending") & past
    status = (F.when(a == "insert", YET)
              .when(a.isin("start", "forced_start"), SUBMITTED)
              .when(delayed, DELAY)
              .otherwise(F.col("old_status")))
    message = (F.when(a == "insert", by_rule(lambda rule: F.lit(MSG_INIT[rule])))
               .when(a == "forced_start", "NULL")
               .when(a == "start", by_rule(lambda rule: F.lit(MSG_START[rule])))
               .when(delayed & (a == "blocked"), MSG_BUSY)
               .when(delayed & (a == "cutoff"), cut_msg)
               .when(delayed & (a == "pending"), pend_msg)
               .otherwise(F.col("old_message")))
    started = F.when(a.isin("start", "forced_start"), n).otherwise(F.col("old_actual_start"))
    none = F.lit(None).cast("string")
    flag = by_rule(lambda rule: F.when(a == "forced_start", "N").when(a == "start", "Y") if rule == "bmt" else none)
    no = F.lit(False)
    alert = by_rule(lambda rule: a.isin("start", "cutoff", "pending") & TC.in_window(n, *delay_window, form="clock")
                    if rule == "current" and delay_window is not None else no)
    return df.select(*KEYS, "action", status.alias("execution_status"), message.alias("error_message"),
                     started.alias("actual_start_time"), flag.cast("string").alias("priority_files_received"),
                     missing.alias("missing"), names.alias("names"),
                     F.coalesce("missing_names", F.lit("")).alias("missing_names"), alert.alias("delay_alert"),
                     "expected_start", "expected_end",
                     *([F.col("failed_files")] if "failed_files" in df.columns else []))


DECISION_COLS = KEYS + ["action", "execution_status", "error_message", "actual_start_time",
                        "priority_files_received", "missing", "names", "missing_names", "delay_alert"]


def log_changes(decisions: DataFrame, jobs: dict[str, str]) -> DataFrame:
    """The trigger-log values of the decisions. A first row ('insert')
    comes complete, with its job and expected window; other rows leave those
    columns as they are (NULL)."""
    job = F.create_map(*[x for k, v in jobs.items() for x in (F.lit(k), F.lit(v))])[F.col("report_source")]
    first = F.col("action") == "insert"
    return decisions.select(
        *KEYS, "execution_status", F.when(first, job).alias("gluejob"),
        F.when(first, F.col("expected_start")).alias("expected_start_time"),
        F.when(first, F.col("expected_end")).alias("expected_end_time"), "error_message", "actual_start_time")


def merge_log(log: DataFrame, changes: DataFrame, keys: list[str] | None = None,
              cols: list[str] | None = None) -> DataFrame:
    """K02 to K06 + T04: keyed upsert without MERGE, on whole rows.

    Every column of ``log`` stays, with its type and in its place. A changed
    column (``cols``, by default all that ``changes`` holds) takes the new
    value, or keeps the old where the new one is NULL. Several log rows of one
    key are all changed and all stay. A key that the log lacks becomes a new
    row, NULL where ``changes`` says nothing. Columns that only ``changes``
    has are added at the end. Two changes of one key are an error.
    The result is a new snapshot; write it to a new path, never over the one
    being read."""
    keys = keys or KEYS
    cols = cols or [c for c in changes.columns if c not in keys]
    once = changes.groupBy(*keys).agg(F.first(F.struct(*cols)).alias("_n"), F.count(F.lit(1)).alias("_c"))
    # the check is part of the value, so that no column pruning can drop it
    twice = F.raise_error(F.concat(F.lit("two changes of the key "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))
    once = once.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                       F.when(F.col("_c") > 1, twice.cast(once.schema["_n"].dataType)).otherwise(F.col("_n")).alias("_n"))
    j = log.join(once, [F.col(k) == F.col(f"_k_{k}") for k in keys], "full_outer")
    out = []
    for c in log.columns:
        kind = log.schema[c].dataType
        if c in keys:
            out.append(F.coalesce(F.col(c), F.col(f"_k_{c}").cast(kind)).alias(c))
        elif c in cols:
            out.append(F.coalesce(F.col(f"_n.{c}").cast(kind), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out, *[F.col(f"_n.{c}").alias(c) for c in cols if c not in log.columns])
