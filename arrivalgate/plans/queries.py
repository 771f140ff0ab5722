"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the whole
stand-in control tables derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalgate.operators import files as FS
from arrivalgate.plans import params as P
from arrivalgate.sources.fixtures import ControlTables


# ---------------------------------------------------------------- file chain

def calendar(ct: ControlTables) -> DataFrame:
    """Every batch date with every scheduled region."""
    return FS.calendar(ct.d_batch_dates, ct.d_schedule)


def zones(ct: ControlTables) -> DataFrame:
    """The objects of the landing and the archive zone."""
    return ct.d_landing.unionByName(ct.d_archive)


def file_chain(ct: ControlTables, source: str, rule: str, restrict: bool = True, facts: DataFrame | None = None,
               scripts: DataFrame | None = None) -> dict[str, DataFrame]:
    """All stages of the file-readiness chain for one trigger kind. With
    ``restrict`` the two large inputs are read for the evaluated batch dates
    only (every file state is on those dates). ``facts`` and ``scripts``: the load
    facts and published scripts, where they are kept up to date (``LoadState``)."""
    pf = FS.priority_files(ct.d_file_property, source)
    cal = calendar(ct)
    expected = FS.expected_by_date(cal, pf)
    log = FS.restrict_to_dates(ct.d_audit_log, cal) if restrict else ct.d_audit_log
    landing = FS.restrict_to_dates(zones(ct), cal) if restrict else zones(ct)
    facts = FS.load_facts(FS.of_files(log, pf), P.FIXTURE_EMPTY_ERROR) if facts is None else facts
    loaded = FS.curated_loaded(log, pf, facts)
    posts = FS.name_posts(pf)
    mapped = FS.map_procedures(loaded, ct.d_sp_map, catalog=pf, posts=posts)
    pub = FS.published(mapped, log, scripts)
    match = "exact" if rule == "current" else "contains"
    rec = FS.received(landing, expected, match, P.FIXTURE_METADATA_PREFIX, posts)
    failed = FS.failed_processes(log, facts)
    empty = FS.empty_sources(log, P.FIXTURE_EMPTY_ERROR, facts=facts)
    refd = None
    if rule == "legacy":
        refs = FS.restrict_to_dates(ct.d_curated_ref, cal) if restrict else ct.d_curated_ref
        refd = FS.reference_dates(pub, log, refs, posts)
    states = FS.file_state(expected, pub, rec, failed, empty, refd, rule)
    return {"priority": pf, "calendar": cal, "expected": expected, "loaded": loaded,
            "mapped": mapped, "published": pub, "received": rec, "failed": failed,
            "empty": empty, "refdates": refd, "states": states}


def q05_priority_bmt(spark: SparkSession, sf: str) -> DataFrame:
    return FS.priority_files(ControlTables(spark, sf).d_file_property, "bmt")


def q06_priority_other(spark: SparkSession, sf: str) -> DataFrame:
    return FS.priority_files(ControlTables(spark, sf).d_file_property, "other")


def q07_curated_loaded(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return FS.curated_loaded(ct.d_audit_log, FS.priority_files(ct.d_file_property, "bmt"))


def q08_file_procedure(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    pf = FS.priority_files(ct.d_file_property, "bmt")
    return FS.file_procedures(pf, ct.d_sp_map, FS.name_posts(pf))


def q09_published_files(spark: SparkSession, sf: str) -> DataFrame:
    # Published files of every date in the log, not only the evaluated ones.
    return file_chain(ControlTables(spark, sf), "bmt", "bmt", restrict=False)["published"]


def q10_unpublished_files(spark: SparkSession, sf: str) -> DataFrame:
    ch = file_chain(ControlTables(spark, sf), "bmt", "bmt")
    return ch["expected"].join(ch["published"], FS.KEY, "left_anti")


def _expected_all(ct: ControlTables) -> DataFrame:
    return FS.expected_by_date(calendar(ct), FS.priority_files(ct.d_file_property, "all"))


def q11_received_exact(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return FS.received(zones(ct), _expected_all(ct), "exact", P.FIXTURE_METADATA_PREFIX)


def q12_received_contains(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    posts = FS.name_posts(FS.priority_files(ct.d_file_property, "all"))
    return FS.received(zones(ct), _expected_all(ct), "contains", P.FIXTURE_METADATA_PREFIX, posts)


def q13_failed_processes(spark: SparkSession, sf: str) -> DataFrame:
    return FS.failed_processes(ControlTables(spark, sf).d_audit_log)


def q14_empty_source_files(spark: SparkSession, sf: str) -> DataFrame:
    return FS.empty_sources(ControlTables(spark, sf).d_audit_log, P.FIXTURE_EMPTY_ERROR)


def q15_reference_date_check(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    pf = FS.priority_files(ct.d_file_property, "other")
    loaded = FS.curated_loaded(ct.d_audit_log, pf)
    return FS.reference_dates(loaded, ct.d_audit_log, ct.d_curated_ref, FS.name_posts(pf))


def q16_file_state_bmt(spark: SparkSession, sf: str) -> DataFrame:
    return file_chain(ControlTables(spark, sf), "bmt", "bmt")["states"]


def q16b_file_state_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return file_chain(ControlTables(spark, sf), "other", "legacy")["states"]


def q17_file_state_current(spark: SparkSession, sf: str) -> DataFrame:
    return file_chain(ControlTables(spark, sf), "other", "current")["states"]


def q18_readiness(spark: SparkSession, sf: str) -> DataFrame:
    return FS.readiness(file_chain(ControlTables(spark, sf), "bmt", "bmt")["states"], "bmt").select(*FS.READINESS_COLS)


QUERIES = {
    "q05_priority_bmt": q05_priority_bmt,
    "q06_priority_other": q06_priority_other,
    "q07_curated_loaded": q07_curated_loaded,
    "q08_file_procedure": q08_file_procedure,
    "q09_published_files": q09_published_files,
    "q10_unpublished_files": q10_unpublished_files,
    "q11_received_exact": q11_received_exact,
    "q12_received_contains": q12_received_contains,
    "q13_failed_processes": q13_failed_processes,
    "q14_empty_source_files": q14_empty_source_files,
    "q15_reference_date_check": q15_reference_date_check,
    "q16_file_state_bmt": q16_file_state_bmt,
    "q16b_file_state_legacy": q16b_file_state_legacy,
    "q17_file_state_current": q17_file_state_current,
    "q18_readiness": q18_readiness,
}


# ---------------------------------------------------------------- gate

from arrivalgate.operators import gate as G  # noqa: E402
from arrivalgate.operators import schedule as S  # noqa: E402


def gate_now():
    """Per-row evaluation time of the gate queries."""
    return F.expr(P.GATE_NOW_SQL_SPARK)


def windows(ct: ControlTables) -> DataFrame:
    return S.expected_window(ct.d_schedule, calendar(ct))


def decisions(ct: ControlTables, rule: str) -> DataFrame:
    source = "bmt" if rule == "bmt" else "other"
    ch = file_chain(ct, source, rule)
    ready = FS.readiness(ch["states"], rule)
    busy = G.busy_regions(ct.d_dependency, ct.d_job_runs)
    up = None if rule == "bmt" else G.upstream_finished(ct.d_trigger_log, ch["calendar"])
    return G.decide(rule, windows(ct), ct.d_trigger_log, ready, busy, up, gate_now(),
                    P.CUTOFF, P.FORCE_EXTRA, P.DELAY_WINDOW)


def both_decisions(ct: ControlTables) -> DataFrame:
    """The decisions of both triggers, from one pass over the inputs."""
    pf, cal = FS.trigger_files(ct.d_file_property), calendar(ct)
    log, landing = (FS.restrict_to_dates(x, cal) for x in (ct.d_audit_log, zones(ct)))
    facts, posts, expected = FS.load_facts(FS.of_files(log, pf), P.FIXTURE_EMPTY_ERROR), FS.name_posts(pf), FS.expected_by_date(cal, pf)
    mapped = FS.map_procedures(FS.curated_loaded(log, pf, facts), ct.d_sp_map, catalog=pf, posts=posts)
    receipts = FS.received_flags(landing, expected, P.FIXTURE_METADATA_PREFIX, posts)
    states = FS.trigger_states(expected, FS.published(mapped, log), receipts, facts)
    return G.decide_both(windows(ct), ct.d_trigger_log, FS.readiness(states, "each"), G.busy_regions(ct.d_dependency, ct.d_job_runs),
                         G.upstream_finished(ct.d_trigger_log, cal), gate_now(), P.CUTOFF, P.FORCE_EXTRA, P.DELAY_WINDOW)


def q01_expected_window(spark: SparkSession, sf: str) -> DataFrame:
    return windows(ControlTables(spark, sf))


def q02_initial_log_rows(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return G.initial_rows(windows(ct), ct.d_trigger_log, P.JOBS)


def q03_already_triggered(spark: SparkSession, sf: str) -> DataFrame:
    return G.already_triggered(ControlTables(spark, sf).d_trigger_log)


def q04_busy_regions(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return G.busy_regions(ct.d_dependency, ct.d_job_runs)


def q19_upstream_finished(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return G.upstream_finished(ct.d_trigger_log, calendar(ct))


def q24_decide_current(spark: SparkSession, sf: str) -> DataFrame:
    return decisions(ControlTables(spark, sf), "current").select(*G.DECISION_COLS)


def q25_decide_bmt(spark: SparkSession, sf: str) -> DataFrame:
    return decisions(ControlTables(spark, sf), "bmt").select(*G.DECISION_COLS)


def q26_decide_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return decisions(ControlTables(spark, sf), "legacy").select(*G.DECISION_COLS)


def q27_merged_log(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return G.merge_log(ct.d_trigger_log, G.log_changes(both_decisions(ct), P.JOBS))


def q28_report_window(spark: SparkSession, sf: str) -> DataFrame:
    return S.report_window(ControlTables(spark, sf).d_report_master, P.TODAY)


def q29_report_status(spark: SparkSession, sf: str) -> DataFrame:
    w = S.report_window(ControlTables(spark, sf).d_report_master, P.TODAY)
    return S.report_status(w, P.NOW).select("report_name", "regionname", "identifier", "expected_start", "status")


def legacy_delay(ct: ControlTables, legacy: DataFrame) -> DataFrame:
    return G.with_next_day_delay(legacy, ct.d_trigger_log, gate_now(), P.LEGACY_DELAY_WINDOW, "SPDST",
                                 months=P.BATCH_STEP_MONTHS)


def q38_next_day_delay(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    # whether the delay is checked at all depends on the log and the busy jobs only
    early = G.early_actions("legacy", windows(ct), ct.d_trigger_log, G.busy_regions(ct.d_dependency, ct.d_job_runs))
    return legacy_delay(ct, early).select(*G.DAY_REGION, "next_status", "in_window", "alert")


QUERIES.update({
    "q01_expected_window": q01_expected_window,
    "q02_initial_log_rows": q02_initial_log_rows,
    "q03_already_triggered": q03_already_triggered,
    "q04_busy_regions": q04_busy_regions,
    "q19_upstream_finished": q19_upstream_finished,
    "q24_decide_current": q24_decide_current,
    "q25_decide_bmt": q25_decide_bmt,
    "q26_decide_legacy": q26_decide_legacy,
    "q27_merged_log": q27_merged_log,
    "q28_report_window": q28_report_window,
    "q29_report_status": q29_report_status,
    "q38_next_day_delay": q38_next_day_delay,
})


# ---------------------------------------------------------------- runs

from arrivalgate.operators import runs as R  # noqa: E402


def plan(ct: ControlTables) -> DataFrame:
    return R.plan_order(R.select_plan(ct.d_run_steps, "other"))


def bmt_plan(ct: ControlTables) -> DataFrame:
    """The BMT executor's plan, with the priority files received, in text order."""
    return R.plan_order(R.select_plan(ct.d_run_steps, "bmt", "Y"), numeric=False)


def q30_plan_order(spark: SparkSession, sf: str) -> DataFrame:
    return plan(ControlTables(spark, sf)).select(
        "run_id", "order_key", "exec_order", "stored_procedure_name", "file_datasource", "duplicate_keys")


def q31_halt_strict(spark: SparkSession, sf: str) -> DataFrame:
    return R.step_outcomes(plan(ControlTables(spark, sf)), "strict").select(
        "run_id", "order_key", "stored_procedure_name", "outcome")


def q32_halt_critical(spark: SparkSession, sf: str) -> DataFrame:
    return R.step_outcomes(plan(ControlTables(spark, sf)), "critical").select(
        "run_id", "order_key", "stored_procedure_name", "outcome")


def q33_retry_fold(spark: SparkSession, sf: str) -> DataFrame:
    return R.fold_attempts(ControlTables(spark, sf).d_step_attempts, P.RETRY_LIMIT)


def run_outcomes(ct: ControlTables) -> DataFrame:
    p = plan(ct)
    strict = R.step_outcomes(p, "strict")
    return (R.run_outcome(strict, "strict")
            .unionByName(R.run_outcome(strict, "strict_older"))
            .unionByName(R.run_outcome(R.step_outcomes(p, "critical"), "critical")))


def q34_run_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return run_outcomes(ControlTables(spark, sf)).select(*R.OUTCOME_COLS)


def q35_error_text(spark: SparkSession, sf: str) -> DataFrame:
    return R.error_texts(ControlTables(spark, sf).d_run_steps)


def q39_statement_state(spark: SparkSession, sf: str) -> DataFrame:
    ev = ControlTables(spark, sf).d_job_runs.select(
        F.col("job_name").alias("statement_id"), "started", "seq", F.col("job_run_state").alias("state"))
    return R.statement_states(ev, aliases={"SUCCEEDED": R.FINISHED})


QUERIES.update({
    "q30_plan_order": q30_plan_order,
    "q31_halt_strict": q31_halt_strict,
    "q32_halt_critical": q32_halt_critical,
    "q33_retry_fold": q33_retry_fold,
    "q34_run_outcome": q34_run_outcome,
    "q35_error_text": q35_error_text,
    "q39_statement_state": q39_statement_state,
})


# ---------------------------------------------------------------- outputs

from arrivalgate.functions import text as FT  # noqa: E402
from arrivalgate.functions import timecols as TC  # noqa: E402
from arrivalgate.operators import outputs as O  # noqa: E402
from arrivalgate.streaming import streams as ST  # noqa: E402


def q36_notifications(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    trig = O.trigger_alerts(both_decisions(ct), P.ENV, P.JOBS)
    outcomes = R.run_outcome(R.step_outcomes(plan(ct), "strict"), "strict")
    runs = O.run_alerts(outcomes, P.ENV, P.REPORT_URL, F.col("run_id").cast("string"))
    return trig.unionByName(runs)


def q37_start_requests(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return O.start_requests(both_decisions(ct), P.JOBS)


# ------------------------------------------------- windows over event time

def _hourly(ct: ControlTables, **flags) -> DataFrame:
    ev = ct.events
    return (ev.groupBy(F.window("ts", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"),
                 *[F.count_if(c).alias(name) for name, c in flags.items()])
            .select(F.col("w.start").cast("timestamp_ntz").alias("hour_start"), "n_events", *flags))


def q20_cutoff_clock(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(ControlTables(spark, sf), n_inside=TC.in_window("ts", *P.EVENT_CUTOFF, form="clock"))


def q21_cutoff_fields(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(ControlTables(spark, sf), n_inside=TC.in_window("ts", *P.EVENT_CUTOFF, form="fields"))


def q22_delay_window(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(ControlTables(spark, sf),
                   n_delay_clock=TC.in_window("ts", *P.EVENT_DELAY, form="clock"),
                   n_delay_fields=TC.in_window("ts", *P.EVENT_DELAY, form="fields_strict_end"))


def q23_forced_start(spark: SparkSession, sf: str) -> DataFrame:
    c = P.EVENT_CUTOFF
    return _hourly(ControlTables(spark, sf), n_forced=TC.after_cutoff_plus("ts", c[0], c[1], *P.FORCE_EXTRA))


def q40_daily_loads(spark: SparkSession, sf: str) -> DataFrame:
    return ST.daily_loads(ControlTables(spark, sf).events)


def q41_first_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return ST.first_arrivals(ControlTables(spark, sf).events)


def q42_late_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return ST.late_arrivals(ST.first_arrivals(ControlTables(spark, sf).events), P.ARRIVAL_CUTOFF)


QUERIES.update({
    "q20_cutoff_clock": q20_cutoff_clock,
    "q21_cutoff_fields": q21_cutoff_fields,
    "q22_delay_window": q22_delay_window,
    "q23_forced_start": q23_forced_start,
    "q36_notifications": q36_notifications,
    "q37_start_requests": q37_start_requests,
    "q40_daily_loads": q40_daily_loads,
    "q41_first_arrivals": q41_first_arrivals,
    "q42_late_arrivals": q42_late_arrivals,
})


# ------------------------------------ runs: both executors, both audit tables

def run_closing(ct: ControlTables) -> DataFrame:
    """Strict outcomes of the SPDST/Others executor, one row per run."""
    return R.run_outcome(R.step_outcomes(plan(ct), "strict"), "strict")


def run_keys(ct: ControlTables) -> DataFrame:
    return ct.d_run_keys


def newest_run_keys(ct: ControlTables) -> DataFrame:
    """The newest run of each region and identifier: one change per report-master key."""
    keys = ct.d_run_keys
    newest = keys.groupBy("regionname", "identifier").agg(F.max("batchrundate").alias("batchrundate"))
    return keys.join(newest, ["regionname", "identifier", "batchrundate"])


def q43_legacy_alerts(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return O.legacy_alerts(legacy_delay(ct, decisions(ct, "legacy")), P.ENV, P.JOBS)


def q44_critical_run_alerts(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    outcomes = R.run_outcome(R.step_outcomes(plan(ct), "critical"), "critical")
    return O.run_alerts(outcomes, P.ENV, P.REPORT_URL, F.col("run_id").cast("string"))


def q45_bmt_plan_text_order(spark: SparkSession, sf: str) -> DataFrame:
    return bmt_plan(ControlTables(spark, sf)).select(
        "run_id", "exec_order", "stored_procedure_name", F.col("codebase").alias("files_received"), "duplicate_keys",
        FT.is_no_arg_call("stored_procedure_name").alias("no_arguments"))


def q46_bmt_run_alerts(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    outcomes = R.run_outcome(R.step_outcomes(bmt_plan(ct), "strict"), "strict_older")
    return O.run_alerts(outcomes, P.ENV, P.REPORT_URL, F.col("run_id").cast("string"), executor="bmt")


def q47_close_runs_log(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    log, _ = R.close_runs(run_closing(ct), run_keys(ct), P.NOW)
    return G.merge_log(ct.d_trigger_log, log)


def q48_close_runs_master(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    _, master = R.close_runs(run_closing(ct), newest_run_keys(ct), P.NOW)
    return G.merge_log(ct.d_report_master, master, ["regionname", "identifier"])


def q49_start_runs_master(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return G.merge_log(ct.d_report_master, R.start_runs(newest_run_keys(ct), P.NOW), ["regionname", "identifier"])


QUERIES.update({
    "q43_legacy_alerts": q43_legacy_alerts,
    "q44_critical_run_alerts": q44_critical_run_alerts,
    "q45_bmt_plan_text_order": q45_bmt_plan_text_order,
    "q46_bmt_run_alerts": q46_bmt_run_alerts,
    "q47_close_runs_log": q47_close_runs_log,
    "q48_close_runs_master": q48_close_runs_master,
    "q49_start_runs_master": q49_start_runs_master,
})


# -------------------------------------- arrivals still missing at the cutoff

import uuid  # noqa: E402

from arrivalgate.operators.loadstate import LoadState, fact_rows  # noqa: E402
from arrivalgate.session import ensure_checkpoint_dir  # noqa: E402
from arrivalgate.sources import fs  # noqa: E402
from arrivalgate.sources.dated import DatedTable  # noqa: E402
from arrivalgate.sources.named import NamedTables, in_folder  # noqa: E402
from arrivalgate.streaming import missing as M  # noqa: E402


def expected_arrivals(ct: ControlTables) -> DataFrame:
    """Every sender is due on every day of the events."""
    return M.expected_arrivals(ct.events, ct.events.select(F.to_date("ts").alias("day")), P.ARRIVAL_CUTOFF)


def q50_missing_at_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return M.missing_at_cutoff(expected_arrivals(ct), ct.events)


def q51_cutoff_messages(spark: SparkSession, sf: str) -> DataFrame:
    ct = ControlTables(spark, sf)
    return M.cutoff_messages(M.arrival_states(expected_arrivals(ct), ct.events))


# ------------------------------------------------- tables kept by batch date

def _store(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/store/{name}-{uuid.uuid4().hex}"


def q52_dated_log(spark: SparkSession, sf: str) -> DataFrame:
    """The trigger log kept by date: the closings of the BMT runs, then those of the others, merged into their dates."""
    ct = ControlTables(spark, sf)
    log = DatedTable(spark, _store(spark, "trigger-log"))
    log.replace(ct.d_trigger_log, 0)
    changes, _ = R.close_runs(run_closing(ct), run_keys(ct), P.NOW)
    for version, part in enumerate((F.col("report_source") == "BMT", F.col("report_source") != "BMT"), 1):
        log.update(changes.where(part), G.merge_log, version)
    return log.read()


def load_state(ct: ControlTables) -> LoadState:
    """The load log taken in by three parts, in no order of its rows, one of them twice."""
    state = LoadState(ct.spark, _store(ct.spark, "load-state"), P.FIXTURE_EMPTY_ERROR)
    part = F.pmod(F.xxhash64(*ct.d_audit_log.columns), F.lit(3))
    for version, i in enumerate((2, 0, 1, 0)):
        state.advance(ct.d_audit_log.where(part == i), version)
    return state


def q53_load_facts_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return fact_rows(load_state(ControlTables(spark, sf)).facts())


def q54_readiness_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """q18 without the load log: its facts come from the state."""
    ct = ControlTables(spark, sf)
    state = load_state(ct)
    facts = state.facts(files=FS.priority_files(ct.d_file_property, "bmt"))
    chain = file_chain(ct, "bmt", "bmt", facts=facts, scripts=state.scripts())
    return FS.readiness(chain["states"], "bmt").select(*FS.READINESS_COLS)


def q55_reference_dates_named(spark: SparkSession, sf: str) -> DataFrame:
    """q15 with a table of its own for every curated table that the load log names."""
    ct = ControlTables(spark, sf)
    pf = FS.priority_files(ct.d_file_property, "other")
    loaded = FS.curated_loaded(ct.d_audit_log, pf)
    tables = NamedTables(spark, in_folder(spark, ct.folders_of("d_curated_ref", "table_name"), "table_name="))
    return FS.reference_dates_named(loaded, ct.d_audit_log, tables, FS.name_posts(pf))


QUERIES.update({
    "q50_missing_at_cutoff": q50_missing_at_cutoff,
    "q51_cutoff_messages": q51_cutoff_messages,
    "q52_dated_log": q52_dated_log,
    "q53_load_facts_incremental": q53_load_facts_incremental,
    "q54_readiness_incremental": q54_readiness_incremental,
    "q55_reference_dates_named": q55_reference_dates_named,
})


# ------------------------------------------------------ listings, appends, streams

from arrivalgate.sources.listing import ListingTable, bucket_name  # noqa: E402
from arrivalgate.sources.once import AppendOnce  # noqa: E402
from arrivalgate.streaming import statements as SS  # noqa: E402

OBJECT_ROWS = 1000      # rows of the stand-in listing per stored object
ZONE_FOLDERS = ("zone=LandingZone", "zone=ArchiveZone")


def stored_objects(ct: ControlTables) -> tuple[dict[str, str], list]:
    """The zones of every region as objects in storage (one per ``OBJECT_ROWS`` rows of
    the stand-in listing): the regions' buckets (F11), and the dates."""
    path = ct._path("objects-by-bucket")
    bucket = F.concat(F.lit("files-"), F.lit(P.ENV), F.lit("-"), F.lower("regionname"))
    zone = F.substring_index("object_key", "/", 1)
    listing = zones(ct)
    if not fs.exists(ct.spark, f"{path}/_SUCCESS"):
        # the folder names are made after the shuffle, from the columns that it moves anyway
        (listing.repartition(bucket, zone, "batchrundate")
         .select(bucket.alias("bucket"), zone.alias("zone"), F.col("batchrundate").alias("dt"), "object_key")
         .write.option("maxRecordsPerFile", OBJECT_ROWS)
         .partitionBy("bucket", "zone", "dt").parquet(path))
    days = [r[0] for r in ct.d_batch_dates.collect()] + [r[0] for r in listing.select("batchrundate").distinct().collect()]
    regions = [r[0] for r in ct.d_schedule.select("regionname").distinct().collect()]
    return {r: f"{path}/bucket={bucket_name(P.BUCKET, P.ENV, r)}" for r in regions}, sorted(set(days))


def q56_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Objects per region, zone and date, from a listing kept by date: all dates but the newest first, then all that may still change."""
    roots, days = stored_objects(ControlTables(spark, sf))
    table = ListingTable(spark, _store(spark, "listing"), roots, ZONE_FOLDERS)
    table.refresh(days[:-1], 0)
    table.refresh(days, 1, closed=days[:-1])
    zone = F.substring(F.substring_index("object_key", "/", 1), 6, 100)
    return table.read().groupBy("regionname", "batchrundate", zone.alias("zone")).agg(F.count(F.lit(1)).alias("n_objects"))


def q57_alerts_once(spark: SparkSession, sf: str) -> DataFrame:
    """The alerts of both executors' runs, appended by two cycles of which the first ran twice."""
    notes = AppendOnce(spark, _store(spark, "notifications"))
    for batch, alerts in ((0, q46_bmt_run_alerts), (0, q46_bmt_run_alerts), (1, q44_critical_run_alerts)):
        notes.append(alerts(spark, sf), "executors", batch)
    return notes.read().select(*O.NOTIFY_COLS, "batch")


def _available_now(stream: DataFrame, store: str, mode: str) -> DataFrame:
    """What a stream gives for everything that is there now, each micro-batch in a folder of its own."""
    def keep(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{store}/rows/batch={batch_id}")

    (stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{store}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).option("basePath", f"{store}/rows").parquet(f"{store}/rows/*")


def q58_missing_stream(spark: SparkSession, sf: str) -> DataFrame:
    """q50 as a stream: every sender still missing at the cutoff of every day but the last, which is still open."""
    ct = ControlTables(spark, sf)
    store = _store(spark, "missing")
    due = expected_arrivals(ct)
    due.write.parquet(f"{store}/due")
    expected = spark.readStream.schema(due.schema).parquet(f"{store}/due")
    events = ct.stream("d_step_attempts").select(F.col("step_id").alias("user_id"), F.col("started").alias("ts"))
    return _available_now(M.missing_stream(expected, events, P.ARRIVAL_CUTOFF), store, "append").select("user_id", "day_start", "cutoff_at")


def q59_statement_stream(spark: SparkSession, sf: str) -> DataFrame:
    """q39 as a stream of state events."""
    ct = ControlTables(spark, sf)
    ev = ct.stream("d_job_runs").select(F.col("job_name").alias("statement_id"), "started", "seq", F.col("job_run_state").alias("state"))
    got = SS.statement_states_stream(ev, aliases={"SUCCEEDED": R.FINISHED}, watermark="60 days")
    return SS.newest_states(_available_now(got, _store(spark, "statements"), "update")).drop("closed")


def open_days(ct: ControlTables) -> DataFrame:
    """The days on which two or more regions' BMT refresh is delayed."""
    late = ct.d_trigger_log.where("report_source = 'BMT' and execution_status = 'Delay'")
    return late.groupBy("batchrundate").agg(F.countDistinct("regionname").alias("n")).where("n >= 2").select("batchrundate")


def q60_readiness_open_days(spark: SparkSession, sf: str) -> DataFrame:
    """q18 for the open days only, over a load log and zones stored by date: the other days' folders are not read."""
    ct = ControlTables(spark, sf).by_date("d_audit_log", "d_landing", "d_archive")
    ct._cache["d_batch_dates"] = open_days(ct)
    return FS.readiness(file_chain(ct, "bmt", "bmt")["states"], "bmt").select(*FS.READINESS_COLS)


QUERIES.update({
    "q56_listing": q56_listing,
    "q57_alerts_once": q57_alerts_once,
    "q58_missing_stream": q58_missing_stream,
    "q59_statement_stream": q59_statement_stream,
    "q60_readiness_open_days": q60_readiness_open_days,
})
