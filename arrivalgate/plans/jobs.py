"""The trigger cycle as one Spark job over all regions and batch dates.

One action computes the decisions of both triggers and stores them in the
shared checkpoint folder; the trigger-log snapshot (merge), the start
requests and the notifications all follow from that stored result, so the
file-readiness chain runs once however many outputs read it.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivalgate.operators import files as FS
from arrivalgate.operators import gate as G
from arrivalgate.operators import outputs as O
from arrivalgate.operators import schedule as S
from arrivalgate.operators.loadstate import LoadState
from arrivalgate.session import materialize
from arrivalgate.sources import sinks
from arrivalgate.sources.dated import DatedTable
from arrivalgate.sources.named import NamedTables
from arrivalgate.sources.once import AppendOnce


def _states(t: dict, cal: DataFrame, facts: DataFrame, scripts: DataFrame | None, spdst_rule: str, metadata_prefix: str,
            curated: NamedTables | None) -> DataFrame:
    """The states of both triggers' files, from one pass over the inputs."""
    pf = FS.trigger_files(t["expected_files"], spdst_rule)
    expected, posts = FS.expected_by_date(cal, pf), FS.name_posts(pf)
    log = FS.restrict_to_dates(t["load_log"], cal) if "load_log" in t else None
    mapped = FS.map_procedures(FS.curated_loaded(None, pf, facts), t["file_procs"], catalog=pf, posts=posts)
    pub = FS.published(mapped, log, scripts)
    receipts = FS.received_flags(FS.restrict_to_dates(t["landing"], cal), expected, metadata_prefix, posts)
    refd = None
    if spdst_rule == "legacy":
        if curated is not None:
            refd = FS.reference_dates_named(pub, log, curated, posts)
        elif "curated_ref" in t:
            refd = FS.reference_dates(pub, log, FS.restrict_to_dates(t["curated_ref"], cal), posts)
        else:
            raise ValueError("the legacy rule needs curated_ref or curated_tables")
    return FS.trigger_states(expected, pub, receipts, facts, refd)


def _check_inputs(t: dict[str, DataFrame], out_dir: str, kinds: list[str], version: int) -> None:
    """Refuse to overwrite a folder that an input is read from."""
    for kind in kinds:
        target = sinks.version_path(os.path.join(out_dir, kind), version)
        plain = target.split(":", 1)[-1].lstrip("/")
        for name, df in t.items():
            if any(plain in f for f in df.inputFiles()):
                raise ValueError(f"version {version} of {kind} is where {name} is read from")


def trigger_cycle(t: dict[str, DataFrame], batch_dates: DataFrame, now: Column, out_dir: str, version: int, *,
                  env: str, jobs: dict[str, str], cutoff: tuple, force_extra: tuple, delay_window: tuple,
                  metadata_prefix: str, empty_error: str, spdst_rule: str = "current",
                  legacy_delay_window: tuple | None = None, legacy_delay_step: dict | None = None,
                  today=None, report_now=None, load_state: LoadState | None = None,
                  log_table: DatedTable | None = None, messages: AppendOnce | None = None,
                  requests: AppendOnce | None = None, curated_tables: NamedTables | None = None) -> dict[str, str]:
    """Evaluate both triggers for the given batch dates and write their outputs.

    ``batch_dates`` (column ``batchrundate``) are the days to evaluate, today's
    in a daily run: each is evaluated for every scheduled region, whether or
    not the log has a row for it, and other days are left alone.

    ``t`` holds the control tables: schedule, trigger_log, expected_files,
    load_log, file_procs, landing, dependency, job_runs (and curated_ref for
    the legacy rule). ``now`` is the evaluation time (a Column). Outputs are
    written under ``out_dir/<kind>/v=<version>`` for ``decisions``,
    ``trigger_log`` (the new snapshot; never the one read), ``start_requests``
    and ``notifications``; a re-run of the same version rewrites only its own
    outputs. With ``report_master`` among the tables (and ``today`` and
    ``report_now``), the reports' windows and statuses are updated too (K07,
    K08), as the reference does on every trigger. Under the legacy rule the
    legacy messages are sent, with the delay alert of ``legacy_delay_window``.

    With ``load_state`` (the load log's facts, kept up to date by its new rows) the
    load log itself is not read, except by the legacy rule for the names of curated
    tables. With ``log_table`` the trigger log is that table, kept by date: it needs no
    ``trigger_log`` among the tables, and only the evaluated dates of it are written, as
    its version ``version`` (done once, however often the cycle runs again).
    """
    kinds = ["decisions", "start_requests", "notifications", "report_master"]
    if log_table is None:
        kinds.append("trigger_log")
    else:
        # a cycle that runs again reads the log as it was before its own version
        t = {**t, "trigger_log": log_table.read(version=log_table.newest(before=version))}
    _check_inputs(t, out_dir, kinds, version)
    busy = G.busy_regions(t["dependency"], t["job_runs"])
    cal = FS.calendar(batch_dates, t["schedule"])
    # Both triggers read the same facts of the load log: summarised once, stored.
    scripts = None
    if load_state is None:
        facts = FS.load_facts(FS.restrict_to_dates(t["load_log"], cal), empty_error)
    else:
        days = [r[0] for r in batch_dates.select("batchrundate").distinct().collect()]      # bounded by the calendar
        facts, scripts = load_state.facts(days), load_state.scripts(days)
    facts = materialize(facts)
    windows = S.expected_window(t["schedule"], cal)
    states = _states(t, cal, facts, scripts, spdst_rule, metadata_prefix, curated_tables)
    # One action: the decisions of both triggers (with the failed files the
    # alerts need), stored in the shared folder; every output reads them.
    decisions = materialize(G.decide_both(windows, t["trigger_log"], FS.readiness(states, "each"), busy,
                                          G.upstream_finished(t["trigger_log"], cal), now, cutoff, force_extra, delay_window, spdst_rule))
    bmt = decisions.where(F.col("report_source") == "BMT")
    spdst = decisions.where(F.col("report_source") == "SPDST")
    if spdst_rule == "legacy":
        spdst_alerts = O.legacy_alerts(G.with_next_day_delay(
            spdst, t["trigger_log"], now, legacy_delay_window or delay_window, **(legacy_delay_step or {})), env, jobs)
    else:
        spdst_alerts = O.current_alerts(spdst, env)
    outputs = {
        "decisions": decisions.select(*G.DECISION_COLS),
        "start_requests": O.start_requests(decisions, jobs),
        "notifications": O.bmt_alerts(bmt, env, jobs).unionByName(spdst_alerts),
    }
    if "report_master" in t:
        outputs["report_master"] = S.report_status(S.report_window(t["report_master"], today), report_now)
    changes = G.log_changes(decisions, jobs)
    if log_table is None:
        outputs["trigger_log"] = G.merge_log(t["trigger_log"], changes)
    written = {}
    for kind, table in (("notifications", messages), ("start_requests", requests)):
        if table is not None:
            table.append(outputs.pop(kind), "cycle", version)
            written[kind] = table.base
    written |= {k: sinks.write_version(df, os.path.join(out_dir, k), version) for k, df in outputs.items()}
    if log_table is not None:
        # last, so that a cycle that fails before is decided anew in full
        log_table.update(changes, G.merge_log, version)
        written["trigger_log"] = log_table.base
    return written
