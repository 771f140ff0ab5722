"""DuckDB oracle SQL for every registered query.

Written independently of the Spark operators, in plain SQL (correlated
EXISTS, LIKE-free ``contains``, scalar aggregates) over the same stand-in
views, which are inlined as CTEs in dependency order.
"""

from __future__ import annotations

import re

from arrivalgate.plans import params as P
from arrivalgate.sources.fixtures import DERIVED_SQL, duckdb_view_sql

# Helper CTEs of the oracle (DuckDB dialect). Names refer to fixture views
# (d_*) or to other helpers.
HELPERS: dict[str, str] = {
    "pf_bmt": "SELECT region AS regionname, filename FROM d_file_property WHERE priorityflag = 'YES' AND data_source = 'BMT'",
    "pf_other": "SELECT region AS regionname, filename FROM d_file_property WHERE priorityflag = 'YES' AND NOT (data_source LIKE 'BMT%')",
    "pf_all": "SELECT region AS regionname, filename FROM d_file_property WHERE priorityflag = 'YES'",
    "cal": "SELECT d.batchrundate, s.regionname FROM (SELECT DISTINCT batchrundate FROM d_batch_dates) d, (SELECT DISTINCT regionname FROM d_schedule) s",
    "zones": "SELECT * FROM d_landing UNION ALL SELECT * FROM d_archive",
    "objs": f"""SELECT regionname, batchrundate, regexp_extract(object_key, '[^/]*$') AS name FROM zones
        WHERE length(regexp_extract(object_key, '[^/]*$')) > 0 AND NOT starts_with(regexp_extract(object_key, '[^/]*$'), '{P.FIXTURE_METADATA_PREFIX}')""",
    "fails": """SELECT batchrundate, filename, array_to_string(list_sort(list_distinct(list(processname))), ',') AS failed_processes,
        CAST(count(DISTINCT processname) AS BIGINT) AS n_failed_processes FROM d_audit_log WHERE executionstatus = 'Failed' GROUP BY 1, 2""",
    "empties": f"""SELECT DISTINCT batchrundate, filename FROM d_audit_log WHERE processname = 'DataValidation'
        AND contains(errormessage, '{P.FIXTURE_EMPTY_ERROR}') AND ends_with(sourcename, '.dat')""",
}


def _chain(src: str) -> dict[str, str]:
    """Curated -> procedure -> published chain for one priority list."""
    return {
        f"exp_{src}": f"SELECT c.batchrundate, c.regionname, p.filename FROM cal c JOIN pf_{src} p ON p.regionname = c.regionname",
        f"cur_{src}": f"""SELECT DISTINCT a.batchrundate, a.regionname, a.filename FROM d_audit_log a
            WHERE a.processname = 'RedshiftCuratedLoad' AND a.executionstatus = 'Succeeded'
            AND EXISTS (SELECT 1 FROM pf_{src} p WHERE p.regionname = a.regionname AND p.filename = a.filename)""",
        f"fp_{src}": f"""SELECT p.regionname, p.filename, min(s.stored_procedure_name) AS stored_procedure_name
            FROM (SELECT DISTINCT regionname, filename FROM pf_{src}) p
            JOIN d_sp_map s ON s.regionname = p.regionname AND contains(s.source_filename, p.filename) GROUP BY 1, 2""",
        f"pub_{src}": f"""SELECT c.batchrundate, c.regionname, c.filename FROM cur_{src} c
            JOIN fp_{src} f ON f.regionname = c.regionname AND f.filename = c.filename
            WHERE EXISTS (SELECT 1 FROM d_audit_log a WHERE a.batchrundate = c.batchrundate AND a.regionname = c.regionname
              AND a.processname = 'RedshiftPublishedLoad' AND a.executionstatus = 'Succeeded' AND a.scriptpath = f.stored_procedure_name)""",
    }


for _s in ("bmt", "other", "all"):
    HELPERS.update(_chain(_s))

HELPERS["refd_other"] = """
SELECT t.batchrundate, t.regionname, t.filename, max(r.reference_dt) AS reference_dt
FROM (SELECT p.batchrundate, p.regionname, p.filename, min(a.destinationname) AS table_name
      FROM (SELECT * FROM pub_other WHERE right(filename, 3) = 'PND') p
      JOIN d_audit_log a ON a.batchrundate = p.batchrundate AND a.regionname = p.regionname
       AND a.processname = 'RedshiftCuratedLoad' AND a.executionstatus = 'Succeeded' AND contains(a.filename, p.filename)
      GROUP BY 1, 2, 3) t
JOIN d_curated_ref r ON r.batchrundate = t.batchrundate AND r.table_name = t.table_name AND contains(r.source_nm, t.filename)
GROUP BY 1, 2, 3"""


def _flags(exp: str, pub: str, rec: str) -> str:
    """Per expected file: published / received / empty flags and failed list."""
    if rec == "exact":
        rec_pred = "left(split_part(o.name, '.', 1), greatest(length(split_part(o.name, '.', 1)) - 15, 0)) = e.filename"
    else:
        rec_pred = "contains(o.name, e.filename)"
    return f"""SELECT e.batchrundate, e.regionname, e.filename,
  EXISTS (SELECT 1 FROM {pub} p WHERE p.batchrundate = e.batchrundate AND p.regionname = e.regionname AND p.filename = e.filename) AS pub,
  EXISTS (SELECT 1 FROM objs o WHERE o.batchrundate = e.batchrundate AND o.regionname = e.regionname AND {rec_pred}) AS rec,
  EXISTS (SELECT 1 FROM empties m WHERE m.batchrundate = e.batchrundate AND m.filename = e.filename) AS emp,
  (SELECT f.failed_processes FROM fails f WHERE f.batchrundate = e.batchrundate AND f.filename = e.filename) AS fp
FROM {exp} e"""


HELPERS["flags_bmt"] = _flags("exp_bmt", "pub_bmt", "contains")
HELPERS["flags_legacy"] = _flags("exp_other", "pub_other", "contains")
HELPERS["flags_current"] = _flags("exp_other", "pub_other", "exact")
HELPERS["states_bmt"] = """SELECT batchrundate, regionname, filename,
  CASE WHEN pub THEN 'done' WHEN emp THEN 'done' WHEN fp IS NOT NULL THEN 'failed' WHEN rec THEN 'in_progress' ELSE 'missing' END AS state,
  CASE WHEN NOT pub AND NOT emp AND fp IS NOT NULL THEN fp END AS detail FROM flags_bmt"""
HELPERS["states_legacy"] = """SELECT f.batchrundate, f.regionname, f.filename,
  CASE WHEN f.pub AND right(f.filename, 3) = 'PND' AND coalesce(r.reference_dt = CAST(f.batchrundate - INTERVAL 1 DAY AS DATE), false) THEN 'done'
       WHEN f.pub AND right(f.filename, 3) = 'PND' THEN 'failed'
       WHEN f.pub THEN 'done' WHEN f.emp THEN 'done' WHEN f.fp IS NOT NULL THEN 'failed' WHEN f.rec THEN 'in_progress' ELSE 'missing' END AS state,
  CASE WHEN f.pub AND right(f.filename, 3) = 'PND' AND NOT coalesce(r.reference_dt = CAST(f.batchrundate - INTERVAL 1 DAY AS DATE), false)
         THEN 'Reference_Dt not correct of the file. It should be current_dt - 1'
       WHEN NOT f.pub AND NOT f.emp AND f.fp IS NOT NULL THEN f.fp END AS detail
FROM flags_legacy f LEFT JOIN refd_other r ON r.batchrundate = f.batchrundate AND r.regionname = f.regionname AND r.filename = f.filename"""
HELPERS["states_current"] = """SELECT batchrundate, regionname, filename,
  CASE WHEN pub AND (rec OR fp IS NOT NULL) THEN 'done' ELSE 'missing' END AS state, CAST(NULL AS VARCHAR) AS detail FROM flags_current"""


def _readiness(states: str, rule: str) -> str:
    ready = "count(*) FILTER (WHERE state = 'done') >= count(*)" if rule == "bmt" else \
        "count(*) FILTER (WHERE state = 'done') = count(*)"
    names = ("CASE WHEN arg_max(state, filename) FILTER (WHERE state IN ('missing', 'failed')) = 'failed' "
             "THEN max(filename) FILTER (WHERE state IN ('missing', 'failed')) "
             "WHEN arg_max(state, filename) FILTER (WHERE state IN ('missing', 'failed')) = 'missing' "
             "THEN coalesce(string_agg(filename, ',' ORDER BY filename) FILTER (WHERE state = 'missing'), '') ELSE '' END"
             if rule == "bmt" else
             "coalesce(string_agg(filename, ',' ORDER BY filename) FILTER (WHERE state = 'missing'), '')")
    return f"""SELECT batchrundate, regionname, count(*) AS expected,
  count(*) FILTER (WHERE state = 'done') AS done, count(*) FILTER (WHERE state = 'missing') AS missing,
  count(*) FILTER (WHERE state = 'failed') AS failed, count(*) FILTER (WHERE state = 'in_progress') AS in_progress,
  {ready} AS ready,
  coalesce(string_agg(filename, ',' ORDER BY filename) FILTER (WHERE state = 'missing'), '') AS missing_names,
  coalesce(string_agg(filename, ',' ORDER BY filename) FILTER (WHERE state = 'failed'), '') AS failed_names,
  {names} AS names
FROM {states} GROUP BY 1, 2"""


HELPERS["ready_bmt"] = _readiness("states_bmt", "bmt")
HELPERS["ready_legacy"] = _readiness("states_legacy", "legacy")
HELPERS["ready_current"] = _readiness("states_current", "current")


# ---------------------------------------------------------------- gate
HELPERS["sched_src"] = """SELECT regionname, report_source, expected_start_time, average_runtime FROM (
  SELECT s.regionname, x.src AS report_source, s.expected_start_time, s.average_runtime,
         row_number() OVER (PARTITION BY s.regionname, x.src ORDER BY s.expected_start_time, s.average_runtime) AS rn
  FROM d_schedule s JOIN (SELECT 'BMT' AS src UNION ALL SELECT 'SPDST') x
    ON (x.src = 'BMT' AND s.report_source = 'BMT') OR (x.src = 'SPDST' AND contains(s.report_source, 'SPDST'))) z WHERE rn = 1"""
HELPERS["win"] = """SELECT c.batchrundate, c.regionname, s.report_source,
  c.batchrundate + CAST(s.expected_start_time AS TIME) AS expected_start,
  c.batchrundate + (CAST(s.expected_start_time AS TIME) + INTERVAL (s.average_runtime) MINUTE) AS expected_end,
  dayname(c.batchrundate) AS day_name
FROM cal c JOIN sched_src s ON s.regionname = c.regionname"""
HELPERS["latest_run"] = """SELECT job_name, job_run_state FROM (SELECT job_name, job_run_state,
  row_number() OVER (PARTITION BY job_name ORDER BY started DESC, seq DESC) AS rn FROM d_job_runs) z WHERE rn = 1"""
HELPERS["busy"] = """SELECT d.regionname,
  bool_or(coalesce(l.job_run_state IN ('STARTING', 'RUNNING', 'STOPPING'), false)) AS busy,
  count(*) FILTER (WHERE l.job_run_state IN ('STARTING', 'RUNNING', 'STOPPING')) AS busy_jobs
FROM d_dependency d LEFT JOIN latest_run l ON l.job_name = d.job_name GROUP BY 1"""
HELPERS["upstream"] = """SELECT c.batchrundate, c.regionname, EXISTS (SELECT 1 FROM d_trigger_log t WHERE t.batchrundate = c.batchrundate
  AND t.regionname = c.regionname AND t.report_source = 'BMT' AND t.execution_status = 'Finished') AS upstream_finished FROM cal c"""

GATE_NOW = "CAST(w.batchrundate AS TIMESTAMP) + INTERVAL 12 HOUR + INTERVAL 1 MINUTE * (7 * month(w.batchrundate))"


def _clock_in(now: str, win: tuple) -> str:
    sh, sm, eh, em = win
    return f"(hour({now}) * 60 + minute({now})) BETWEEN {sh * 60 + sm} AND {eh * 60 + em}"


def _fields_in(now: str, win: tuple) -> str:
    sh, sm, eh, _ = win
    return f"(hour({now}) >= {sh} AND minute({now}) >= {sm} AND hour({now}) <= {eh})"


def _decide(rule: str) -> str:
    src = "BMT" if rule == "bmt" else "SPDST"
    in_cut = _clock_in("now", P.CUTOFF) if rule == "current" else _fields_in("now", P.CUTOFF)
    ready = "done >= expected" if rule == "bmt" else "done = expected AND up"
    forced = (f"WHEN hour(now) >= {P.CUTOFF[0] + P.FORCE_EXTRA[0]} AND minute(now) >= {P.CUTOFF[1] + P.FORCE_EXTRA[1]} "
              "THEN 'forced_start'") if rule == "bmt" else ""
    if rule == "current":
        cut = "'Cut off time Reached: Missing ' || CAST(missing AS VARCHAR) || ' files'"
        pend = "'Pending files: ' || CAST(missing AS VARCHAR)"
    else:
        cut = "'Cut off time Reached and priority files not received' || names"
        pend = "'PF Missing ' || names"
    init = {"current": "SPDST report refresh pending initialization", "bmt": "BMT report refresh yet to start",
            "legacy": "SPDST report refresh yet to start"}[rule]
    start_msg = "NULL" if rule == "bmt" else "NA"
    flag = ("CASE action WHEN 'forced_start' THEN 'N' WHEN 'start' THEN 'Y' END" if rule == "bmt"
            else "CAST(NULL AS VARCHAR)")
    alert = (f"action IN ('start', 'cutoff', 'pending') AND {_clock_in('now', P.DELAY_WINDOW)}"
             if rule == "current" else "false")
    up = "coalesce(u.upstream_finished, false)" if rule != "bmt" else "true"
    return f"""SELECT batchrundate, regionname, report_source, action,
  CASE WHEN action = 'insert' THEN 'Yet to start' WHEN action IN ('start', 'forced_start') THEN 'Submitted'
       WHEN action IN ('blocked', 'cutoff', 'pending') AND past THEN 'Delay' ELSE old_status END AS execution_status,
  CASE WHEN action = 'insert' THEN '{init}' WHEN action = 'forced_start' THEN 'NULL' WHEN action = 'start' THEN '{start_msg}'
       WHEN action = 'blocked' AND past THEN 'Other Region Report Refresh is already running'
       WHEN action = 'cutoff' AND past THEN {cut}
       WHEN action = 'pending' AND past THEN {pend} ELSE old_message END AS error_message,
  CASE WHEN action IN ('start', 'forced_start') THEN now ELSE old_actual END AS actual_start_time,
  {flag} AS priority_files_received, missing, names, missing_names, {alert} AS delay_alert, expected_start, expected_end
FROM (SELECT *, CASE WHEN NOT has_row THEN 'insert' WHEN old_status IN ('Finished', 'Submitted') THEN 'none'
    WHEN busy THEN 'blocked' {forced} WHEN {ready} THEN 'start' WHEN done <> expected AND {in_cut} THEN 'cutoff'
    ELSE 'pending' END AS action
  FROM (SELECT w.batchrundate, w.regionname, w.report_source, {GATE_NOW} AS now,
          {GATE_NOW} > w.expected_start AS past, t.batchrundate IS NOT NULL AS has_row, t.execution_status AS old_status, t.error_message AS old_message,
          t.actual_start_time AS old_actual, w.expected_start, w.expected_end,
          coalesce(r.expected, 0) AS expected, coalesce(r.done, 0) AS done, coalesce(r.missing, 0) AS missing,
          coalesce(r.names, '') AS names, coalesce(r.missing_names, '') AS missing_names, coalesce(b.busy, false) AS busy, {up} AS up
        FROM win w
        LEFT JOIN d_trigger_log t ON t.batchrundate = w.batchrundate AND t.regionname = w.regionname AND t.report_source = w.report_source
        LEFT JOIN ready_{rule} r ON r.batchrundate = w.batchrundate AND r.regionname = w.regionname
        LEFT JOIN busy b ON b.regionname = w.regionname
        LEFT JOIN upstream u ON u.batchrundate = w.batchrundate AND u.regionname = w.regionname
        WHERE w.report_source = '{src}') z1) z2"""


for _r in ("current", "bmt", "legacy"):
    HELPERS[f"decide_{_r}"] = _decide(_r)

HELPERS["legacy_delay"] = f"""SELECT batchrundate, regionname, next_status, in_window,
  in_window AND action IN ('start', 'cutoff', 'pending') AND (next_status IS NULL OR next_status = 'Failed') AS alert
FROM (SELECT c.batchrundate, c.regionname, c.action, n.execution_status AS next_status, (hour(now) >= {P.LEGACY_DELAY_WINDOW[0]} AND minute(now) >= {P.LEGACY_DELAY_WINDOW[1]} AND hour(now) <= {P.LEGACY_DELAY_WINDOW[2]} AND minute(now) < {P.LEGACY_DELAY_WINDOW[3]}) AS in_window
  FROM (SELECT *, CAST(batchrundate AS TIMESTAMP) + INTERVAL 12 HOUR + INTERVAL 1 MINUTE * (7 * month(batchrundate)) AS now FROM decide_legacy) c
  LEFT JOIN d_trigger_log n ON n.regionname = c.regionname AND n.report_source = 'SPDST'
    AND n.batchrundate = CAST(c.batchrundate + INTERVAL {P.BATCH_STEP_MONTHS} MONTH AS DATE)) z"""

HELPERS["report_win"] = f"""SELECT *,
  d + CAST(expected_start_time AS TIME) AS expected_start,
  d + (CAST(expected_start_time AS TIME) + INTERVAL (average_runtime) MINUTE) AS expected_end
FROM (SELECT *, CASE WHEN report_refresh_frequency IN ('Monthly', 'Quarterly', 'Weekly', 'Yearly')
  THEN CAST(regexp_split_to_array(trim(file_arrival_cutoff_datetime), '\\s+')[1] AS DATE) ELSE DATE '{P.TODAY}' END AS d
  FROM d_report_master) z"""

BODIES: dict[str, str] = {
    "q05_priority_bmt": "SELECT regionname, filename FROM pf_bmt",
    "q06_priority_other": "SELECT regionname, filename FROM pf_other",
    "q07_curated_loaded": "SELECT * FROM cur_bmt",
    "q08_file_procedure": "SELECT * FROM fp_bmt",
    "q09_published_files": "SELECT * FROM pub_bmt",
    "q10_unpublished_files": """SELECT e.* FROM exp_bmt e WHERE NOT EXISTS (SELECT 1 FROM pub_bmt p
        WHERE p.batchrundate = e.batchrundate AND p.regionname = e.regionname AND p.filename = e.filename)""",
    "q11_received_exact": """SELECT e.* FROM exp_all e WHERE EXISTS (SELECT 1 FROM objs o WHERE o.batchrundate = e.batchrundate
        AND o.regionname = e.regionname AND left(split_part(o.name, '.', 1), greatest(length(split_part(o.name, '.', 1)) - 15, 0)) = e.filename)""",
    "q12_received_contains": """SELECT e.* FROM exp_all e WHERE EXISTS (SELECT 1 FROM objs o WHERE o.batchrundate = e.batchrundate
        AND o.regionname = e.regionname AND contains(o.name, e.filename))""",
    "q13_failed_processes": "SELECT * FROM fails",
    "q14_empty_source_files": "SELECT * FROM empties",
    "q15_reference_date_check": """
SELECT t.batchrundate, t.regionname, t.filename, max(r.reference_dt) AS reference_dt,
       max(r.reference_dt) = CAST(t.batchrundate - INTERVAL 1 DAY AS DATE) AS ref_ok
FROM (SELECT p.batchrundate, p.regionname, p.filename, min(a.destinationname) AS table_name
      FROM (SELECT * FROM cur_other WHERE right(filename, 3) = 'PND') p
      JOIN d_audit_log a ON a.batchrundate = p.batchrundate AND a.regionname = p.regionname
       AND a.processname = 'RedshiftCuratedLoad' AND a.executionstatus = 'Succeeded' AND contains(a.filename, p.filename)
      GROUP BY 1, 2, 3) t
JOIN d_curated_ref r ON r.batchrundate = t.batchrundate AND r.table_name = t.table_name AND contains(r.source_nm, t.filename)
GROUP BY 1, 2, 3""",
    "q16_file_state_bmt": "SELECT * FROM states_bmt",
    "q16b_file_state_legacy": "SELECT * FROM states_legacy",
    "q17_file_state_current": "SELECT * FROM states_current",
    "q18_readiness": "SELECT * FROM ready_bmt",
}

BODIES.update({
    "q01_expected_window": "SELECT * FROM win",
    "q02_initial_log_rows": f"""SELECT w.batchrundate, w.regionname, 'Yet to start' AS execution_status,
  CASE w.report_source WHEN 'BMT' THEN '{P.JOBS["BMT"]}' WHEN 'SPDST' THEN '{P.JOBS["SPDST"]}' END AS gluejob, w.report_source,
  w.expected_start AS expected_start_time, w.expected_end AS expected_end_time,
  CASE w.report_source WHEN 'BMT' THEN 'BMT report refresh yet to start' WHEN 'SPDST' THEN 'SPDST report refresh pending initialization' END AS error_message
FROM win w WHERE NOT EXISTS (SELECT 1 FROM d_trigger_log t WHERE t.batchrundate = w.batchrundate AND t.regionname = w.regionname AND t.report_source = w.report_source)""",
    "q03_already_triggered": "SELECT *, coalesce(execution_status IN ('Finished', 'Submitted'), false) AS already_triggered FROM d_trigger_log",
    "q04_busy_regions": "SELECT * FROM busy",
    "q19_upstream_finished": "SELECT * FROM upstream",
    "q24_decide_current": "SELECT * EXCLUDE (expected_start, expected_end) FROM decide_current",
    "q25_decide_bmt": "SELECT * EXCLUDE (expected_start, expected_end) FROM decide_bmt",
    "q26_decide_legacy": "SELECT * EXCLUDE (expected_start, expected_end) FROM decide_legacy",
    "q27_merged_log": f"""SELECT coalesce(o.batchrundate, n.batchrundate) AS batchrundate, coalesce(o.regionname, n.regionname) AS regionname,
  coalesce(n.execution_status, o.execution_status) AS execution_status,
  CASE WHEN n.action = 'insert' THEN CASE n.report_source WHEN 'BMT' THEN '{P.JOBS["BMT"]}' ELSE '{P.JOBS["SPDST"]}' END ELSE o.gluejob END AS gluejob,
  coalesce(o.report_source, n.report_source) AS report_source,
  CASE WHEN n.action = 'insert' THEN n.expected_start ELSE o.expected_start_time END AS expected_start_time,
  CASE WHEN n.action = 'insert' THEN n.expected_end ELSE o.expected_end_time END AS expected_end_time,
  coalesce(n.error_message, o.error_message) AS error_message, coalesce(n.actual_start_time, o.actual_start_time) AS actual_start_time,
  o.actual_end_time
FROM d_trigger_log o FULL OUTER JOIN (SELECT * FROM decide_current UNION ALL SELECT * FROM decide_bmt) n
  ON n.batchrundate = o.batchrundate AND n.regionname = o.regionname AND n.report_source = o.report_source""",
    "q28_report_window": "SELECT * EXCLUDE (d) FROM report_win",
    "q29_report_status": f"""SELECT report_name, regionname, identifier, expected_start,
  CASE WHEN NOT coalesce(CAST(actual_start_time AS DATE) = CAST(expected_start AS DATE), false) THEN 'Null'
       WHEN TIMESTAMP '{P.NOW}' <= expected_start AND coalesce(status = 'Null', false) THEN 'Yet to start'
       WHEN TIMESTAMP '{P.NOW}' <= expected_start AND coalesce(status = 'Completed', false) THEN 'Completed'
       WHEN TIMESTAMP '{P.NOW}' >= expected_start AND NOT coalesce(status = 'Completed', false) THEN 'Delay'
       WHEN TIMESTAMP '{P.NOW}' >= expected_start AND coalesce(status = 'Completed', false) THEN 'Completed'
       ELSE coalesce(status, 'None') END AS status
FROM report_win""",
    "q38_next_day_delay": "SELECT * FROM legacy_delay",
})

# ---------------------------------------------------------------- runs
_POSK = "try_cast(exec_order AS DOUBLE)"
HELPERS["plan_rows"] = f"""SELECT run_id, order_key, exec_order, stored_procedure_name, file_datasource, codebase, status, error, duplicate_keys,
  row_number() OVER (PARTITION BY run_id ORDER BY order_key IS NULL, order_key, CASE WHEN order_key IS NULL THEN exec_order END) AS rk
FROM (SELECT *, {_POSK} AS order_key,
  row_number() OVER (PARTITION BY run_id, {_POSK}, CASE WHEN {_POSK} IS NULL THEN exec_order END
    ORDER BY stored_procedure_name NULLS FIRST, exec_order NULLS FIRST, file_datasource NULLS FIRST, codebase NULLS FIRST,
             status NULLS FIRST, error NULLS FIRST) AS rn,
  count(*) OVER (PARTITION BY run_id, {_POSK}, CASE WHEN {_POSK} IS NULL THEN exec_order END) AS duplicate_keys
  FROM d_run_steps WHERE NOT (file_datasource LIKE '%BMT%')) z WHERE rn = 1"""


def _halt(kind: str) -> str:
    failed = "coalesce(status = 'FAILED', status IS NULL)"
    halting = failed if kind == "strict" else f"{failed} AND coalesce(file_datasource = 'SPDST', false)"
    return f"""SELECT p.*, CASE WHEN h.halt_at IS NOT NULL AND p.rk > h.halt_at THEN 'Skipped'
  WHEN {failed.replace('status', 'p.status')} THEN 'Failed' ELSE 'Completed' END AS outcome
FROM plan_rows p LEFT JOIN (SELECT run_id, min(rk) AS halt_at FROM plan_rows WHERE {halting} GROUP BY 1) h ON h.run_id = p.run_id"""


HELPERS["bmt_rows"] = """SELECT run_id, exec_order, stored_procedure_name, file_datasource, codebase, status, error, duplicate_keys,
  row_number() OVER (PARTITION BY run_id ORDER BY exec_order) AS rk
FROM (SELECT *, row_number() OVER (PARTITION BY run_id, exec_order ORDER BY stored_procedure_name NULLS FIRST, file_datasource NULLS FIRST,
    codebase NULLS FIRST, status NULLS FIRST, error NULLS FIRST) AS rn, count(*) OVER (PARTITION BY run_id, exec_order) AS duplicate_keys
  FROM d_run_steps WHERE contains(file_datasource, 'BMT') AND codebase = 'Y') z WHERE rn = 1"""
HELPERS["halt_strict"] = _halt("strict")
HELPERS["halt_bmt"] = _halt("strict").replace("plan_rows", "bmt_rows")
HELPERS["halt_critical"] = _halt("critical")
_TAIL = "CASE WHEN strpos({e}, ':') > 0 THEN substr({e}, strpos({e}, ':') + 1) ELSE {e} END"
_SECOND = "CASE WHEN strpos({e}, ':') > 0 THEN split_part({e}, ':', 2) ELSE {e} END"
HELPERS["outcome_strict"] = f"""SELECT run_id, 'strict' AS rule, CASE WHEN n_failed > 0 THEN 'Failed' ELSE 'Finished' END AS execution_status,
  CASE WHEN n_failed > 0 THEN 'Failed' ELSE 'Completed' END AS report_status,
  CASE WHEN n_failed > 0 THEN {_TAIL.format(e='fe')} ELSE 'Null' END AS error_message, n_steps, n_failed, n_skipped
FROM (SELECT run_id, count(*) AS n_steps, count(*) FILTER (WHERE outcome = 'Failed') AS n_failed,
  count(*) FILTER (WHERE outcome = 'Skipped') AS n_skipped,
  arg_min(coalesce(error, 'Unknown error'), rk) FILTER (WHERE outcome = 'Failed') AS fe FROM halt_strict GROUP BY 1) z"""
HELPERS["outcome_strict_older"] = f"""SELECT run_id, 'strict_older' AS rule, CASE WHEN n_failed > 0 THEN 'Failed' ELSE 'Finished' END AS execution_status,
  CASE WHEN n_failed > 0 THEN 'Failed' ELSE 'Completed' END AS report_status,
  CASE WHEN n_failed > 0 THEN {_SECOND.format(e='fe')} ELSE 'NULL' END AS error_message, n_steps, n_failed, n_skipped
FROM (SELECT run_id, count(*) AS n_steps, count(*) FILTER (WHERE outcome = 'Failed') AS n_failed,
  count(*) FILTER (WHERE outcome = 'Skipped') AS n_skipped,
  arg_min(coalesce(error, 'Unknown error'), rk) FILTER (WHERE outcome = 'Failed') AS fe FROM halt_strict GROUP BY 1) z"""
HELPERS["outcome_bmt"] = HELPERS["outcome_strict_older"].replace("halt_strict", "halt_bmt")
HELPERS["outcome_critical"] = f"""SELECT run_id, 'critical' AS rule, CASE WHEN n_failed > 0 THEN 'Failed' ELSE 'Finished' END AS execution_status,
  CASE WHEN coalesce(lo = 'Failed', false) THEN 'Failed' ELSE 'Completed' END AS report_status,
  CASE WHEN coalesce(lo = 'Failed', false) THEN {_SECOND.format(e='le')} ELSE 'Null' END AS error_message, n_steps, n_failed, n_skipped
FROM (SELECT run_id, count(*) AS n_steps, count(*) FILTER (WHERE outcome = 'Failed') AS n_failed,
  count(*) FILTER (WHERE outcome = 'Skipped') AS n_skipped,
  arg_max(outcome, rk) FILTER (WHERE outcome <> 'Skipped') AS lo,
  arg_max(coalesce(error, 'Unknown error'), rk) FILTER (WHERE outcome <> 'Skipped') AS le FROM halt_critical GROUP BY 1) z"""

BODIES.update({
    "q30_plan_order": "SELECT run_id, order_key, exec_order, stored_procedure_name, file_datasource, duplicate_keys FROM plan_rows",
    "q31_halt_strict": "SELECT run_id, order_key, stored_procedure_name, outcome FROM halt_strict",
    "q32_halt_critical": "SELECT run_id, order_key, stored_procedure_name, outcome FROM halt_critical",
    "q33_retry_fold": f"""SELECT step_id, batchrundate,
  CASE WHEN first_ok IS NOT NULL AND first_ok <= {P.RETRY_LIMIT} THEN 'Completed' ELSE 'Failed' END AS final_state,
  CAST(CASE WHEN first_ok IS NOT NULL AND first_ok <= {P.RETRY_LIMIT} THEN first_ok ELSE least(n, {P.RETRY_LIMIT}) END AS BIGINT) AS attempts_used,
  n AS attempts_recorded
FROM (SELECT step_id, batchrundate, min(rn) FILTER (WHERE status <> 'FAILED') AS first_ok, count(*) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY step_id, batchrundate ORDER BY started, seq) AS rn FROM d_step_attempts) z
  GROUP BY 1, 2) y""",
    "q34_run_outcome": "SELECT * FROM outcome_strict UNION ALL SELECT * FROM outcome_strict_older UNION ALL SELECT * FROM outcome_critical",
    "q35_error_text": f"""SELECT error, {_SECOND.format(e='error')} AS second_part, {_TAIL.format(e='error')} AS tail
FROM (SELECT DISTINCT error FROM d_run_steps WHERE error IS NOT NULL) z""",
    "q39_statement_state": """SELECT s.statement_id, t.state AS final_state, t.started AS terminal_at, s.n_events
FROM (SELECT job_name AS statement_id, count(*) AS n_events FROM d_job_runs GROUP BY 1) s
LEFT JOIN (SELECT job_name, state, started, row_number() OVER (PARTITION BY job_name ORDER BY started, seq) AS rn
  FROM (SELECT *, CASE WHEN job_run_state = 'SUCCEEDED' THEN 'FINISHED' ELSE job_run_state END AS state FROM d_job_runs) z
  WHERE state IN ('FINISHED', 'FAILED', 'ABORTED')) t ON t.job_name = s.statement_id AND t.rn = 1""",
})

# ---------------------------------------------------------------- outputs
_RUN_LABEL = "CAST(o.run_id AS VARCHAR)"


def _run_notes(outcome: str, halt: str, executor: str) -> str:
    """Failure message with all failed steps, or success plus report link, per run."""
    name, link = ("BMT", "BMT") if executor == "bmt" else ("SPDST/Others", "SPDST/others")
    source = "'BMT'" if executor == "bmt" else "CASE WHEN h.file_datasource = 'SPDST' THEN 'SPDST' ELSE 'SPDST/Others' END"
    return f"""SELECT 'run_failed' AS kind, CAST(NULL AS VARCHAR) AS regionname, CAST(NULL AS DATE) AS batchrundate, o.run_id, {_RUN_LABEL} || ' {name} Report Refresh Failed' AS subject,
  CAST(json_object('Env', '{P.ENV}', 'Error Message', h.steps, 'status', 'Failed', 'Region', {_RUN_LABEL}) AS VARCHAR) AS body
FROM {outcome} o JOIN (SELECT h.run_id, list(json_object('Stored Procedure Name', h.stored_procedure_name,
    'Error', coalesce(h.error, 'Unknown error'), 'Data Source', {source}, 'Region', CAST(h.run_id AS VARCHAR)) ORDER BY h.rk) AS steps
  FROM {halt} h WHERE h.outcome = 'Failed' GROUP BY 1) h ON h.run_id = o.run_id WHERE o.execution_status = 'Failed'
UNION ALL
SELECT 'run_succeeded', NULL, NULL, o.run_id, {_RUN_LABEL} || ' {name} Report Refresh Successful',
  CAST(json_object('Env', '{P.ENV}', 'Error Message', CAST([] AS VARCHAR[]), 'status', 'Succeeded', 'Region', {_RUN_LABEL}) AS VARCHAR)
FROM {outcome} o WHERE o.execution_status <> 'Failed'
UNION ALL
SELECT 'run_report_link', NULL, NULL, o.run_id, {_RUN_LABEL} || ' {link} Report Refresh Successful',
  CAST(json_object('Env', '{P.ENV}', 'Message', {_RUN_LABEL} || ' {link} Report Refresh is Completed Successfully.',
    'Report_Url', '{P.REPORT_URL}') AS VARCHAR)
FROM {outcome} o WHERE o.execution_status <> 'Failed'"""


HELPERS["notify"] = f"""
SELECT 'files_missing' AS kind, regionname, batchrundate, CAST(NULL AS BIGINT) AS run_id,
  '** ' || regionname || ' SPDST Priority Files Missing**' AS subject,
  CAST(json_object('Env', '{P.ENV}', 'File', string_split(names, ','), 'Process Name', 'Files Not Received', 'Region', regionname) AS VARCHAR) AS body
FROM decide_current WHERE action = 'cutoff' AND missing > 0
UNION ALL
SELECT 'delay', regionname, batchrundate, NULL, '*** Delay in ' || regionname || ' SPDST Report Refresh ***',
  CAST(json_object('Env', '{P.ENV}', 'Report_Source', 'SPDST', 'Region', regionname, 'Message', 'Potential delay in SPDST report generation') AS VARCHAR)
FROM decide_current WHERE delay_alert
UNION ALL
SELECT CASE action WHEN 'start' THEN 'started' ELSE 'started_without_files' END, regionname, batchrundate, NULL,
  CASE action WHEN 'start' THEN '*** ' || regionname || ' BMT report refresh is started.***'
       ELSE '*** ' || regionname || ' BMT report refresh is started without Priority files.***' END,
  CAST(json_object('Env', '{P.ENV}', 'Message', 'The BMT ' || regionname || ' Report refresh is started. Open glue job log : {P.JOBS["BMT"]}',
    'Region', regionname) AS VARCHAR)
FROM decide_bmt WHERE action IN ('start', 'forced_start')
UNION ALL
SELECT 'files_missing', regionname, batchrundate, NULL, '*** ' || regionname || 'BMT Priority File Missing ***',
  CAST(json_object('Env', '{P.ENV}', 'Missing Priority File', string_split(missing_names, ','),
    'Process Name failed, If any', 'Files Not Received', 'Region', regionname) AS VARCHAR)
FROM decide_bmt WHERE action = 'cutoff' AND missing > 0
UNION ALL
SELECT 'files_failed', d.regionname, d.batchrundate, NULL, '*** ' || d.regionname || 'BMT Priority File Failure ***',
  CAST(json_object('Env', '{P.ENV}', 'Priority File Failed', f.lst, 'Process Name failed, If any', 'NA', 'Region', d.regionname) AS VARCHAR)
FROM decide_bmt d JOIN (SELECT batchrundate, regionname, list(map([filename], [string_split(detail, ',')]) ORDER BY filename, detail) AS lst
  FROM states_bmt WHERE state = 'failed' GROUP BY 1, 2) f ON f.batchrundate = d.batchrundate AND f.regionname = d.regionname
WHERE d.action = 'cutoff'
UNION ALL
{_run_notes("outcome_strict", "halt_strict", "other")}"""


def _hourly(**flags) -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in flags.items())
    return f"SELECT date_trunc('hour', ts) AS hour_start, count(*) AS n_events, {cols} FROM events GROUP BY 1"


_ec, _ed = P.EVENT_CUTOFF, P.EVENT_DELAY
BODIES.update({
    "q36_notifications": "SELECT * FROM notify",
    "q37_start_requests": f"""SELECT batchrundate, regionname, report_source,
  CASE report_source WHEN 'BMT' THEN '{P.JOBS["BMT"]}' ELSE '{P.JOBS["SPDST"]}' END AS job_name,
  CASE WHEN report_source = 'BMT' THEN CAST(json_object('--priority_files_received', priority_files_received,
         '--reportregionname', regionname, '--identifier', 'BMT') AS VARCHAR)
       ELSE CAST(json_object('--reportregionname', regionname, '--identifier', report_source) AS VARCHAR) END AS arguments
FROM (SELECT * FROM decide_current UNION ALL SELECT * FROM decide_bmt) d WHERE action IN ('start', 'forced_start')""",
    "q20_cutoff_clock": _hourly(n_inside=_clock_in("ts", _ec)),
    "q21_cutoff_fields": _hourly(n_inside=_fields_in("ts", _ec)),
    "q22_delay_window": _hourly(n_delay_clock=_clock_in("ts", _ed),
                                n_delay_fields=f"{_fields_in('ts', _ed)} AND minute(ts) < {_ed[3]}"),
    "q23_forced_start": _hourly(n_forced=f"hour(ts) >= {_ec[0] + P.FORCE_EXTRA[0]} AND minute(ts) >= {_ec[1] + P.FORCE_EXTRA[1]}"),
    "q40_daily_loads": "SELECT date_trunc('day', ts) AS day_start, event_type, count(*) AS n_events FROM events GROUP BY 1, 2",
    "q41_first_arrivals": """SELECT user_id, date_trunc('day', ts) AS day_start, min(ts) AS first_ts,
  arg_min(event_id, (ts, event_id)) AS first_event_id, arg_min(event_type, (ts, event_id)) AS first_event_type, count(*) AS n_events
FROM events GROUP BY 1, 2""",
    "q42_late_arrivals": f"""SELECT day_start, count(*) AS n_keys,
  count(*) FILTER (WHERE first_ts <= CAST(day_start AS DATE) + TIME '{P.ARRIVAL_CUTOFF}') AS on_time,
  count(*) FILTER (WHERE first_ts > CAST(day_start AS DATE) + TIME '{P.ARRIVAL_CUTOFF}') AS late
FROM (SELECT user_id, date_trunc('day', ts) AS day_start, min(ts) AS first_ts FROM events GROUP BY 1, 2) z GROUP BY 1""",
})


_SPDST_LISTS = """JOIN (SELECT batchrundate, regionname, list(map([filename], [string_split(detail, ',')]) ORDER BY filename, detail) AS lst
  FROM states_legacy WHERE state = 'failed' GROUP BY 1, 2) f ON f.batchrundate = d.batchrundate AND f.regionname = d.regionname"""
_CLOSING = f"""SELECT k.batchrundate, k.regionname, k.report_source, k.identifier, coalesce(o.execution_status, 'Finished') AS execution_status,
  coalesce(o.report_status, 'Completed') AS report_status, coalesce(o.error_message, 'Null') AS error_message, TIMESTAMP '{P.NOW}' AS ended
FROM d_run_keys k LEFT JOIN outcome_strict o ON o.run_id = k.run_id"""
HELPERS["closing"] = _CLOSING
HELPERS["newest_keys"] = """SELECT * FROM (SELECT *, max(batchrundate) OVER (PARTITION BY regionname, identifier) AS newest FROM closing) z
WHERE batchrundate = newest"""
BODIES.update({
    "q43_legacy_alerts": f"""
SELECT 'started' AS kind, regionname, batchrundate, CAST(NULL AS BIGINT) AS run_id, '*** ' || regionname || ' SPDST report refresh is started.***' AS subject,
  CAST(json_object('Env', '{P.ENV}', 'Message', 'The SPDST ' || regionname || ' Report refresh is started. Open glue job log : {P.JOBS["SPDST"]}',
    'Region', regionname) AS VARCHAR) AS body FROM decide_legacy WHERE action = 'start'
UNION ALL
SELECT 'files_missing', regionname, batchrundate, NULL, '*** ' || regionname || ' SPDST Priority File Missing ***',
  CAST(json_object('Env', '{P.ENV}', 'Missing Priority File', string_split(missing_names, ','),
    'Process Name failed, If any', 'Files Not Received', 'Region', regionname) AS VARCHAR)
FROM decide_legacy WHERE action = 'cutoff' AND missing > 0
UNION ALL
SELECT 'files_failed', d.regionname, d.batchrundate, NULL, '*** ' || d.regionname || 'SPDST Priority File Failure ***',
  CAST(json_object('Env', '{P.ENV}', 'Priority File Failed', f.lst, 'Process Name failed, If any', 'NA', 'Region', d.regionname) AS VARCHAR)
FROM decide_legacy d {_SPDST_LISTS} WHERE d.action = 'cutoff'
UNION ALL
SELECT 'delay', regionname, batchrundate, NULL, '*** Delay in ' || regionname || ' SPDST Report Refresh ***',
  CAST(json_object('Env', '{P.ENV}', 'Report_Source', 'SPDST', 'Region', regionname,
    'Message', 'There will Delay in Report_source for SPDST due to some issue.') AS VARCHAR)
FROM legacy_delay WHERE alert""",
    "q44_critical_run_alerts": _run_notes("outcome_critical", "halt_critical", "other"),
    "q45_bmt_plan_text_order": """SELECT run_id, exec_order, stored_procedure_name, codebase AS files_received, duplicate_keys,
  ends_with(stored_procedure_name, ' ();') AS no_arguments FROM bmt_rows""",
    "q46_bmt_run_alerts": _run_notes("outcome_bmt", "halt_bmt", "bmt"),
    "q47_close_runs_log": """SELECT coalesce(o.batchrundate, c.batchrundate) AS batchrundate, coalesce(o.regionname, c.regionname) AS regionname,
  coalesce(c.execution_status, o.execution_status) AS execution_status, o.gluejob, coalesce(o.report_source, c.report_source) AS report_source,
  o.expected_start_time, o.expected_end_time, coalesce(c.error_message, o.error_message) AS error_message, o.actual_start_time,
  coalesce(c.ended, o.actual_end_time) AS actual_end_time
FROM d_trigger_log o FULL OUTER JOIN closing c ON c.batchrundate = o.batchrundate AND c.regionname = o.regionname AND c.report_source = o.report_source""",
    "q48_close_runs_master": """SELECT m.report_name, coalesce(m.regionname, c.regionname) AS regionname, coalesce(m.identifier, c.identifier) AS identifier,
  m.report_refresh_frequency, m.expected_start_time, m.average_runtime, coalesce(c.report_status, m.status) AS status, m.actual_start_time,
  m.file_arrival_cutoff_datetime
FROM d_report_master m FULL OUTER JOIN newest_keys c ON c.regionname = m.regionname AND c.identifier = m.identifier""",
    "q49_start_runs_master": f"""SELECT m.report_name, coalesce(m.regionname, c.regionname) AS regionname, coalesce(m.identifier, c.identifier) AS identifier,
  m.report_refresh_frequency, m.expected_start_time, m.average_runtime, CASE WHEN c.identifier IS NOT NULL THEN 'InProgress' ELSE m.status END AS status,
  CASE WHEN c.identifier IS NOT NULL THEN TIMESTAMP '{P.NOW}' ELSE m.actual_start_time END AS actual_start_time, m.file_arrival_cutoff_datetime
FROM d_report_master m FULL OUTER JOIN newest_keys c ON c.regionname = m.regionname AND c.identifier = m.identifier""",
})

HELPERS["arrivals"] = f"""SELECT k.user_id, d.day_start, d.day_start + CAST('{P.ARRIVAL_CUTOFF}' AS INTERVAL) AS cutoff_at,
  (SELECT min(e.ts) FROM events e WHERE e.user_id = k.user_id AND date_trunc('day', e.ts) = d.day_start) AS first_ts
FROM (SELECT DISTINCT user_id FROM events) k, (SELECT DISTINCT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start FROM events) d"""
BODIES.update({
    "q50_missing_at_cutoff": """SELECT user_id, day_start, cutoff_at, CASE WHEN first_ts IS NULL THEN 'missing' ELSE 'late' END AS state, first_ts
FROM arrivals WHERE first_ts IS NULL OR first_ts > cutoff_at""",
    "q51_cutoff_messages": """SELECT day_start, cutoff_at, count(*) AS n_expected,
  count(*) FILTER (WHERE first_ts IS NULL OR first_ts > cutoff_at) AS n_missing, count(*) FILTER (WHERE first_ts > cutoff_at) AS n_late,
  CASE WHEN count(*) FILTER (WHERE first_ts IS NULL OR first_ts > cutoff_at) > 0
    THEN 'Cut off time Reached: Missing ' || count(*) FILTER (WHERE first_ts IS NULL OR first_ts > cutoff_at) || ' files' END AS message
FROM arrivals GROUP BY 1, 2""",
    "q52_dated_log": BODIES["q47_close_runs_log"],
    "q53_load_facts_incremental": f"""SELECT a.batchrundate, a.filename,
  coalesce(string_agg(DISTINCT a.regionname, ',' ORDER BY a.regionname)
    FILTER (WHERE a.processname = 'RedshiftCuratedLoad' AND a.executionstatus = 'Succeeded'), '') AS curated_regions,
  coalesce(string_agg(DISTINCT a.processname, ',' ORDER BY a.processname) FILTER (WHERE a.executionstatus = 'Failed'), '') AS failed_processes,
  coalesce(bool_or(a.processname = 'DataValidation' AND contains(a.errormessage, '{P.FIXTURE_EMPTY_ERROR}') AND ends_with(a.sourcename, '.dat')), false) AS empty_source
FROM d_audit_log a GROUP BY 1, 2""",
    "q54_readiness_incremental": BODIES["q18_readiness"],
    "q55_reference_dates_named": BODIES["q15_reference_date_check"],
    "q56_listing": """SELECT regionname, batchrundate, 'LandingZone' AS zone, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS n_objects FROM d_landing GROUP BY 1, 2
UNION ALL SELECT regionname, batchrundate, 'ArchiveZone', CAST(ceil(count(*) / 1000.0) AS BIGINT) FROM d_archive GROUP BY 1, 2""",
    "q57_alerts_once": f"""SELECT *, CAST(0 AS BIGINT) AS batch FROM ({BODIES["q46_bmt_run_alerts"]}) b
UNION ALL SELECT *, 1 FROM ({BODIES["q44_critical_run_alerts"]}) c""",
    "q58_missing_stream": """SELECT user_id, day_start, cutoff_at FROM arrivals
WHERE (first_ts IS NULL OR first_ts > cutoff_at) AND day_start < (SELECT max(day_start) FROM arrivals)""",
    "q59_statement_stream": BODIES["q39_statement_state"],
    "q60_readiness_open_days": """SELECT * FROM ready_bmt WHERE batchrundate IN (SELECT batchrundate FROM d_trigger_log
  WHERE report_source = 'BMT' AND execution_status = 'Delay' GROUP BY 1 HAVING count(DISTINCT regionname) >= 2)""",
})


def _deps(sql: str, known: dict[str, str]) -> list[str]:
    words = set(re.findall(r"\b([a-z_][a-z0-9_]*)\b", sql))
    return [w for w in known if w in words]


def build(body: str) -> str:
    """Inline every view and helper the body needs, in dependency order."""
    known: dict[str, str] = {}
    for name in DERIVED_SQL:
        known[name] = duckdb_view_sql(name)
    known.update(HELPERS)
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order:
            return
        for d in _deps(known[name], known):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        order.append(name)

    for d in _deps(body, known):
        visit(d)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS (\n{known[n].strip()}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


def oracle_sql() -> dict[str, str]:
    return {k: build(v) for k, v in BODIES.items()}
