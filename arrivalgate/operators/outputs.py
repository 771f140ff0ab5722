"""Notification rows and start requests built from decisions and run outcomes.

The reference publishes JSON messages to a topic service and launches jobs
through a cloud API; neither is built. The rows those calls would carry are
produced as DataFrames (K09, K10, D13, D14) and written to tables by a sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference: message subjects, body keys and texts.
SUBJ_SPDST_MISSING = "** %s SPDST Priority Files Missing**"
SUBJ_SPDST_DELAY = "*** Delay in %s SPDST Report Refresh ***"
MSG_SPDST_DELAY = "Potential delay in SPDST report generation"
SUBJ_BMT_STARTED = "*** %s BMT report refresh is started.***"
SUBJ_BMT_FORCED = "*** %s BMT report refresh is started without Priority files.***"
MSG_BMT_STARTED = "The BMT %s Report refresh is started. Open glue job log : %s"
SUBJ_BMT_MISSING = "*** %sBMT Priority File Missing ***"
SUBJ_BMT_FAILED = "*** %sBMT Priority File Failure ***"
PROC_NOT_RECEIVED = "Files Not Received"
SUBJ_RUN = {"other": "%s SPDST/Others Report Refresh %s", "bmt": "%s BMT Report Refresh %s"}
SUBJ_RUN_LINK = {"other": "%s SPDST/others Report Refresh Successful", "bmt": "%s BMT Report Refresh Successful"}
MSG_RUN_LINK = {"other": "%s SPDST/others Report Refresh is Completed Successfully.",
                "bmt": "%s BMT Report Refresh is Completed Successfully."}
OTHER_SOURCES = "SPDST/Others"
SUBJ_LEGACY_STARTED = "*** %s SPDST report refresh is started.***"
MSG_LEGACY_STARTED = "The SPDST %s Report refresh is started. Open glue job log : %s"
SUBJ_LEGACY_MISSING = "*** %s SPDST Priority File Missing ***"
SUBJ_LEGACY_FAILED = "*** %sSPDST Priority File Failure ***"
MSG_LEGACY_DELAY = "There will Delay in Report_source for SPDST due to some issue."

NOTIFY_COLS = ["kind", "regionname", "batchrundate", "run_id", "subject", "body"]


def _alert(cond: Column, kind: str, subject: Column, body: Column) -> Column:
    """One candidate alert of a row: NULL unless ``cond``."""
    return F.when(cond, F.struct(F.lit(kind).alias("kind"), subject.alias("subject"),
                                 F.to_json(body).alias("body")))


def _explode(df: DataFrame, candidates: list[Column], run_id: Column | None = None) -> DataFrame:
    """Each input row becomes its alert rows: one pass over ``df`` whatever the
    number of alert kinds (no union of filtered copies of the same input)."""
    rid = run_id if run_id is not None else F.lit(None).cast("bigint")
    reg = F.col("regionname") if "regionname" in df.columns else F.lit(None).cast("string")
    day = F.col("batchrundate") if "batchrundate" in df.columns else F.lit(None).cast("date")
    return (df.select(reg.alias("regionname"), day.alias("batchrundate"), rid.alias("run_id"),
                      F.explode(F.filter(F.array(*candidates), lambda x: x.isNotNull())).alias("_a"))
            .select(F.col("_a.kind").alias("kind"), "regionname", "batchrundate", "run_id",
                    F.col("_a.subject").alias("subject"), F.col("_a.body").alias("body")))


def _names(col: str) -> Column:
    return F.split(F.col(col), ",")


def current_alerts(current: DataFrame, env: str) -> DataFrame:
    """D13, SPDST trigger: files missing at the cutoff, and the delay alert."""
    return _explode(current, _current_candidates(env))


def trigger_alerts(decisions: DataFrame, env: str, jobs: dict[str, str]) -> DataFrame:
    """D13 for both triggers: the alerts that ``bmt_alerts`` and ``current_alerts`` make of
    their decisions, from one pass over all of them."""
    own = lambda src, found: [F.when(F.col("report_source") == src, x) for x in found]      # noqa: E731
    return _explode(decisions, own("BMT", _bmt_candidates(env, jobs)) + own("SPDST", _current_candidates(env)))


def _current_candidates(env: str) -> list[Column]:
    r = F.col("regionname")
    return [
        _alert((F.col("action") == "cutoff") & (F.col("missing") > 0), "files_missing",
               F.format_string(SUBJ_SPDST_MISSING, r),
               F.struct(F.lit(env).alias("Env"), _names("names").alias("File"),
                        F.lit(PROC_NOT_RECEIVED).alias("Process Name"), r.alias("Region"))),
        _alert(F.col("delay_alert"), "delay", F.format_string(SUBJ_SPDST_DELAY, r),
               F.struct(F.lit(env).alias("Env"), F.lit("SPDST").alias("Report_Source"),
                        r.alias("Region"), F.lit(MSG_SPDST_DELAY).alias("Message"))),
    ]


def bmt_alerts(bmt: DataFrame, env: str, jobs: dict[str, str]) -> DataFrame:
    """D13, BMT trigger: started (with or without files), files missing and
    files failed at the cutoff. The failed files with their reasons come with
    the decisions (``failed_files``, from readiness)."""
    return _explode(bmt, _bmt_candidates(env, jobs))


def _bmt_candidates(env: str, jobs: dict[str, str]) -> list[Column]:
    r, a = F.col("regionname"), F.col("action")
    started = F.struct(F.lit(env).alias("Env"),
                       F.format_string(MSG_BMT_STARTED, r, F.lit(jobs["BMT"])).alias("Message"), r.alias("Region"))
    failed_list = F.transform("failed_files", lambda x: F.create_map(x["filename"], F.split(x["detail"], ",")))
    return [
        _alert(a == "start", "started", F.format_string(SUBJ_BMT_STARTED, r), started),
        _alert(a == "forced_start", "started_without_files", F.format_string(SUBJ_BMT_FORCED, r), started),
        # The BMT missing message lists the plain missing files, not the
        # "names" text of the log message.
        _alert((a == "cutoff") & (F.col("missing") > 0), "files_missing", F.format_string(SUBJ_BMT_MISSING, r),
               F.struct(F.lit(env).alias("Env"), _names("missing_names").alias("Missing Priority File"),
                        F.lit(PROC_NOT_RECEIVED).alias("Process Name failed, If any"), r.alias("Region"))),
        _alert((a == "cutoff") & (F.coalesce(F.size("failed_files"), F.lit(0)) > 0), "files_failed",
               F.format_string(SUBJ_BMT_FAILED, r),
               F.struct(F.lit(env).alias("Env"), failed_list.alias("Priority File Failed"),
                        F.lit("NA").alias("Process Name failed, If any"), r.alias("Region"))),
    ]


def legacy_alerts(legacy: DataFrame, env: str, jobs: dict[str, str]) -> DataFrame:
    """D13, legacy SPDST trigger: started, files missing and files failed at the
    cutoff, and the delay alert. ``legacy``: decisions from
    ``gate.with_next_day_delay``, read once."""
    r, a = F.col("regionname"), F.col("action")
    failed_list = F.transform("failed_files", lambda x: F.create_map(x["filename"], F.split(x["detail"], ",")))
    return _explode(legacy, [
        _alert(a == "start", "started", F.format_string(SUBJ_LEGACY_STARTED, r),
               F.struct(F.lit(env).alias("Env"), F.format_string(MSG_LEGACY_STARTED, r, F.lit(jobs["SPDST"])).alias("Message"),
                        r.alias("Region"))),
        _alert((a == "cutoff") & (F.col("missing") > 0), "files_missing", F.format_string(SUBJ_LEGACY_MISSING, r),
               F.struct(F.lit(env).alias("Env"), _names("missing_names").alias("Missing Priority File"),
                        F.lit(PROC_NOT_RECEIVED).alias("Process Name failed, If any"), r.alias("Region"))),
        _alert((a == "cutoff") & (F.coalesce(F.size("failed_files"), F.lit(0)) > 0), "files_failed",
               F.format_string(SUBJ_LEGACY_FAILED, r),
               F.struct(F.lit(env).alias("Env"), failed_list.alias("Priority File Failed"),
                        F.lit("NA").alias("Process Name failed, If any"), r.alias("Region"))),
        _alert(F.col("alert"), "delay", F.format_string(SUBJ_SPDST_DELAY, r),
               F.struct(F.lit(env).alias("Env"), F.lit("SPDST").alias("Report_Source"), r.alias("Region"),
                        F.lit(MSG_LEGACY_DELAY).alias("Message"))),
    ])


def run_alerts(outcomes: DataFrame, env: str, report_url: str, label: Column, run_col: str = "run_id",
               executor: str = "other") -> DataFrame:
    """D13 for the executors: one failure message with all failed steps, or a
    success message plus a report-link message (R14: one per run and kind).
    ``label`` names the run in texts (the region in a deployment);
    ``executor`` is ``other`` (SPDST/Others) or ``bmt``. The failed steps come
    with the outcome (``run_outcome``)."""
    df = outcomes.withColumn("_label", label)
    lab = F.col("_label")
    source = (lambda x: F.lit("BMT")) if executor == "bmt" else (
        lambda x: F.when(x["source"] == "SPDST", F.lit("SPDST")).otherwise(F.lit(OTHER_SOURCES)))
    entries = F.transform("failed_steps", lambda x: F.struct(
        x["procedure"].alias("Stored Procedure Name"), x["error"].alias("Error"), source(x).alias("Data Source"),
        lab.alias("Region")))
    subject, link, text = SUBJ_RUN[executor], SUBJ_RUN_LINK[executor], MSG_RUN_LINK[executor]
    failed = F.col("execution_status") == "Failed"
    empty = F.array().cast("array<struct<`Stored Procedure Name`:string,Error:string,`Data Source`:string,Region:string>>")
    return _explode(df, [
        _alert(failed, "run_failed", F.format_string(subject, lab, F.lit("Failed")),
               F.struct(F.lit(env).alias("Env"), entries.alias("Error Message"),
                        F.lit("Failed").alias("status"), lab.alias("Region"))),
        _alert(~failed, "run_succeeded", F.format_string(subject, lab, F.lit("Successful")),
               F.struct(F.lit(env).alias("Env"), empty.alias("Error Message"),
                        F.lit("Succeeded").alias("status"), lab.alias("Region"))),
        _alert(~failed, "run_report_link", F.format_string(link, lab),
               F.struct(F.lit(env).alias("Env"), F.format_string(text, lab).alias("Message"),
                        F.lit(report_url).alias("Report_Url"))),
    ], F.col(run_col))


def start_requests(decisions: DataFrame, jobs: dict[str, str]) -> DataFrame:
    """K10 + D14: the job to start and its arguments (JSON text). One argument
    name for the files flag (R16)."""
    src = F.col("report_source")
    job = F.create_map(*[x for k, v in jobs.items() for x in (F.lit(k), F.lit(v))])[src]
    args_bmt = F.create_map(F.lit("--priority_files_received"), F.col("priority_files_received"),
                            F.lit("--reportregionname"), F.col("regionname"),
                            F.lit("--identifier"), F.lit("BMT"))
    args_other = F.create_map(F.lit("--reportregionname"), F.col("regionname"),
                              F.lit("--identifier"), src)
    args = F.when(src == "BMT", F.to_json(args_bmt)).otherwise(F.to_json(args_other))
    return (decisions.where(F.col("action").isin("start", "forced_start"))
            .select("batchrundate", "regionname", "report_source", job.alias("job_name"), args.alias("arguments")))
