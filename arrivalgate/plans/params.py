"""Run parameters of the registered queries (the reference reads them from
environment variables or job arguments; here they are plain arguments)."""

# Evaluation time for rules that need one clock value.
NOW = "2024-01-15 12:00:00"
TODAY = "2024-01-15"
ENV = "dev"

# Per-row evaluation time of the gate queries: batch date + 12 hours + 7
# minutes per month number (so rows fall on both sides of the windows below).
GATE_NOW_SQL_SPARK = ("CAST(batchrundate AS TIMESTAMP_NTZ) + make_dt_interval(0, 12, "
                      "7 * month(batchrundate), 0)")

# File-arrival cutoff window (start h, m, end h, m) and forced-start extra time.
CUTOFF = (12, 30, 13, 0)
FORCE_EXTRA = (0, 10)
# Delay-alert windows: clock form (current rule) and field form with
# minute < end minute (legacy rule; its start minute must be below its end
# minute or it never fires).
DELAY_WINDOW = (12, 20, 13, 10)
LEGACY_DELAY_WINDOW = (12, 5, 13, 50)
# Batch step of the stand-in trigger log (dates are month starts).
BATCH_STEP_MONTHS = 1
# Windows tested over events.ts as "now" (q20 to q23).
EVENT_CUTOFF = (7, 15, 8, 10)
EVENT_DELAY = (17, 30, 18, 45)

# Names the stand-in tables use (the operators default to the reference's).
FIXTURE_METADATA_PREFIX = "metadata_"
FIXTURE_EMPTY_ERROR = "list index out of range"

# Job names per report source and the retry limit of the executor.
JOBS = {"BMT": "bmt_report_refresh", "SPDST": "spdst_report_refresh"}
RETRY_LIMIT = 3
# Lateness cutoff of first arrivals (q42), clock of the day.
ARRIVAL_CUTOFF = "12:00:00"
# Link carried by the success message of a run (a deployment setting).
REPORT_URL = "report-url"
# Name of a region's bucket.
BUCKET = "files-{env}-{region}"
