"""Expected time windows of refreshes and reports; the report status rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivalgate.functions import timecols as TC

# Fixed values of the reference: how a trigger picks its schedule row
# (BMT by equality, SPDST by containment), the periodic frequencies whose
# window date comes from the arrival cutoff, and the report states.
SOURCE_MATCH = {"BMT": "equals", "SPDST": "contains"}
PERIODIC = ("Monthly", "Quarterly", "Weekly", "Yearly")
ST_NULL, ST_YET, ST_DELAY, ST_DONE = "Null", "Yet to start", "Delay", "Completed"


def schedule_by_source(schedule: DataFrame, sources: dict[str, str] | None = None) -> DataFrame:
    """One schedule row per (regionname, trigger source). When several rows match
    a source the reference takes an arbitrary first; ours is the smallest
    (start time, runtime)."""
    sources = sources or SOURCE_MATCH
    src = F.explode(F.array(*[F.lit(s) for s in sources])).alias("source")
    df = schedule.select("*", src)
    cond = None
    for s, how in sources.items():
        m = (F.col("report_source") == s) if how == "equals" else F.col("report_source").contains(s)
        c = (F.col("source") == s) & m
        cond = c if cond is None else (cond | c)
    best = F.min(F.struct("expected_start_time", "average_runtime"))
    return (df.where(cond).groupBy("regionname", "source").agg(best.alias("s"))
            .select("regionname", F.col("source").alias("report_source"),
                    F.col("s.expected_start_time").alias("expected_start_time"),
                    F.col("s.average_runtime").alias("average_runtime")))


def expected_window(schedule: DataFrame, cal: DataFrame, wrap: bool = True,
                    sources: dict[str, str] | None = None) -> DataFrame:
    """D01 + J13 + F13/F14/F19: expected start and end of every region, source and
    batch date. ``cal`` holds (batchrundate, regionname). The schedule has one
    row per region and source, so it is broadcast: its size is bounded by
    the region x source catalog, not by the data."""
    sch = F.broadcast(schedule_by_source(schedule, sources))
    d = F.col("batchrundate")
    return (cal.select("batchrundate", "regionname").join(sch, "regionname")
            .select("batchrundate", "regionname", "report_source",
                    TC.at_clock(d, "expected_start_time").alias("expected_start"),
                    TC.window_end(d, "expected_start_time", "average_runtime", wrap).alias("expected_end"),
                    F.date_format(d, "EEEE").alias("day_name")))


def report_window(master: DataFrame, today, wrap: bool = True) -> DataFrame:
    """D08 + K07: periodic reports use the date of their arrival cutoff text, the
    others ``today``; start = that date + start time, end = date + clock(start
    + mean run time). ``today`` is a date literal or Column."""
    today_c = today if isinstance(today, Column) else TC.date_lit(today)
    day = F.when(F.col("report_refresh_frequency").isin(*PERIODIC),
                 TC.first_token("file_arrival_cutoff_datetime").cast("date")).otherwise(today_c)
    return (master.withColumn("_day", day)
            .withColumn("expected_start", TC.at_clock("_day", "expected_start_time"))
            .withColumn("expected_end", TC.window_end("_day", "expected_start_time", "average_runtime", wrap))
            .drop("_day"))


def report_status(windowed: DataFrame, now) -> DataFrame:
    """D09 + K08: the new status of every report (first match wins).

    date(actual start) <> date(expected start), or no actual start: 'Null'
    now <= e and s = 'Null': 'Yet to start'; now <= e and s = 'Completed': 'Completed'
    now >= e and s <> 'Completed' (NULL counts as different): 'Delay'
    now >= e and s = 'Completed': 'Completed'; else unchanged, SQL NULL as 'None'.
    """
    n = now if isinstance(now, Column) else TC.ts_lit(now)
    e, s = F.col("expected_start"), F.col("status")
    s_is = lambda v: F.coalesce(s == v, F.lit(False))  # noqa: E731  (Python ==, two-valued)
    same_day = F.coalesce(F.to_date("actual_start_time") == F.to_date(e), F.lit(False))
    new = (F.when(~same_day, ST_NULL)
           .when((n <= e) & s_is(ST_NULL), ST_YET)
           .when((n <= e) & s_is(ST_DONE), ST_DONE)
           .when((n >= e) & ~s_is(ST_DONE), ST_DELAY)
           .when((n >= e) & s_is(ST_DONE), ST_DONE)
           .otherwise(F.coalesce(s, F.lit("None"))))
    return windowed.withColumn("status", new)
