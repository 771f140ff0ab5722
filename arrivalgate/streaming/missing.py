"""What is still missing after the cutoff, as a batch and as a stream.

An arrival that comes leaves an event; one that never comes leaves nothing. So
the expected arrivals are an input of their own, one row per key and day with
the time by which it is due, and the answer is an outer join of the two. In the
stream both sides carry event time: an expected row waits in the state until
the watermark of the arrivals has passed its due time and is emitted then, once,
if nothing arrived in time. Arrivals wait only as long as the expected row of
their day may still come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivalgate.functions import timecols as TC
from arrivalgate.operators.gate import MSG_CUTOFF_COUNT

ON_TIME, LATE, MISSING = "on_time", "late", "missing"

# Parts over which one key's arrivals of a day are dealt while the stream keeps
# one of each part; a key with a third of all events is then no single task's.
SALTS = 16


def expected_arrivals(keys: DataFrame, days: DataFrame, cutoff_clock: str, key: str = "user_id",
                      day: str = "day") -> DataFrame:
    """Every key of the catalog is due on every given day by ``cutoff_clock``:
    (key, ``day_start``, ``cutoff_at``). The days are one array, bounded by the
    calendar, that each key explodes, so no join is needed. Null keys and days
    are due nowhere; repeated ones count once."""
    dates = days.agg(F.array_sort(F.collect_set(F.col(day).cast("date"))).alias("d")).scalar()
    due = keys.select(key).where(F.col(key).isNotNull()).distinct().select(key, F.explode(dates).alias("_d"))
    return due.select(key, F.col("_d").cast("timestamp_ntz").alias("day_start"),
                      TC.at_clock("_d", F.lit(cutoff_clock)).alias("cutoff_at"))


def arrival_states(expected: DataFrame, events: DataFrame, key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Each expected arrival with the first event of its key on its day and its
    state: ``on_time`` (by the cutoff, the cutoff included), ``late`` (after it,
    on the same day) or ``missing``. The events are reduced to one row per key
    and day map-side, so a hot key is one row per task."""
    first = (events.where(F.col(key).isNotNull()).groupBy(key, F.date_trunc("day", ts).cast("timestamp_ntz").alias("day_start"))
             .agg(F.min(F.col(ts).cast("timestamp_ntz")).alias("first_ts")))
    state = (F.when(F.col("first_ts").isNull(), MISSING).when(F.col("first_ts") <= F.col("cutoff_at"), ON_TIME).otherwise(LATE))
    return expected.join(first, [key, "day_start"], "left").withColumn("state", state)


def missing_at_cutoff(expected: DataFrame, events: DataFrame, key: str = "user_id", ts: str = "ts") -> DataFrame:
    """The expected arrivals that had not come by their cutoff, with what is known of
    them by the end of the day (``late`` with the time, or ``missing``)."""
    got = arrival_states(expected, events, key, ts).where(F.col("state") != ON_TIME)
    return got.select(key, "day_start", "cutoff_at", "state", "first_ts")


def cutoff_messages(states: DataFrame) -> DataFrame:
    """Per day what the trigger log says at the cutoff: how many were due, how many had
    not come, how many of those came later the same day, and the message (none where all came)."""
    late, gone = F.count_if(F.col("state") == LATE), F.count_if(F.col("state") == MISSING)
    return (states.groupBy("day_start", "cutoff_at")
            .agg(F.count(F.lit(1)).alias("n_expected"), (late + gone).alias("n_missing"), late.alias("n_late"))
            .withColumn("message", F.when(F.col("n_missing") > 0, F.format_string(MSG_CUTOFF_COUNT, F.col("n_missing")))))


def missing_stream(expected: DataFrame, events: DataFrame, cutoff_clock: str, key: str = "user_id", ts: str = "ts",
                   watermark: str = "10 minutes") -> DataFrame:
    """The stream of keys still missing at their cutoff: (key, ``day_start``, ``cutoff_at``), append mode.

    ``expected`` and ``events`` are streams; an expected row is best known before its
    day begins and counts while its cutoff is not behind the watermark. A row is
    emitted as soon as the watermark, the latest event less ``watermark``, has passed
    its cutoff. An event that is late by more than the watermark no longer clears its key.
    Spark knows a side's event time from rows only, anew after a restart: nothing is
    emitted before both sides have delivered (the coming day's expected rows will do).

    Only events up to the cutoff are kept, and of a key's events of a day about one per
    part, so the state holds at most ``SALTS`` small rows per key and open day.
    """
    hours = F.expr(f"INTERVAL '{cutoff_clock}' HOUR TO SECOND")
    due = expected.select(key, F.col("day_start").cast("timestamp").alias("day_start"),
                          F.col("cutoff_at").cast("timestamp").alias("cutoff_at")).withWatermark("cutoff_at", "0 seconds")
    came = events.select(F.col(key).alias("_k"), F.col(ts).cast("timestamp").alias("_t")).withWatermark("_t", watermark)
    came = came.where(F.col("_k").isNotNull() & (F.col("_t") <= F.date_trunc("day", "_t") + hours))
    came = (came.withColumn("_salt", F.pmod(F.xxhash64("_t"), F.lit(SALTS))).withColumn("_day", F.date_trunc("day", "_t"))
            .dropDuplicatesWithinWatermark(["_k", "_day", "_salt"]))
    # the bounds on both event times are what lets Spark forget both sides
    in_time = (F.col(key) == F.col("_k")) & (F.col("_t") <= F.col("cutoff_at")) & (F.col("_t") >= F.col("cutoff_at") - hours)
    left = due.join(came, in_time, "left_outer").where(F.col("_k").isNull())
    return left.select(key, F.col("day_start").cast("timestamp_ntz").alias("day_start"),
                       F.col("cutoff_at").cast("timestamp_ntz").alias("cutoff_at"))
