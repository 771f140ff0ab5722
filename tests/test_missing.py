"""Keys still missing at the cutoff, batch against plain Python, stream against batch over restarts."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from arrivalgate.session import ensure_checkpoint_dir
from arrivalgate.streaming import missing as M

CLOCK = "09:30:00"
DAY = dt.datetime(2024, 3, 1)


def _events(rng, days=6, keys=12):
    rows = []
    for d in range(days):
        for k in range(keys):
            if rng.random() < 0.3:
                continue                        # never comes that day
            for _ in range(rng.choice([1, 1, 2, 5])):
                rows.append((k, DAY + dt.timedelta(days=d, seconds=rng.randrange(86_400))))
        rows += [(99, DAY + dt.timedelta(days=d, seconds=s)) for s in range(0, 86_400, 400)]      # a hot key, not expected
    rows += [(1, DAY + dt.timedelta(hours=9, minutes=30)), (None, DAY)]                            # exactly at the cutoff; no key
    return sorted(rows, key=lambda r: r[1])


def _expected(spark, days=6, keys=12):
    ks = spark.createDataFrame([(k,) for k in [*range(keys), 3, None]], "user_id long")
    ds = spark.createDataFrame([((DAY + dt.timedelta(days=d)).date(),) for d in range(days)], "day date")
    return M.expected_arrivals(ks, ds, CLOCK)


def test_batch_against_plain_python(spark):
    rows = _events(random.Random(1))
    events = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz")
    got = {(r["user_id"], r["day_start"]): (r["state"], r["first_ts"]) for r in M.missing_at_cutoff(_expected(spark), events).collect()}
    want = {}
    for k in range(12):
        for d in range(6):
            day = DAY + dt.timedelta(days=d)
            first = min((t for u, t in rows if u == k and t.date() == day.date()), default=None)
            if first is None or first > day + dt.timedelta(hours=9, minutes=30):
                want[k, day] = ("missing" if first is None else "late", first)
    assert got == want and {s for s, _ in want.values()} == {"missing", "late"}
    per_day = {r["day_start"]: r for r in M.cutoff_messages(M.arrival_states(_expected(spark), events)).collect()}
    for d in range(6):
        day = DAY + dt.timedelta(days=d)
        n = sum(1 for x in want if x[1] == day)
        assert per_day[day]["n_expected"] == 12 and per_day[day]["n_missing"] == n
        assert per_day[day]["message"] == f"Cut off time Reached: Missing {n} files"


def test_nothing_expected_and_nothing_arrived(spark):
    events = spark.createDataFrame([], "user_id long, ts timestamp_ntz")
    assert M.missing_at_cutoff(_expected(spark).where("false"), events).count() == 0
    none = M.arrival_states(_expected(spark, 1, 2), events)
    assert [r["state"] for r in none.collect()] == ["missing"] * 3
    full = M.cutoff_messages(none.withColumn("state", F.lit("on_time"))).first()
    assert full["n_missing"] == 0 and full["message"] is None


def _run(spark, src, out, name):
    exp = spark.readStream.schema("user_id long, day_start timestamp_ntz, cutoff_at timestamp_ntz").parquet(os.path.join(src, "expected", "*"))
    ev = spark.readStream.schema("user_id long, ts timestamp_ntz").parquet(os.path.join(src, "events", "*"))
    (M.missing_stream(exp, ev, CLOCK).writeStream.format("parquet").outputMode("append").option("path", out)
     .option("checkpointLocation", os.path.join(ensure_checkpoint_dir(spark), "streams", name)).trigger(availableNow=True)
     .start().awaitTermination())


def test_stream_equals_batch_over_restarts(spark, scratch):
    rows = _events(random.Random(2))
    schema = "user_id long, ts timestamp_ntz"
    drops = [range(0, 4), range(4, 5), [5, 8]]      # the days known before each start
    out, name = os.path.join(scratch, "out"), "missing-" + os.path.basename(scratch)
    cuts = [DAY + dt.timedelta(days=1, hours=12), DAY + dt.timedelta(days=3, hours=9, minutes=35), DAY + dt.timedelta(days=9)]
    before = DAY - dt.timedelta(days=1)
    for i, cut in enumerate(cuts):
        part = [r for r in rows if before <= r[1] < cut]
        spark.createDataFrame(part, schema).write.parquet(os.path.join(scratch, "events", f"e{i}"))
        days = [DAY + dt.timedelta(days=d) for d in drops[i]]
        _expected(spark, 9).where(F.col("day_start").isin(days)).write.parquet(os.path.join(scratch, "expected", f"x{i}"))
        _run(spark, scratch, out, name)         # a new query from the same checkpoint: a restart
        before = cut
        seen = max(t for _, t in rows if t < cut) - dt.timedelta(minutes=10)
        all_ = spark.createDataFrame([r for r in rows if r[1] < cut], schema)
        want = M.missing_at_cutoff(_expected(spark), all_).where(F.col("cutoff_at") < F.lit(seen).cast("timestamp_ntz"))
        want = sorted((r["user_id"], r["day_start"]) for r in want.collect())
        got = sorted((r["user_id"], r["day_start"]) for r in spark.read.parquet(out).collect())
        assert got == want, (i, set(got) ^ set(want))
    assert got
