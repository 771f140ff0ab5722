"""The stream of statement states equals the batch in any order of events, over restarts, and forgets."""

import datetime as dt
import os
import random

from arrivalgate.operators import runs as R
from arrivalgate.session import ensure_checkpoint_dir
from arrivalgate.streaming import statements as S

SCHEMA = "statement_id string, started timestamp_ntz, seq long, state string"
T0 = dt.datetime(2024, 5, 1)
ALIAS = {"SUCCEEDED": "FINISHED"}


def _run(spark, src, out, name, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    table = S.statement_states_stream(stream, aliases=ALIAS, **options)

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    (table.writeStream.foreachBatch(keep).outputMode("update")
     .option("checkpointLocation", os.path.join(ensure_checkpoint_dir(spark), "streams", name)).trigger(availableNow=True).start().awaitTermination())
    return spark.read.option("basePath", out).parquet(os.path.join(out, "*"))


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.select("statement_id", "final_state", "terminal_at", "n_events").collect())))


def test_equals_batch_in_any_order_over_restarts(spark, scratch):
    rng = random.Random(3)
    states = ["SUBMITTED", "STARTED", "SUCCEEDED", "FAILED", "ABORTED", "POLL_ERROR", None]
    rows = [(f"s{rng.choice([0, 0, 0, *range(1, 9)])}", T0 + dt.timedelta(seconds=rng.randrange(1500)), i, rng.choice(states)) for i in range(240)]
    rows += [("quiet", T0, 900, "STARTED"), (None, T0, 901, "FAILED"), ("tie", T0, 7, "ABORTED"), ("tie", T0, 6, "FAILED")]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        src, out, name = (os.path.join(scratch, f"{x}{seed}") for x in ("src", "out", "st"))
        name = os.path.basename(scratch) + os.path.basename(name)
        for i, part in enumerate((rows[:100], rows[100:])):
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(os.path.join(src, str(i)))
            got = S.newest_states(_run(spark, src, out, name))
        batch = spark.createDataFrame([r for r in rows if r[0]], SCHEMA)
        assert _rows(got) == _rows(R.statement_states(batch, aliases=ALIAS))


def test_forgets_after_the_timeout(spark, scratch):
    src, out, name = os.path.join(scratch, "src"), os.path.join(scratch, "out"), "forget-" + os.path.basename(scratch)
    h = lambda x: T0 + dt.timedelta(hours=x)      # noqa: E731
    drops = [[("done", h(0), 1, "SUBMITTED"), ("done", h(1), 2, "FAILED"), ("lost", h(0), 3, "STARTED")], [("other", h(9), 4, "STARTED")], [("other", h(10), 5, "SUCCEEDED")]]
    for i, part in enumerate(drops):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(os.path.join(src, str(i)))
        got = _run(spark, src, out, name, timeout_ms=3 * 3_600_000)
    newest = {r["statement_id"]: r for r in S.newest_states(got).collect()}
    assert {k: (r["final_state"], r["n_events"], r["closed"]) for k, r in newest.items()} == {
        "done": ("FAILED", 2, True), "lost": (None, 1, True), "other": ("FINISHED", 2, False)}


def test_a_hot_statement_is_dealt_over_parts(spark, scratch):
    rows = [("hot" if i % 3 else f"s{i}", T0 + dt.timedelta(seconds=i), i, "SUCCEEDED" if i > 250 else "STARTED") for i in range(300)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(scratch, "src", "0"))
    got = _run(spark, os.path.join(scratch, "src"), os.path.join(scratch, "out"), "hot-" + os.path.basename(scratch))
    per = [r["n_events"] for r in got.where("statement_id = 'hot'").collect()]
    assert len(per) == 8 and sum(per) == 200 and max(per) < 60
    assert _rows(S.newest_states(got)) == _rows(R.statement_states(spark.createDataFrame(rows, SCHEMA), aliases=ALIAS))
