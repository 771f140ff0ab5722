"""Structured Streaming forms of the daily batch notions.

The same functions take a batch or a streaming DataFrame: event-time windows
with a watermark, so state is bounded by the watermark. On a batch
DataFrame ``withWatermark`` is a no-op and the result is the batch answer,
which is what the stream-equals-batch test checks.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalgate.functions import timecols as TC
from arrivalgate.session import ensure_checkpoint_dir
from arrivalgate.sources import fs
from arrivalgate.sources.dated import DatedTable


def _event_time(events: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a zone-aware TIMESTAMP. Streams get the zone-less event
    time as TIMESTAMP in the session zone (UTC in the engine's session, so day
    windows align with the batch form); batch input is left as it is."""
    if events.isStreaming:
        return events.withColumn(ts, F.col(ts).cast("timestamp"))
    return events


def daily_loads(events: DataFrame, ts: str = "ts", kind: str = "event_type",
                watermark: str = "1 day") -> DataFrame:
    """Tumbling one-day count of events per kind (append mode with a watermark)."""
    return (_event_time(events, ts).withWatermark(ts, watermark)
            .groupBy(F.window(ts, "1 day").alias("w"), kind)
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("day_start"), kind, "n_events"))


def first_arrivals(events: DataFrame, key: str = "user_id", ts: str = "ts", seq: str = "event_id",
                   kind: str = "event_type", watermark: str = "1 day") -> DataFrame:
    """The first event of every key and day, counted once however often it
    is logged. A windowed min, so stream and batch agree exactly (a
    first-seen dedup would depend on arrival order)."""
    first = F.min(F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"), F.col(kind).alias("k")))
    return (_event_time(events, ts).withWatermark(ts, watermark)
            .groupBy(key, F.window(ts, "1 day").alias("w"))
            .agg(first.alias("f"), F.count(F.lit(1)).alias("n_events"))
            .select(key, F.col("w.start").cast("timestamp_ntz").alias("day_start"),
                    F.col("f.t").cast("timestamp_ntz").alias("first_ts"), F.col("f.s").alias(f"first_{seq}"),
                    F.col("f.k").alias(f"first_{kind}"), "n_events"))


def late_arrivals(firsts: DataFrame, cutoff_clock: str) -> DataFrame:
    """Per day, keys whose first arrival came by the cutoff clock time and
    those that came later, over ``first_arrivals`` (a batch, or the stored
    output of its stream; ``late_arrivals_stream`` is the streaming form)."""
    cutoff = TC.at_clock(F.to_date("day_start"), F.lit(cutoff_clock))
    return (firsts.groupBy("day_start")
            .agg(F.count(F.lit(1)).alias("n_keys"),
                 F.count_if(F.col("first_ts") <= cutoff).alias("on_time"),
                 F.count_if(F.col("first_ts") > cutoff).alias("late")))


def late_arrivals_stream(events: DataFrame, cutoff_clock: str, key: str = "user_id", ts: str = "ts",
                         watermark: str = "1 day") -> DataFrame:
    """T03 as a stream: the first arrivals per key and day, then their counts per
    day, two chained windowed aggregates in append mode."""
    first = (_event_time(events, ts).withWatermark(ts, watermark)
             .groupBy(key, F.window(ts, "1 day").alias("w")).agg(F.min(ts).alias("first_ts")))
    cutoff = TC.at_clock(F.to_date(F.col("w.start")), F.lit(cutoff_clock)).cast("timestamp")
    day = F.window(F.window_time("w"), "1 day").alias("d")
    return (first.withColumn("in_time", F.col("first_ts") <= cutoff).groupBy(day)
            .agg(F.count(F.lit(1)).alias("n_keys"), F.count_if("in_time").alias("on_time"),
                 F.count_if(~F.col("in_time")).alias("late"))
            .select(F.col("d.start").cast("timestamp_ntz").alias("day_start"), "n_keys", "on_time", "late"))


def run_available_now(spark: SparkSession, source: DataFrame, fn, out_path: str, name: str,
                      output_mode: str = "append") -> str:
    """Run ``fn(stream)`` over everything available now and append the result
    to parquet at ``out_path`` (checkpoint under the shared checkpoint folder,
    so a lost executor or a restart resumes, never recounts)."""
    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    q = (fn(source).writeStream.format("parquet").outputMode(output_mode)
         .option("path", out_path).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def merge_into_snapshots(spark: SparkSession, changes_stream: DataFrame, base: str, merge_fn, name: str,
                         keys: list[str]):
    """Apply each micro-batch of decisions to the newest log snapshot and
    write the result as the next snapshot under ``base``. A batch's version is
    its batch id after a first version that is recorded once, beside the
    stream's checkpoint, when the stream starts for the first time; so a
    replayed batch (after a failure or a restart) rewrites its own version. A
    batch reads the newest snapshot *before* its own version: the folder being
    read is never the one written. Within a batch the newest decision per key
    wins (by ``decided_at`` when present; without it, two decisions of one key
    are an error of the merge)."""
    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    first = first_version(spark, name, latest_version(spark, base))

    def apply(batch: DataFrame, batch_id: int):
        batch = newest_per_key(batch, keys)
        version = first + batch_id
        current = latest_snapshot(spark, base, before=version)
        merged = merge_fn(current, batch) if current is not None else batch
        merged.write.mode("overwrite").parquet(os.path.join(base, f"v={version:012d}"))

    return (changes_stream.writeStream.foreachBatch(apply).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def first_version(spark: SparkSession, name: str, newest: int | None) -> int:
    """Version of a stream's first batch: after the ``newest`` one that exists when the
    stream starts for the first time, recorded once beside the stream's checkpoint, so
    that a replayed batch finds its own version again."""
    noted = os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-first-version")
    if not fs.exists(spark, f"{noted}/_SUCCESS"):
        spark.range(1).select(F.lit(0 if newest is None else newest + 1).alias("first")).write.mode("overwrite").parquet(noted)
    return spark.read.parquet(noted).first()["first"]


def newest_per_key(batch: DataFrame, keys: list[str], at: str = "decided_at") -> DataFrame:
    """The newest change of each key by ``at``, where the batch has that column."""
    if at not in batch.columns:
        return batch
    newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in keys]), F.col(at)).alias("_n"))
    return newest.select(*keys, "_n.*")


def merge_into_dates(spark: SparkSession, changes_stream: DataFrame, table: DatedTable, merge_fn, name: str, keys: list[str]):
    """T04 on a table stored by date: each micro-batch of decisions is merged into the
    dates it holds, and no other file of the log is read or written. A batch's version
    is its batch id after the stream's first version; a version that was committed is
    not written again when its batch is replayed after a failure."""
    first = first_version(spark, name, table.newest())

    def apply(batch: DataFrame, batch_id: int):
        batch.persist()
        table.update(newest_per_key(batch, keys), merge_fn, first + batch_id)
        batch.unpersist()

    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    return (changes_stream.writeStream.foreachBatch(apply).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def _versions(spark: SparkSession, base: str) -> list[int]:
    """Complete snapshot versions under ``base`` (listed with the cluster's file system)."""
    return sorted(int(n[2:]) for n in fs.folders(spark, base) if n.startswith("v=") and fs.exists(spark, f"{base}/{n}/_SUCCESS"))


def latest_version(spark: SparkSession, base: str) -> int | None:
    v = _versions(spark, base)
    return v[-1] if v else None


def latest_snapshot(spark: SparkSession, base: str, before: int | None = None) -> DataFrame | None:
    """The newest complete snapshot under ``base`` (optionally older than
    version ``before``)."""
    v = [x for x in _versions(spark, base) if before is None or x < before]
    if not v:
        return None
    return spark.read.parquet(os.path.join(base, f"v={v[-1]:012d}"))
