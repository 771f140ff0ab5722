"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the engine relies on. AQE re-plans joins from runtime
# sizes, coalesces small shuffle partitions and splits skewed ones (one region
# may hold a third of all load-log rows). Static auto-broadcast is off: a
# planner estimate from compressed file sizes is no bound on the in-memory
# size (a filtered 100 TB log can look small). AQE broadcasts from the
# measured size of a finished shuffle stage; the operators broadcast
# explicitly only tables bounded by a catalog or by calendar days.
ENGINE_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "arrivalgate", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine settings.

    On a cluster leave ``master`` unset so the launcher decides; tests pass
    ``local[*]``. The Spark UI stays off: no port beyond the session's own.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(ENGINE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder (``spark.checkpoint.dir``). Only a
    local session (tests, single-node runs) gets a scratch folder when it is
    unset; a cluster without one is an error, never a machine-local folder."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder of the cluster")
        d = tempfile.mkdtemp(prefix="arrivalgate-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 -- some deployments forbid runtime core confs
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df):
    """Cut lineage: write ``df`` once to the shared checkpoint folder and read it
    back (reliable ``checkpoint``, never a local one), so a result used by
    several outputs is computed once and survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
