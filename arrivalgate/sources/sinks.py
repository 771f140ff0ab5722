"""Sinks: new log snapshots (no MERGE on plain parquet) and appended rows.

A merge result is written to a new versioned folder; the folder being read is
never overwritten. Writes go through Spark's committer, so a lost executor's
task is redone and only committed files become visible (``_SUCCESS``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame


def version_path(base: str, version: int) -> str:
    return os.path.join(base, f"v={version:012d}")


def write_snapshot(df: DataFrame, base: str, version: int, partition_by: list[str] | None = None) -> str:
    """Write a table snapshot to ``base/v=<version>``."""
    path = os.path.join(base, f"v={version:012d}")
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_version(df: DataFrame, base: str, version: int, partition_by: list[str] | None = None) -> str:
    """Outputs of one cycle in their own version folder: a re-run of the cycle
    (after a failure) rewrites exactly its own output, never another
    version and never an input, so the job is idempotent."""
    path = os.path.join(base, f"v={version:012d}")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Append new rows (initial log rows, notifications, start
    requests) to a table."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
