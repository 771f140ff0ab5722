"""Tables stored by date, of which an update rewrites only the dates it touches.

Layout under one base folder (on the cluster's file system):

    data/v=<version>/<date column>=<date>/...   the dates that a version wrote
    manifest/v=<version>/                       one row (JSON): every date with the version that holds it

An update reads the dates it changes, writes them under its own version and then
commits by moving the new manifest into place. Readers follow the newest
manifest, so they see a whole version or the one before, and the files of
untouched dates are shared by all versions. A version that is already committed
is never written again, so a replayed update changes nothing; one that failed
before its commit is simply written anew.

The driver holds one small row per date (bounded by the calendar), never data.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arrivalgate.sources import fs

NO_DATE = "__HIVE_DEFAULT_PARTITION__"      # Spark's folder name of a null partition value


class DatedTable:
    """One table under ``base``, partitioned by ``date_col`` (a date; null is a date of its own)."""

    def __init__(self, spark: SparkSession, base: str, date_col: str = "batchrundate"):
        self.spark, self.base, self.date_col = spark, base.rstrip("/"), date_col

    # ------------------------------------------------------------- versions

    def _manifest_path(self, version: int) -> str:
        return f"{self.base}/manifest/v={version:012d}"

    def _data_path(self, version: int) -> str:
        return f"{self.base}/data/v={version:012d}"

    def committed(self, version: int) -> bool:
        return fs.exists(self.spark, f"{self._manifest_path(version)}/_SUCCESS")

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        names = fs.folders(self.spark, f"{self.base}/manifest")
        return [int(n[2:]) for n in names if n.startswith("v=") and self.committed(int(n[2:]))]

    def newest(self, before: int | None = None) -> int | None:
        """The newest committed version (older than ``before``)."""
        found = [v for v in self.versions() if before is None or v < before]
        return found[-1] if found else None

    def manifest(self, version: int) -> tuple[StructType, dict[dt.date | None, int]]:
        """Schema of a committed version, and the version that holds each of its dates."""
        got = json.loads(self.spark.read.schema("manifest string").parquet(self._manifest_path(version)).first()["manifest"])
        return StructType.fromJson(got["schema"]), {d and dt.date.fromisoformat(d): v for d, v in got["dates"]}

    # ---------------------------------------------------------------- read

    def _folder(self, version: int, day: dt.date | None) -> str:
        return f"{self._data_path(version)}/{self.date_col}={NO_DATE if day is None else day.isoformat()}"

    def read(self, dates: Iterable[dt.date | None] | None = None, version: int | None = None) -> DataFrame | None:
        """The table as of its newest (or the given) version; None before the first one.
        With ``dates``, only the folders of those dates are listed and read."""
        version = self.newest() if version is None else version
        if version is None:
            return None
        schema, held = self.manifest(version)
        wanted = held if dates is None else {d: held[d] for d in set(dates) if d in held}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = sorted(self._folder(v, d) for d, v in wanted.items())
        got = self.spark.read.schema(schema).option("basePath", f"{self.base}/data").parquet(*paths)
        return got.select(*schema.names)

    # --------------------------------------------------------------- write

    def replace(self, df: DataFrame, version: int, touched: Iterable[dt.date | None] | None = None, placed: bool = False) -> None:
        """Commit ``version``: the dates of ``df`` (and any other ``touched`` ones, which it
        empties) replace those of the version before; all other dates stay as they are.
        ``placed``: the rows of ``df`` are dealt by date already and are not shuffled again."""
        if self.committed(version):
            return
        before = self.newest(version)
        held = self.manifest(before)[1] if before is not None else {}
        # one shuffle by date; a date too large for one task is split by AQE
        (df if placed else df.hint("rebalance", self.date_col)).write.mode("overwrite").partitionBy(self.date_col).parquet(self._data_path(version))
        prefix = f"{self.date_col}="
        wrote = [n[len(prefix):] for n in fs.folders(self.spark, self._data_path(version)) if n.startswith(prefix)]
        wrote = [None if n == NO_DATE else dt.date.fromisoformat(n) for n in wrote]
        if touched is not None:
            touched = set(touched)
            if not touched.issuperset(wrote):
                raise ValueError(f"version {version} holds dates that it should not touch")
            held = {d: v for d, v in held.items() if d not in touched}
        held.update({d: version for d in wrote})
        text = json.dumps({"schema": df.schema.jsonValue(), "dates": [(d and d.isoformat(), v) for d, v in held.items()]})
        tmp = f"{self.base}/manifest/.tmp-{uuid.uuid4().hex}"
        self.spark.range(1, numPartitions=1).select(F.lit(text).alias("manifest")).write.parquet(tmp)
        fs.rename(self.spark, tmp, self._manifest_path(version))

    def update(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], version: int, placed: bool = False) -> None:
        """Commit ``version``: ``merge(rows, changes)`` of the dates that ``changes`` holds.

        Only these dates are read and written. ``changes`` is read twice (its dates,
        then its rows): give a stored table or a cheap plan. Without a version before,
        ``merge`` gets an empty table with the columns of ``changes``. ``placed``: ``merge``
        deals its rows by date."""
        if self.committed(version):
            return
        days = [r[0] for r in changes.select(self.date_col).distinct().collect()]      # bounded by the calendar
        before = self.newest(version)
        rows = self.spark.createDataFrame([], changes.schema) if before is None else self.read(days, before)
        self.replace(merge(rows, changes), version, days, placed)

    def expire(self, keep: int) -> int:
        """Forget all but the newest ``keep`` versions: drop their manifests, then the date
        folders that no kept version reads. Returns the number of folders dropped."""
        found = self.versions()
        old, kept = found[:-keep], found[-keep:]
        used = {(v, d) for k in kept for d, v in self.manifest(k)[1].items()}
        for v in old:
            fs.delete(self.spark, self._manifest_path(v))
        dropped, prefix = 0, f"{self.date_col}="
        for v in (int(n[2:]) for n in fs.folders(self.spark, f"{self.base}/data") if n.startswith("v=")):
            if v > kept[-1]:
                continue            # a version that is being written
            for n in fs.folders(self.spark, self._data_path(v)):
                day = n[len(prefix):]
                if n.startswith(prefix) and (v, None if day == NO_DATE else dt.date.fromisoformat(day)) not in used:
                    fs.delete(self.spark, f"{self._data_path(v)}/{n}")
                    dropped += 1
        return dropped
