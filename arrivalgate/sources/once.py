"""Rows appended exactly once, however often their cycle runs.

A plain append repeats its rows when a failed cycle is run again. Here every append
names its run and its batch; its rows have a folder of their own under that name and
count from the moment a commit record for it is moved into place. Done again before
the commit, the append writes its folder anew; done again after it, it does nothing.
Readers take the committed folders only.

    data/run=<run>/batch=<batch>/...      the rows of one append
    commits/run=<run>/batch=<batch>/      its record: one row with the time and the number of rows
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalgate.sources import fs

_NAME = re.compile(r"[A-Za-z0-9._-]+")


class AppendOnce:
    """A table of appended rows under ``base``. Names of runs are letters, digits, ``.``, ``_`` and ``-``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _path(self, kind: str, run: str, batch: int) -> str:
        if not _NAME.fullmatch(run):
            raise ValueError(f"not a name of a run: {run!r}")
        return f"{self.base}/{kind}/run={run}/batch={batch:012d}"

    def committed(self, run: str, batch: int) -> bool:
        return fs.exists(self.spark, f"{self._path('commits', run, batch)}/_SUCCESS")

    def append(self, rows: DataFrame, run: str, batch: int) -> bool:
        """Append ``rows`` as batch ``batch`` of ``run``; False if that was done before.

        A lost task or executor is Spark's to repeat; a lost driver is this method's:
        what it left behind is not read, and is overwritten by the next attempt."""
        if self.committed(run, batch):
            return False
        rows.write.mode("overwrite").parquet(self._path("data", run, batch))
        n = self.spark.read.parquet(self._path("data", run, batch)).count()      # from the files' footers
        tmp = f"{self.base}/commits/.tmp-{uuid.uuid4().hex}"
        record = self.spark.range(1, numPartitions=1).select(F.current_timestamp().alias("at"), F.lit(n).alias("n_rows"))
        record.write.parquet(tmp)
        fs.make(self.spark, f"{self.base}/commits/run={run}")
        fs.rename(self.spark, tmp, self._path("commits", run, batch))
        return True

    def batches(self) -> list[tuple[str, int]]:
        """The committed (run, batch) pairs, in order."""
        out = []
        for r in fs.folders(self.spark, f"{self.base}/commits"):
            if r.startswith("run="):
                found = fs.folders(self.spark, f"{self.base}/commits/{r}")
                out += [(r[4:], int(b[6:])) for b in found if b.startswith("batch=") and self.committed(r[4:], int(b[6:]))]
        return sorted(out)

    def read(self, schema=None) -> DataFrame | None:
        """All committed rows, with their ``run`` and ``batch`` (``schema``: of the rows,
        where the batches' differ). None before the first commit."""
        found = self.batches()
        if not found:
            return None
        paths = [self._path("data", run, batch) for run, batch in found]
        reader = self.spark.read.option("basePath", f"{self.base}/data")
        got = (reader.schema(schema) if schema is not None else reader).parquet(*paths)
        return got.withColumn("run", F.col("run").cast("string")).withColumn("batch", F.col("batch").cast("long"))


def stream_once(spark: SparkSession, rows: DataFrame, table: AppendOnce, run: str, checkpoint: str, of=lambda batch: batch):
    """Append ``of(micro-batch)`` of every batch available now; the batch id is the
    batch of the append, so a replayed one is not appended again."""
    def add(batch: DataFrame, batch_id: int):
        table.append(of(batch), run, batch_id)
    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
