"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from arrivalgate.session import ensure_checkpoint_dir


ARROW_BATCH, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context, so that
    they can import it wherever the driver was started. Rows hold whole texts,
    so Arrow batches are cut to ``ARROW_ROWS`` rows where the session has the
    default of 10,000: a batch's memory counts in the worker and off the
    executor's heap."""
    sc = spark.sparkContext
    if spark.conf.get(ARROW_BATCH, "10000") == "10000":
        spark.conf.set(ARROW_BATCH, str(ARROW_ROWS))
    if getattr(sc, "_arrivalgate_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    file = os.path.join(tempfile.mkdtemp(prefix="arrivalgate-"), "arrivalgate.zip")
    with zipfile.ZipFile(file, "w") as z:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(file)
    sc._arrivalgate_shipped = True


class Scratch:
    """Tables written under the shared folder named in ``spark.checkpoint.dir``.

    A written table cuts the lineage (a lost executor re-reads files, it does
    not recompute the chain) and is evaluated once however many readers it
    has. Superseded tables of an iteration are dropped by the caller.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/arrivalgate-llm/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").options(**(options or {})).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete one table of this scratch folder (through Spark's file system)."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_crc32(col: str | Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes of a text; no text counts as no bytes."""
    return F.crc32(F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary"))


def fold_of(id_col: str, folds: int) -> Column:
    """``crc32(id as text) mod folds``; a null id counts as the empty text."""
    return F.pmod(text_crc32(F.col(id_col).cast("string")), F.lit(folds)).cast("int")


def rank_in_groups(df: DataFrame, group: list[str], order: list[str], out: str, buckets: int) -> DataFrame:
    """Gapless ranks from 0 within each group, whatever the group's size.

    A window over a group would put a hot group into one task. Here each group
    is split into ``buckets`` by the hash of the order columns, ranked inside
    its bucket, and shifted by the number of rows in the buckets before it
    (one small row per group and bucket). Rows that agree in every order
    column share a bucket and take consecutive ranks in any order.

    ``df`` is read twice, so it must be a stored table or a deterministic plan.
    """
    b, n, base = f"__{out}_b", f"__{out}_n", f"__{out}_base"
    df = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = df.groupBy(*group, b).agg(F.count(F.lit(1)).alias(n))
    before = W.partitionBy(*group).orderBy(b).rowsBetween(W.unboundedPreceding, -1)
    shift = counts.withColumn(base, F.coalesce(F.sum(n).over(before), F.lit(0))).drop(n)
    keys = [*group, b]
    shift = shift.select(*[F.col(k).alias(f"__s_{k}") for k in keys], base)
    on = [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys]
    local = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    ranked = df.withColumn(out, local.cast("long")).join(shift, on)
    return ranked.withColumn(out, F.col(out) + F.col(base)).drop(b, base, *[f"__s_{k}" for k in keys])


def buckets_for(rows: int, per_bucket: int = 50_000, least: int = 64) -> int:
    """Buckets of about ``per_bucket`` rows, at least ``least``."""
    return max(least, -(-rows // per_bucket))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` reads it
    (a lambda's own references would evaluate the expression anew for every element)."""
    return F.transform(F.array(value), use)[0]


def spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly over the shuffle partitions (for a stage of Python work
    whose input splits are few or uneven)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
