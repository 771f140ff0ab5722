"""S06 and T01 kept up to date: the load log's facts advanced by new rows only.

Every cycle of the reference reads the whole day of the load log again. What the
readiness rules need of it is a bit mask per (date, region, file, process) and the
set of published scripts per (date, region). Both are folds that do not mind the
order of the rows or seeing a row twice (``bit_or``, set union), so they are kept as
one table by date: new log rows are folded by themselves, in one pass, and only the
dates that they fall on are merged and written. The log's old rows are never read
again.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalgate.functions import text as T
from arrivalgate.operators import files as FS
from arrivalgate.operators.skew import PART, ROWS_PER_TASK, deal
from arrivalgate.session import ensure_checkpoint_dir, materialize
from arrivalgate.sources.dated import DatedTable

# A row holds the mask of a file and process, or (``script`` not null) a published script.
STATE_KEY = [*FS.KEY, "processname", "script"]
STATE = "batchrundate date, regionname string, filename string, processname string, script string, _flags int"


def fold_rows(load_log: DataFrame, error_text: str | None, suffix: str = FS.DATA_FILE_SUFFIX) -> DataFrame:
    """The state of some rows of the load log: each row gives its mask, and its script
    if it published one; equal keys are folded map-side first."""
    none = F.lit(None).cast("string")
    mask = F.struct(F.col("filename").alias("filename"), F.col("processname").alias("processname"), none.alias("script"),
                    FS.load_mask(error_text, suffix).cast("int").alias("_flags"))
    script = F.struct(none.alias("filename"), none.alias("processname"), F.col("scriptpath").alias("script"),
                      F.lit(0).alias("_flags"))
    said = F.when(F.expr(FS.PUBLISHED_OK) & F.col("scriptpath").isNotNull(), F.array(mask, script)).otherwise(F.array(mask))
    rows = load_log.select(*FS.DAY_REGION, F.inline(said))
    return rows.groupBy(*STATE_KEY).agg(F.bit_or("_flags").alias("_flags"))


def merge_states(state: DataFrame, new: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The state of the rows of both, dealt by date as it is stored: one shuffle folds and
    places them. A date of more than ``per_task`` rows is cut into parts by file and script."""
    both = state.unionByName(new)
    days = both.groupBy("batchrundate").agg(F.count(F.lit(1)).alias("_n"))
    dealt = deal(both, days, ["batchrundate"], "_n", F.xxhash64("filename", "script"), per_task).repartition("batchrundate", PART)
    return dealt.groupBy(*STATE_KEY, PART).agg(F.bit_or("_flags").alias("_flags")).drop(PART)


class LoadState:
    """The facts of the load rows seen so far, under ``base``.

    ``error_text``: what the loader writes for an empty file (see ``files.load_summary``)."""

    def __init__(self, spark: SparkSession, base: str, error_text: str | None, suffix: str = FS.DATA_FILE_SUFFIX):
        self.spark, self.error_text, self.suffix = spark, error_text, suffix
        self.table = DatedTable(spark, base)

    def advance(self, new_rows: DataFrame, version: int) -> None:
        """Take in new rows of the load log as ``version``; a version that was taken in
        before (a replay) changes nothing. The rows are read once; what is merged is their fold."""
        if not self.table.committed(version):
            self.table.update(materialize(fold_rows(new_rows, self.error_text, self.suffix)), merge_states, version, placed=True)

    def read(self, dates=None) -> DataFrame:
        """The state of all rows seen so far (of the given dates)."""
        got = self.table.read(dates)
        return got if got is not None else self.spark.createDataFrame([], STATE)

    def scripts(self, dates=None) -> DataFrame:
        """``files.published_scripts`` of all rows seen so far (of the given dates)."""
        return self.read(dates).where("script is not null").select(*FS.DAY_REGION, F.col("script").alias("stored_procedure_name"))

    def facts(self, dates=None, files: DataFrame | None = None) -> DataFrame:
        """``files.load_facts`` of all rows seen so far (of the given dates; of the given
        expected ``files``: the others' rows are not folded)."""
        rows = self.read(dates).where("script is null")
        return FS.facts_of(FS.flags_of(rows if files is None else FS.of_files(rows, files)))


def fact_rows(facts: DataFrame) -> DataFrame:
    """The facts as flat columns: regions and failed processes as comma lists, in order."""
    return facts.select("batchrundate", "filename", T.comma_list(F.col("curated_regions")).alias("curated_regions"),
                        F.array_join("failed_list", ",").alias("failed_processes"), "empty_source")


def stream_into(load_rows: DataFrame, state: LoadState, name: str):
    """Advance the state by every micro-batch of a stream of load rows (whatever is
    available now). A batch's version is its id after the stream's first version, so a
    replayed batch is taken in once."""
    from arrivalgate.streaming.streams import first_version
    first = first_version(state.spark, name, state.table.newest())

    def take_in(batch: DataFrame, batch_id: int):
        state.advance(batch, first + batch_id)

    ckpt = os.path.join(ensure_checkpoint_dir(state.spark), "streams", name)
    return (load_rows.writeStream.foreachBatch(take_in).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
