"""Hot keys measured, then dealt over as many parts as they need.

A join of many rows with one value per key puts all rows of a key into one task.
A fixed salt spreads every key alike: too thin for a key with billions of rows,
and a cost for all the small ones. Here the values come with the number of rows
of their key. A key of up to ``ROWS_PER_TASK`` rows stays whole; a larger one is
cut into parts of about that many, and its value is repeated once per part.

Only the keys with more than one part need to be known where the rows are dealt:
of ``n`` rows in all, fewer than ``n / ROWS_PER_TASK`` keys, a few bytes each,
which is what is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
PART = "_part"


def parts(n: str | Column, per_task: int) -> Column:
    """Parts of a key with ``n`` rows."""
    n = F.col(n) if isinstance(n, str) else n
    return F.greatest(F.lit(1), F.ceil(n / F.lit(per_task)).cast("int"))


def deal(rows: DataFrame, measured: DataFrame, keys: list[str], n: str, by: Column, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` with the number ``_part`` of their key's part, by the hash ``by``.

    ``measured`` holds one row per key with its number of rows ``n``. Null keys stay whole."""
    hot = measured.where(F.col(n) > per_task).select(*keys, parts(n, per_task).alias("_parts"))
    return (rows.join(F.broadcast(hot), keys, "left")
            .withColumn(PART, F.pmod(by, F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts"))


def each_part(measured: DataFrame, n: str, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per key and part: what the rows that ``deal`` has dealt are joined with, on the keys and ``_part``."""
    return measured.withColumn(PART, F.explode(F.sequence(F.lit(0), parts(n, per_task) - 1)))
