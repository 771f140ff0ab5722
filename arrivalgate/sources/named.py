"""Tables whose names come from data.

The reference looks a table's name up in the load log and puts it into the text
of its next query, one query per file. Here all names of a batch are looked up
at once: the distinct names are read from the data, and one scan covers exactly
the tables they name, however many others the catalog holds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalgate.sources import fs

Lookup = Callable[[str], DataFrame | None]


def in_catalog(spark: SparkSession) -> Lookup:
    """Tables of the session's catalog (``schema.table`` or ``catalog.schema.table``)."""
    return lambda name: spark.table(name) if spark.catalog.tableExists(name) else None


def in_folder(spark: SparkSession, root: str, prefix: str = "") -> Lookup:
    """Parquet tables under ``root``, each in the folder ``prefix`` + name. The folder is listed once."""
    held = set(fs.folders(spark, root))
    return lambda name: spark.read.parquet(f"{root.rstrip('/')}/{prefix}{name}") if prefix + name in held else None


class NamedTables:
    """Reads the tables that a column of names asks for.

    ``lookup`` gives a table by name, or None where there is none. ``most`` bounds the
    names of one read: the plan holds one scan per table, so it is the catalog's size
    that counts, never the data's; more names are an error, not a cut."""

    def __init__(self, spark: SparkSession, lookup: Lookup, most: int = 10_000):
        self.spark, self.lookup, self.most = spark, lookup, most

    def names(self, asked: DataFrame, name_col: str = "table_name") -> list[str]:
        """The distinct names, in order (nulls name nothing)."""
        rows = asked.select(name_col).where(F.col(name_col).isNotNull()).distinct().limit(self.most + 1).collect()
        if len(rows) > self.most:
            raise ValueError(f"more than {self.most} tables are named")
        return sorted(r[0] for r in rows)

    def read(self, asked: DataFrame, columns: dict[str, str], name_col: str = "table_name",
             dates: str | None = None) -> DataFrame:
        """``columns`` (name to type) of every table that ``asked`` names, with the table's name.

        Each table may hold other columns, in any order, and other types that can be
        cast. A column that a table lacks is null. ``dates`` names a date column of
        both: then only the dates that ``asked`` holds for a table are read from it,
        as a filter that reaches the scan. Names without a table are left out."""
        per = asked.where(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("n"))
        if dates is None:
            wanted = {n: None for n in self.names(asked, name_col)}
        else:       # one small row per name: its dates, bounded by the calendar
            self.names(asked, name_col)
            wanted = {r["n"]: r["d"] for r in per.agg(F.array_sort(F.collect_set(dates)).alias("d")).collect()}
        parts = []
        for name in sorted(wanted):
            table = self.lookup(name)
            if table is not None:
                parts.append(self._part(table, name, columns, name_col, dates, wanted[name]))
        if not parts:
            return self.spark.createDataFrame([], ", ".join([f"`{name_col}` string", *(f"`{c}` {t}" for c, t in columns.items())]))
        return reduce(DataFrame.unionByName, parts)

    @staticmethod
    def _part(table: DataFrame, name: str, columns: dict[str, str], name_col: str, dates: str | None,
              days: list[dt.date] | None) -> DataFrame:
        held = {c.lower(): c for c in table.columns}
        if dates is not None:
            if dates.lower() not in held:
                raise ValueError(f"table {name} has no column {dates}")
            table = table.where(F.col(held[dates.lower()]).isin([F.lit(d) for d in days]))
        pick = [(F.col(held[c.lower()]) if c.lower() in held else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
        return table.select(F.lit(name).alias(name_col), *pick)
