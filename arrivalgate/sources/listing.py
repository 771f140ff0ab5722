"""S10 + U01: landing and archive listings read from storage, not from an API.

Each region has its own bucket; objects sit under ``<zone>/dt=<date>/``. The
``binaryFile`` source lists them and never reads file contents because only ``path``
is selected. There is no 350-key limit (R5).

The driver makes one call per region and zone, whatever the number of dates: the
dates asked for are one pattern over the zone's folders, and Spark lists the matching
folders in tasks of its own. ``ListingTable`` keeps what was listed by date, so that a
day that can no longer change is never listed again.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalgate.sources.dated import DatedTable

# Fixed values of the reference: the zone folders.
ZONES = ("LandingZone", "ArchiveZone")


def bucket_name(template: str, env: str, region: str) -> str:
    """bucket of a region by the deployment's template (``{env}``,
    ``{region}``; the region part is lower case)."""
    return template.format(env=env, region=region.lower())


LISTING = "regionname string, batchrundate date, object_key string"


def read_listing(spark: SparkSession, roots: dict[str, str], zones=ZONES, dates=None) -> DataFrame:
    """(regionname, batchrundate, object_key) for every object of every zone of
    every region root (``{region: 'scheme://bucket'}``).

    ``dates``: the batch dates being evaluated. Only their ``dt=`` folders are
    listed then; without it the whole tree is, for a full reload. Zones and dates
    without a folder hold nothing."""
    parts = []
    zone_alt = "|".join(zones)
    days = None if dates is None else sorted({str(d) for d in dates})
    for region, root in roots.items():
        for zone in zones if days is None or days else ():
            path = f"{root.rstrip('/')}/{zone}"
            wanted = path if days is None else f"{path}/dt={{{','.join(days)}}}"
            try:        # a pattern that matches no folder is an error to Spark
                df = spark.read.format("binaryFile").option("basePath", path).load(wanted)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            if "dt" not in df.columns:
                continue                    # a zone without a date folder
            parts.append(df.select(F.lit(region).alias("regionname"),
                                   F.col("dt").cast("date").alias("batchrundate"),
                                   F.regexp_extract("path", rf"(({zone_alt})/dt=[^/]+/.*)$", 1).alias("object_key")))
    if not parts:
        return spark.createDataFrame([], LISTING)
    return reduce(DataFrame.unionByName, parts)


class ListingTable:
    """Listings kept by batch date under ``base``.

    ``refresh`` lists the given dates and replaces them as one version; all other dates
    stay as they were listed. ``read`` touches no bucket at all."""

    def __init__(self, spark: SparkSession, base: str, roots: dict[str, str], zones=ZONES):
        self.spark, self.roots, self.zones = spark, roots, zones
        self.table = DatedTable(spark, base)

    def refresh(self, dates: Iterable, version: int, closed: Iterable = ()) -> list:
        """List ``dates`` anew, except those of ``closed`` (days whose folders no longer
        change) that are listed already. Returns the dates that were listed. A version
        that is committed lists nothing."""
        if self.table.committed(version):
            return []
        newest = self.table.newest(before=version)
        held = set() if newest is None else set(self.table.manifest(newest)[1])
        wanted = sorted(set(dates) - (set(closed) & held))
        if wanted:
            self.table.replace(read_listing(self.spark, self.roots, self.zones, wanted), version, wanted)
        return wanted

    def read(self, dates: Iterable | None = None) -> DataFrame:
        """The objects as last listed (of the given dates)."""
        got = self.table.read(dates)
        return got if got is not None else self.spark.createDataFrame([], LISTING)
