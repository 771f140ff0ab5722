"""The listing source reads zone folders with ``dt`` partitions, no contents."""

import datetime as dt
import os

from arrivalgate.operators import files as FS
from arrivalgate.sources.listing import bucket_name, read_listing


def test_listing_and_received(spark, scratch):
    root = os.path.join(scratch, bucket_name("files-{env}-{region}", "dev", "EMEA"))
    files = {
        "LandingZone/dt=2024-01-15/FILE_A_20240115101500.dat": b"x",
        "ArchiveZone/dt=2024-01-15/FILE_B_20240115101500.csv": b"y",
        "LandingZone/dt=2024-01-15/meta_FILE_C_20240115101500.dat": b"z",
        "LandingZone/dt=2024-01-16/FILE_C_20240116101500.dat": b"w",
    }
    for k, v in files.items():
        p = os.path.join(root, k)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(v)
    assert os.path.basename(root) == "files-dev-emea"
    lst = read_listing(spark, {"EMEA": root})
    assert sorted(r.object_key for r in lst.collect()) == sorted(files)
    d = dt.date(2024, 1, 15)
    exp = spark.createDataFrame([(d, "EMEA", "FILE_A"), (d, "EMEA", "FILE_B"), (d, "EMEA", "FILE_C")],
                                "batchrundate date, regionname string, filename string")
    exact = sorted(r.filename for r in FS.received(lst, exp, "exact", "meta_").collect())
    assert exact == ["FILE_A", "FILE_B"]  # the metadata object and the other day do not count
    cont = sorted(r.filename for r in FS.received(lst, exp, "contains", "meta_").collect())
    assert cont == ["FILE_A", "FILE_B"]


def test_listing_prunes_date_folders(spark, scratch):
    from pyspark.sql import functions as F
    root = os.path.join(scratch, "bucket")
    for day in ("2024-01-15", "2024-01-16", "2024-01-17"):
        p = os.path.join(root, "LandingZone", f"dt={day}", f"F_{day}_20240115101500.dat")
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(b"x")
    one_day = read_listing(spark, {"EMEA": root}).where(F.col("batchrundate") == dt.date(2024, 1, 16))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-16" in plan
    assert [r.object_key for r in one_day.collect()] == ["LandingZone/dt=2024-01-16/F_2024-01-16_20240115101500.dat"]


def test_listing_of_given_dates_lists_only_their_folders(spark, scratch):
    root = os.path.join(scratch, "bucket")
    for zone, day in (("LandingZone", "2024-01-15"), ("LandingZone", "2024-01-16"), ("ArchiveZone", "2024-01-15")):
        p = os.path.join(root, zone, f"dt={day}", f"F_{day}_20240115101500.dat")
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(b"x")
    got = read_listing(spark, {"EMEA": root}, dates=[dt.date(2024, 1, 15), dt.date(2024, 1, 18)])
    assert sorted(r.object_key.split("/")[0] for r in got.collect()) == ["ArchiveZone", "LandingZone"]
    assert all("dt=2024-01-15" in f for f in got.inputFiles())
    assert read_listing(spark, {"EMEA": root}, dates=[dt.date(2023, 1, 1)]).collect() == []


def _tree(root, days, zones=("LandingZone", "ArchiveZone"), n=2):
    for zone in zones:
        for day in days:
            for i in range(n):
                p = os.path.join(root, zone, f"dt={day}", f"F{i}_{zone}_20240115101500.dat")
                os.makedirs(os.path.dirname(p), exist_ok=True)
                with open(p, "wb") as f:
                    f.write(b"x")


def test_driver_calls_do_not_grow_with_dates(spark, scratch, monkeypatch):
    from arrivalgate.sources import fs
    from pyspark.sql.readwriter import DataFrameReader
    root = os.path.join(scratch, "bucket")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    _tree(root, days)
    loads, load = [], DataFrameReader.load
    monkeypatch.setattr(DataFrameReader, "load", lambda self, *a, **k: loads.append(a) or load(self, *a, **k))
    monkeypatch.setattr(fs, "exists", lambda *a: (_ for _ in ()).throw(AssertionError("asked for a path")))
    for some in (days[:2], days):
        loads.clear()
        got = read_listing(spark, {"EMEA": root, "NOWHERE": root + "-none"}, dates=some + [dt.date(1999, 1, 1)])
        assert got.count() == 4 * len(some) and len(loads) == 4      # region x zone
    assert read_listing(spark, {"EMEA": root}, dates=[]).count() == 0


def test_listing_table_lists_closed_days_once(spark, scratch):
    from arrivalgate.sources.listing import ListingTable
    root = os.path.join(scratch, "bucket")
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    _tree(root, d[:2])
    table = ListingTable(spark, os.path.join(scratch, "listing"), {"EMEA": root})
    assert table.read().count() == 0
    assert table.refresh(d[:2], 0) == d[:2]
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))      # noqa: E731
    assert rows(table.read()) == rows(read_listing(spark, {"EMEA": root}))
    _tree(root, d, n=3)                                                          # more objects, and a new day
    files = set(table.read([d[0]]).inputFiles())
    assert table.refresh(d, 1, closed=d[:1]) == d[1:]                            # the closed day is not listed again
    assert set(table.read([d[0]]).inputFiles()) == files and table.read([d[0]]).count() == 4
    assert table.read(d[1:]).count() == 12 and table.refresh(d, 1) == []
    assert table.refresh(d, 2) == d and rows(table.read()) == rows(read_listing(spark, {"EMEA": root}))
