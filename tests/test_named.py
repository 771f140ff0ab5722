"""Tables named by data: only the named ones are read, pruned to the asked dates, whatever their columns."""

import datetime as dt
import os

import pytest

from arrivalgate.plans import queries as Q
from arrivalgate.sources.fixtures import ControlTables
from arrivalgate.sources.named import NamedTables, in_catalog, in_folder

SF = "/root/testdata/sf0.001"
COLS = {"batchrundate": "date", "source_nm": "string", "reference_dt": "date"}
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _tables(spark, root):
    full = "batchrundate date, source_nm string, reference_dt date"
    for name in ("t1", "t2", "t3"):
        spark.createDataFrame([(D1, f"{name}-a", D1), (D2, f"{name}-b", D1)], full).write.parquet(os.path.join(root, name))
    odd = spark.createDataFrame([("2024-01-01", 7, 1)], "reference_dt string, more int, SOURCE_NM int").selectExpr("*", "date'2024-01-01' as batchrundate")
    odd.write.parquet(os.path.join(root, "odd"))
    spark.createDataFrame([(D1, "x")], "batchrundate date, source_nm string").write.parquet(os.path.join(root, "short"))


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_reads_only_the_named(spark, scratch):
    _tables(spark, scratch)
    asked = spark.createDataFrame([("t1", D1), ("t1", D1), ("t3", D2), ("nowhere", D1), (None, D1)], "table_name string, batchrundate date")
    tables = NamedTables(spark, in_folder(spark, scratch))
    got = tables.read(asked, COLS)
    assert got.columns == ["table_name", *COLS] and got.count() == 4
    assert {f.split("/")[-2] for f in got.inputFiles()} == {"t1", "t3"}
    pruned = tables.read(asked, COLS, dates="batchrundate")
    assert _rows(pruned) == _rows(got.where("(table_name = 't1' and batchrundate = date'2024-01-01') or (table_name = 't3' and batchrundate = date'2024-01-02')"))
    assert "PushedFilters: [EqualTo(batchrundate,2024-01-01)" in pruned._jdf.queryExecution().executedPlan().toString() \
        or "batchrundate" in pruned._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1].split("]")[0]
    assert tables.read(asked.where("false"), COLS).count() == 0 == tables.read(asked.where("table_name = 'nowhere'"), COLS).count()


def test_other_columns_and_types(spark, scratch):
    _tables(spark, scratch)
    asked = spark.createDataFrame([("odd",), ("short",)], "table_name string")
    got = {r["table_name"]: r for r in NamedTables(spark, in_folder(spark, scratch)).read(asked, COLS).collect()}
    assert tuple(got["odd"]) == ("odd", D1, "1", D1) and tuple(got["short"]) == ("short", D1, "x", None)


def test_too_many_names_are_an_error(spark, scratch):
    _tables(spark, scratch)
    asked = spark.createDataFrame([("t1",), ("t2",)], "table_name string")
    with pytest.raises(ValueError, match="more than 1"):
        NamedTables(spark, in_folder(spark, scratch), most=1).read(asked, COLS)


def test_session_catalog(spark, scratch):
    _tables(spark, scratch)
    name = "named_" + os.path.basename(scratch).replace("-", "_")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{scratch}/t2'")
    asked = spark.createDataFrame([(name,), (name + "_gone",)], "table_name string")
    assert NamedTables(spark, in_catalog(spark)).read(asked, COLS).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_query_scans_only_named_tables(spark):
    df = Q.q55_reference_dates_named(spark, SF)
    ct = ControlTables(spark, SF)
    folders = {f.split("/")[-2] for f in df.inputFiles() if "table_name=" in f}
    held = spark.read.parquet(ct.folders_of("d_curated_ref", "table_name")).select("table_name").distinct().count()
    log = ct.d_audit_log.where("right(filename, 3) = 'PND' and processname = 'RedshiftCuratedLoad' and executionstatus = 'Succeeded'")
    assert folders and len(folders) <= held and folders <= {f"table_name={r[0]}" for r in log.select("destinationname").distinct().collect()}
    assert "table_name" in df._jdf.queryExecution().executedPlan().toString()
