"""Guards on the physical plans: the scale properties the design relies on."""

import re

import pytest

import __spark_entry__ as E
from arrivalgate.plans import queries as Q
from arrivalgate.plans.queries import QUERIES
from arrivalgate.sources.fixtures import ControlTables

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    # the final adaptive plan itself; a scalar subquery in it prints its own initial plan too
    return (plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan).toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python(spark, name):
    plan = final_plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_load_log_read_once_per_chain(spark):
    for name in ("q18_readiness", "q24_decide_current"):
        plan = final_plan(E.queries()[name](spark, SF))
        scans = [line for line in plan.splitlines() if "FileScan" in line and "d_audit_log" in line]
        # one for the shared summary, one for published loads (another key)
        assert len(scans) <= 2, (name, len(scans))


def test_large_inputs_filtered_to_evaluated_dates(spark):
    plan = final_plan(E.queries()["q18_readiness"](spark, SF))
    # the date restriction is a broadcast semi join right above the scans
    assert re.search(r"BroadcastHashJoin \[batchrundate#\d+\], \[batchrundate#\d+\], LeftSemi", plan)


def test_both_triggers_in_one_pass(spark):
    """Both triggers' decisions: one scan of each zone, two of the load log (facts, published scripts)."""
    for name in ("q27_merged_log", "q36_notifications", "q37_start_requests"):
        plan = final_plan(E.queries()[name](spark, SF))
        scans = [line for line in plan.splitlines() if "FileScan" in line]
        for table, most in (("d_landing", 1), ("d_archive", 1), ("d_audit_log", 2)):
            assert 1 <= sum(f"/{table}]" in x or f"/{table}." in x or table in x for x in scans) <= most, (name, table)


def test_delay_check_reads_no_files(spark):
    plan = final_plan(E.queries()["q38_next_day_delay"](spark, SF))
    assert not any(t in plan for t in ("d_audit_log", "d_landing", "d_archive", "d_file_property"))


def test_days_stored_by_date_are_pruned(spark):
    """Over tables stored by date only the evaluated days' folders are read, found while the query runs."""
    df = E.queries()["q60_readiness_open_days"](spark, SF)
    plan = final_plan(df)
    scans = [line for line in plan.splitlines() if "FileScan" in line and "-by-batchrundate" in line]
    assert scans and all("dynamicpruningexpression(batchrundate" in x for x in scans)
    days = Q.open_days(ControlTables(spark, SF)).count()
    kept = [p for p in _partitions_read(df)]
    assert kept and max(kept) <= days < Q.open_days(ControlTables(spark, SF)).sparkSession.read.parquet(
        ControlTables(spark, SF).folders_of("d_audit_log", "batchrundate")).select("batchrundate").distinct().count()


def _new_folder(scratch) -> str:
    """The smallest test data under a name of its own, of which nothing is stored yet."""
    import os
    os.symlink(SF, f"{scratch}/in")
    return f"{scratch}/in"


def test_stand_ins_are_stored_where_they_are_derived(spark, scratch, monkeypatch):
    """No wide row is dealt over a fixed number of tasks to be stored, and the rows are those of the view."""
    from pyspark.sql.classic.dataframe import DataFrame
    dealt, repartition = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, *a: dealt.append(set(self.columns)) or repartition(self, *a))
    ct = ControlTables(spark, _new_folder(scratch))
    for name in ("d_landing", "d_audit_log", "d_run_steps", "d_sp_map"):
        got, view = ct.derived(name), ControlTables(spark, SF, stored=False).derived(name)
        assert got.exceptAll(view).isEmpty() and view.exceptAll(got).isEmpty()
    base = {frozenset(ct.base(t).columns) for t in ("lineitem", "part")}
    assert all(frozenset(x) in base for x in dealt)


def test_listing_does_not_store_the_load_log(spark, scratch):
    from arrivalgate.sources import fs
    ct = ControlTables(spark, _new_folder(scratch))
    Q.zones(ct).count()
    assert not fs.exists(spark, ct._path("d_audit_log")) and fs.exists(spark, ct._path("d_landing"))


def test_tables_by_date_are_not_stored_whole(spark, scratch, monkeypatch):
    """Folders by date are written from the view, in one shuffle of what it reads, and hold the view's rows."""
    from arrivalgate.sources import fs
    plans, real = [], ControlTables._placed
    monkeypatch.setattr(ControlTables, "_placed", lambda self, *a: plans.append(real(self, *a)) or plans[-1])
    names = ("d_audit_log", "d_landing", "d_archive")
    ct = ControlTables(spark, _new_folder(scratch))
    by_date = ct.by_date(*names)
    for name in names:
        got, view = by_date.derived(name), ControlTables(spark, SF, stored=False).derived(name)
        assert not fs.exists(spark, ct._path(name)) and got.dtypes == view.dtypes
        assert got.exceptAll(view).isEmpty() and view.exceptAll(got).isEmpty()
    log = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    dealt = log[log.index("RebalancePartitions"):]
    assert "l_partkey" in dealt and "scriptpath" not in dealt and "l_extendedprice" not in dealt.split("Relation")[0]


def test_only_expected_files_are_folded(spark):
    """The load log is cut to the expected files before its facts are shuffled."""
    for name in ("q09_published_files", "q10_unpublished_files", "q15_reference_date_check", "q24_decide_current", "q27_merged_log"):
        plan = final_plan(E.queries()[name](spark, SF))
        assert re.search(r"BroadcastHashJoin \[filename#\d+\], \[filename#\d+\], LeftSemi", plan), name


def _partitions_read(df) -> list[int]:
    """The number of folders that each pruned scan has read."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name.startswith("Scan") and node.metrics().contains("numPartitions"):
            found.append(node.metrics().apply("numPartitions").value())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found
