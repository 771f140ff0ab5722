"""Stand-in control tables derived from the driver's parquet tables.

The engine's real inputs are control tables (schedule, trigger log, expected
files, load log, procedure map, ...). The test data has none, so these views
derive rows *in the engine's input schemas* from the TPC-H-like tables. They do
none of the engine's work; the operators never rely on how the rows were made.

Each text is written once and rendered for two engines: Spark (tables passed
as DataFrame parameters of ``spark.sql``) and DuckDB (plain view names, used by
the oracle). ``{ntz}`` is the zone-less timestamp type name of the engine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalgate.sources import fs

BASE_TABLES = ("region", "part", "lineitem", "orders", "customer", "events")

# name -> SQL; order matters (later views read earlier ones).
DERIVED_SQL: dict[str, str] = {
    "d_file_property": """
SELECT CASE WHEN p.p_partkey % 7 = 0 THEN 'PF' || CAST(p.p_partkey AS STRING) || 'PND' ELSE 'PF' || CAST(p.p_partkey AS STRING) END AS filename,
 r.r_name AS region, CASE p.p_partkey % 3 WHEN 0 THEN 'BMT' WHEN 1 THEN 'SPDST' ELSE 'OTHER' END AS data_source,
 CASE WHEN p.p_size <= 2 THEN 'YES' ELSE 'NO' END AS priorityflag FROM {part} p JOIN {region} r ON p.p_partkey % 5 = r.r_regionkey
""",
    "d_audit_log": """
SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS batchrundate, r.r_name AS regionname,
 CASE WHEN l.l_partkey % 7 = 0 THEN 'PF' || CAST(l.l_partkey AS STRING) || 'PND' ELSE 'PF' || CAST(l.l_partkey AS STRING) END AS filename,
 CASE WHEN l.l_linenumber % 4 IN (1,2) THEN 'RedshiftCuratedLoad' WHEN l.l_linenumber % 4 = 3 THEN 'RedshiftPublishedLoad' ELSE 'DataValidation' END AS processname,
 CASE WHEN l.l_returnflag = 'N' THEN 'Failed' ELSE 'Succeeded' END AS executionstatus,
 'PUBLISHED.SP_' || CAST(l.l_partkey % 50 AS STRING) || ' (''' || r.r_name || ''')' AS scriptpath,
 'CURATED.T_' || CAST(l.l_partkey % 20 AS STRING) AS destinationname,
 'PF' || CAST(l.l_partkey AS STRING) || CASE WHEN l.l_linenumber = 4 THEN '.dat' ELSE '.csv' END AS sourcename,
 CASE WHEN l.l_linenumber % 4 = 0 AND l.l_partkey % 3 = 0 THEN 'list index out of range: empty source' WHEN l.l_returnflag = 'N' THEN 'ERROR: load failed' END AS errormessage
 FROM {lineitem} l JOIN {region} r ON l.l_partkey % 5 = r.r_regionkey
""",
    "d_sp_map": """
SELECT DISTINCT f.region AS regionname, 'SRC_' || f.filename || '_X' AS source_filename, 'PUBLISHED.SP_' || CAST(p.p_partkey % 50 AS STRING) || ' (''' || f.region || ''')' AS stored_procedure_name FROM {d_file_property} f JOIN {part} p ON f.filename = CASE WHEN p.p_partkey % 7 = 0 THEN 'PF' || CAST(p.p_partkey AS STRING) || 'PND' ELSE 'PF' || CAST(p.p_partkey AS STRING) END
 WHERE p.p_brand <> 'Brand#11'
""",
    "d_batch_dates": """
SELECT DISTINCT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS batchrundate FROM {orders} o
""",
    "d_trigger_log": """
SELECT batchrundate, regionname, execution_status, CASE WHEN report_source = 'BMT' THEN 'bmt_report_refresh' ELSE 'spdst_report_refresh' END AS gluejob, report_source,
 CAST(batchrundate AS {ntz}) + INTERVAL '6' HOUR AS expected_start_time, CAST(batchrundate AS {ntz}) + INTERVAL '7' HOUR AS expected_end_time,
 CASE WHEN execution_status = 'Delay' THEN 'Pending files: 1' WHEN execution_status = 'Yet to start' THEN 'refresh yet to start' ELSE 'NA' END AS error_message,
 CASE WHEN execution_status IN ('Finished', 'Submitted') THEN CAST(batchrundate AS {ntz}) + INTERVAL '8' HOUR END AS actual_start_time,
 CASE WHEN execution_status = 'Finished' THEN CAST(batchrundate AS {ntz}) + INTERVAL '9' HOUR END AS actual_end_time
 FROM (SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS batchrundate, r.r_name AS regionname, CASE WHEN o.o_orderkey % 2 = 0 THEN 'BMT' ELSE 'SPDST' END AS report_source,
  max_by(CASE WHEN o.o_orderkey % 5 = 0 THEN 'Delay' WHEN o.o_orderstatus = 'F' THEN 'Finished' WHEN o.o_orderstatus = 'P' THEN 'Submitted' ELSE 'Yet to start' END, (o.o_totalprice, o.o_orderkey)) AS execution_status,
  max_by(o.o_orderpriority, (o.o_totalprice, o.o_orderkey)) AS priority
  FROM {orders} o JOIN {region} r ON o.o_custkey % 5 = r.r_regionkey GROUP BY 1, 2, 3) t
 WHERE priority NOT IN ('1-URGENT', '2-HIGH')
""",
    "d_schedule": """
SELECT r.r_name AS regionname, 'BMT' AS report_source, lpad(CAST(6 + 4 * r.r_regionkey AS STRING),2,'0') || ':15:00' AS expected_start_time, 45 + 20 * r.r_regionkey AS average_runtime FROM {region} r
UNION ALL
SELECT r.r_name AS regionname, 'SPDST/Others' AS report_source, lpad(CAST(6 + 4 * r.r_regionkey AS STRING),2,'0') || ':15:00' AS expected_start_time, 45 + 20 * r.r_regionkey + 15 AS average_runtime FROM {region} r
UNION ALL
SELECT r.r_name AS regionname, 'SPDST weekly' AS report_source, lpad(CAST(5 + 4 * r.r_regionkey AS STRING),2,'0') || ':45:00' AS expected_start_time, 30 + r.r_regionkey AS average_runtime FROM {region} r WHERE r.r_name <> 'ASIA'
""",
    "d_report_master": """
SELECT c.c_name AS report_name, r.r_name AS regionname, CASE WHEN c.c_custkey % 2 = 0 THEN 'BMT' ELSE 'SPDST' END AS identifier,
 CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Daily' WHEN 'AUTOMOBILE' THEN 'Weekly' WHEN 'MACHINERY' THEN 'Monthly' WHEN 'HOUSEHOLD' THEN 'Quarterly' ELSE 'Yearly' END AS report_refresh_frequency,
 lpad(CAST(c.c_custkey % 24 AS STRING),2,'0') || ':30:00' AS expected_start_time, CAST(c.c_custkey % 180 AS INT) AS average_runtime,
 CASE c.c_custkey % 7 WHEN 0 THEN 'Null' WHEN 1 THEN 'Completed' WHEN 2 THEN 'InProgress' WHEN 3 THEN 'Delay' WHEN 4 THEN 'Yet to start' WHEN 5 THEN 'Null' END AS status,
 CASE WHEN c.c_custkey % 11 <> 0 THEN CAST('2024-01-15 00:00:00' AS {ntz}) + INTERVAL '1' MINUTE * CAST(c.c_custkey % 2000 AS INT) END AS actual_start_time,
 CASE WHEN c.c_custkey % 3 = 0 THEN '2024-01-14 10:00' ELSE '2024-01-15 10:00' END AS file_arrival_cutoff_datetime
 FROM {customer} c JOIN {region} r ON c.c_custkey % 5 = r.r_regionkey
""",
    "d_run_steps": """
SELECT l_orderkey AS run_id, CAST(l_linenumber * 5 AS STRING) AS exec_order, 'PUBLISHED.SP_' || CAST(l_partkey AS STRING) AS stored_procedure_name,
 CASE WHEN l_quantity <= 12 THEN 'BMT' WHEN l_linestatus = 'O' THEN 'SPDST' ELSE 'OTHER' END AS file_datasource, CASE WHEN l_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END AS codebase,
 CASE WHEN l_tax >= 0.08 THEN CAST(NULL AS STRING) WHEN l_returnflag = 'N' THEN 'FAILED' WHEN l_returnflag = 'A' THEN 'FINISHED' ELSE CASE WHEN l_partkey % 10 = 0 THEN 'ABORTED' ELSE 'FINISHED' END END AS status,
 CASE WHEN l_returnflag = 'N' THEN CASE WHEN l_partkey % 4 = 0 THEN 'timeout' ELSE 'ERROR: relation ' || CAST(l_partkey AS STRING) || ': missing' END END AS error FROM {lineitem}
""",
    "d_step_attempts": """
SELECT user_id AS step_id, CAST(ts AS DATE) AS batchrundate, ts AS started, event_id AS seq, CASE WHEN event_type IN ('error','click','view') THEN 'FAILED' ELSE 'FINISHED' END AS status FROM {events}
""",
    "d_job_runs": """
SELECT 'job_' || CAST(user_id % 20 AS STRING) AS job_name, ts AS started, event_id AS seq, CASE event_type WHEN 'signup' THEN 'STARTING' WHEN 'click' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS job_run_state FROM {events}
""",
    "d_dependency": """
SELECT r.r_name AS regionname, 'job_' || CAST(r.r_regionkey * 2 AS STRING) AS job_name FROM {region} r
UNION ALL
SELECT r.r_name AS regionname, 'job_' || CAST(r.r_regionkey * 2 + 1 AS STRING) AS job_name FROM {region} r
""",
    "d_landing": """
SELECT DISTINCT regionname, batchrundate, 'LandingZone/dt=' || CAST(batchrundate AS STRING) || '/' || CASE WHEN processname = 'DataValidation' THEN 'metadata_' ELSE '' END || filename || '_20240115101500.dat' AS object_key FROM {d_audit_log} WHERE length(scriptpath) % 2 = 0
""",
    "d_archive": """
SELECT DISTINCT regionname, batchrundate, 'ArchiveZone/dt=' || CAST(batchrundate AS STRING) || '/' || CASE WHEN processname = 'DataValidation' THEN 'metadata_' ELSE '' END || filename || '_20240115101500.dat' AS object_key FROM {d_audit_log} WHERE length(scriptpath) % 2 <> 0
""",
    "d_run_keys": """
SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS batchrundate, r.r_name AS regionname, CASE WHEN o.o_orderkey % 2 = 0 THEN 'BMT' ELSE 'SPDST' END AS report_source,
 CASE WHEN o.o_orderkey % 2 = 0 THEN 'BMT' ELSE 'SPDST' END AS identifier, max_by(o.o_orderkey, (o.o_totalprice, o.o_orderkey)) AS run_id
 FROM {orders} o JOIN {region} r ON o.o_custkey % 5 = r.r_regionkey GROUP BY 1, 2, 3, 4
""",
    "d_curated_ref": """
SELECT DISTINCT batchrundate, destinationname AS table_name, 'SRC_' || filename AS source_nm,
 CASE WHEN (length(filename) + month(batchrundate)) % 3 = 0 THEN CAST(batchrundate - INTERVAL '2' DAY AS DATE) ELSE CAST(batchrundate - INTERVAL '1' DAY AS DATE) END AS reference_dt
 FROM {d_audit_log} WHERE processname = 'RedshiftCuratedLoad' AND executionstatus = 'Succeeded' AND filename LIKE '%PND'
""",
}

# Views that make each row from one row of a driver table: that table, and the date of
# the row by its columns. Rows stored by date are dealt before they are made.
DATED_ROWS = {("d_audit_log", "batchrundate"): ("lineitem", "CAST(date_trunc('month', l_shipdate) AS DATE)")}

# d_schedule and d_dependency give the same rows as FIXTURES.md's texts; they
# are written as a UNION ALL per source / job instead of a cross join.


def _refs(sql: str) -> list[str]:
    import re
    return re.findall(r"\{(\w+)\}", sql)


def duckdb_view_sql(name: str) -> str:
    """The view text for DuckDB: plain table names, TIMESTAMP is zone-less."""
    sql = DERIVED_SQL[name]
    return sql.format(**{r: r for r in _refs(sql) if r != "ntz"}, ntz="TIMESTAMP").strip()


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Identity of a test-data folder: names, sizes and times of its files, as Spark's file system sees them."""
    import hashlib
    return hashlib.sha1(f"{sf_dir}:{fs.status(spark, sf_dir)}".encode()).hexdigest()[:16]


class ControlTables:
    """Lazy access to the driver tables and the derived control tables.

    The derived tables stand in for stored control tables, so they are stored:
    each is derived by Spark once, written as parquet under the shared
    checkpoint folder and read back (a written table cuts the lineage; every
    query then scans it with column pruning, as it would a real table).
    ``stored=False`` keeps them as plain views.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.stored = stored
        self._cache: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        key = name if name.startswith("d_") else f"d_{name}"
        if key in DERIVED_SQL:
            return self.derived(key)
        if name in BASE_TABLES or name in ("nation", "supplier"):
            return self.base(name)
        raise AttributeError(name)

    def derived(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._stored(name) if self.stored else self._view(name)
        return self._cache[name]

    def _view(self, name: str, **given: DataFrame) -> DataFrame:
        """The rows of a view; ``given``: the driver tables that it reads in another form."""
        sql = DERIVED_SQL[name]
        args = {}
        for r in _refs(sql):
            if r == "ntz":
                continue
            args[r] = given[r] if r in given else self._source(r) if r.startswith("d_") else self._dealt(r) if self.stored else self.base(r)
        return self.spark.sql(sql.replace("{ntz}", "TIMESTAMP_NTZ"), **args)

    def _source(self, name: str) -> DataFrame:
        """A derived table as another view reads it. The load log is derived row by row, so
        it is read where it is stored (whole or by date) and not stored for this alone."""
        if name != "d_audit_log" or not self.stored or self._is_stored(name):
            return self.derived(name)
        if self._is_stored(f"{name}-by-batchrundate"):
            return self._in_folders(name, "batchrundate")
        return self._view(name)

    def _dealt(self, name: str) -> DataFrame:
        """A driver table as a stored view reads it: the region catalog broadcast, a table
        with fewer splits than cores dealt over the cores. What is dealt are the few
        columns that the view reads, not its rows."""
        df, cores = self.base(name), self.spark.sparkContext.defaultParallelism
        if name == "region":
            return F.broadcast(df)
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)

    def by_date(self, *names: str, col: str = "batchrundate") -> ControlTables:
        """The same tables, with the named ones stored in a folder per date."""
        out = ControlTables(self.spark, self.sf_dir, self.stored)
        for name in names:
            out._cache[name] = self._in_folders(name, col)
        return out

    def _in_folders(self, name: str, col: str) -> DataFrame:
        """A derived table read from its folders, with the view's columns."""
        schema = self._unplaced(name).schema
        return self.spark.read.schema(schema).parquet(self.folders_of(name, col)).select(*schema.names)

    def stream(self, name: str) -> DataFrame:
        """A derived table as a stream of its stored files."""
        df = self.derived(name)
        return self.spark.readStream.schema(df.schema).parquet(self._path(name))

    def folders_of(self, name: str, col: str) -> str:
        """The folder that holds a derived table as one parquet folder per value of ``col``."""
        path = self._path(f"{name}-by-{col}")
        if not self._is_stored(f"{name}-by-{col}"):
            tmp = f"{path}.tmp-{uuid.uuid4().hex}"
            self._placed(name, col).write.mode("errorifexists").partitionBy(col).parquet(tmp)
            fs.rename(self.spark, tmp, path)
        return path

    def _unplaced(self, name: str) -> DataFrame:
        """A derived table where it is stored already, else its view: it is not stored whole for its folders alone."""
        return self.derived(name) if not self.stored or self._is_stored(name) else self._view(name)

    def _placed(self, name: str, col: str) -> DataFrame:
        """The rows of a derived table dealt by ``col`` in one shuffle (a value too large for
        one task is split by AQE): those of the driver's table, with the few columns that the
        view reads, where each makes one row, else the view's own."""
        if (name, col) in DATED_ROWS and self.stored and not self._is_stored(name):
            table, date = DATED_ROWS[name, col]
            return self._view(name, **{table: self.base(table).withColumn(col, F.expr(date)).hint("rebalance", col)})
        return self._unplaced(name).hint("rebalance", col)

    def _is_stored(self, name: str) -> bool:
        return fs.exists(self.spark, self._path(name) + "/_SUCCESS")

    # (session, folder fingerprint, name) -> DataFrame over the stored table
    _frames: dict[tuple, DataFrame] = {}

    def _path(self, name: str) -> str:
        from arrivalgate.session import ensure_checkpoint_dir
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/standin/{_fingerprint(self.spark, self.sf_dir)}/{name}"

    def _stored(self, name: str) -> DataFrame:
        fkey = (self.spark.sparkContext.applicationId, _fingerprint(self.spark, self.sf_dir), name)
        path = self._path(name)
        done = self._is_stored(name)
        hit = ControlTables._frames.get(fkey)
        if hit is not None and done:
            return hit
        if not done:
            # Written where the view leaves its rows, so the number of tasks grows
            # with the input and no row is shuffled just to be stored.
            # Written to a private folder, then renamed into place: a
            # concurrent writer of the same table never sees a partial one
            # (the first rename wins, the other copy is left unused).
            tmp = f"{path}.tmp-{uuid.uuid4().hex}"
            self._view(name).write.mode("errorifexists").parquet(tmp)
            fs.rename(self.spark, tmp, path)
        df = self.spark.read.parquet(path)
        ControlTables._frames[fkey] = df
        return df
