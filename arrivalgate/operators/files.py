"""File readiness: expected files against loads, procedures, landing and failures.

Grain of everything here is (batchrundate, regionname, filename); it is
computed for all regions and batch dates at once. No shuffle is keyed by
region alone (one region may hold a third of all rows): joins are on date +
region + file, aggregates on date + file or date + region with map-side
partials; the one join keyed by region alone broadcasts its calendar side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivalgate.functions import text as T
from arrivalgate.operators.joins import contains_join, posted
from arrivalgate.session import materialize
from arrivalgate.sources.named import NamedTables

# Fixed values of the reference: process names, load states, the priority
# flag, the point-in-time suffix and the reference-date failure reason.
CURATED = "RedshiftCuratedLoad"
PUBLISHED = "RedshiftPublishedLoad"
VALIDATION = "DataValidation"
SUCCEEDED = "Succeeded"
FAILED = "Failed"
PRIORITY_YES = "YES"
PND_SUFFIX = "PND"
DATA_FILE_SUFFIX = ".dat"
REFDATE_REASON = "Reference_Dt not correct of the file. It should be current_dt - 1"

# A published load that succeeded (SQL over the load log).
PUBLISHED_OK = f"processname = '{PUBLISHED}' AND executionstatus = '{SUCCEEDED}'"

DAY_REGION = ["batchrundate", "regionname"]
KEY = ["batchrundate", "regionname", "filename"]


def priority_files(expected_files: DataFrame, source: str = "all") -> DataFrame:
    """Expected priority files per region.

    ``source``: ``bmt`` (data_source = 'BMT'), ``other`` (data_source NOT LIKE
    'BMT%'; NULL sources drop out as in SQL) or ``all``.
    """
    df = expected_files.where(F.col("priorityflag") == PRIORITY_YES)
    if source == "bmt":
        df = df.where(F.col("data_source") == "BMT")
    elif source == "other":
        df = df.where(~F.col("data_source").startswith("BMT"))
    elif source != "all":
        raise ValueError(f"unknown source {source!r}")
    return df.select(F.col("region").alias("regionname"), "filename")


# The rules of a cycle's two triggers: the BMT files, and those of all other sources.
def trigger_files(expected_files: DataFrame, other_rule: str = "current") -> DataFrame:
    """S05 for both triggers in one pass: the expected priority files with the
    ``rule`` that judges them (``bmt`` for the BMT files, ``other_rule`` for files
    whose source does not begin with BMT; all other rows drop out)."""
    src = F.col("data_source")
    rule = F.when(src == "BMT", "bmt").when(~src.startswith("BMT"), other_rule)
    return (expected_files.where(F.col("priorityflag") == PRIORITY_YES)
            .select(F.col("region").alias("regionname"), "filename", rule.alias("rule")).where(F.col("rule").isNotNull()))


def calendar(dates: DataFrame, schedule: DataFrame) -> DataFrame:
    """(batchrundate, regionname) pairs to evaluate: every given batch date with
    every scheduled region, whether or not the log has a row for it. The
    regions are one array (bounded by the region catalog) that each date
    explodes, so no join is needed."""
    regions = schedule.agg(F.array_sort(F.collect_set("regionname")).alias("r")).scalar()
    return (dates.select("batchrundate").where(F.col("batchrundate").isNotNull()).distinct()
            .select("batchrundate", F.explode(regions).alias("regionname")))


def expected_by_date(cal: DataFrame, files: DataFrame) -> DataFrame:
    """Expected files of every evaluated region and date. The calendar is
    broadcast: it is bounded by calendar days x the region catalog, and the
    join key is the region alone (a shuffle on it would put a hot region's
    files in one task)."""
    tag = ["rule"] if "rule" in files.columns else []
    return F.broadcast(cal.select(*DAY_REGION)).join(files, "regionname").select(*KEY, *tag)


def restrict_to_dates(df: DataFrame, cal: DataFrame) -> DataFrame:
    """Only the batch dates being evaluated (a trigger evaluates today, the log
    holds years). A semi join with the broadcast distinct dates -- bounded by
    calendar days, a few bytes each -- so the large side is filtered where it
    is read, never shuffled; on a date-partitioned table Spark can also prune
    partitions dynamically."""
    return df.join(F.broadcast(cal.select("batchrundate").distinct()), "batchrundate", "left_semi")


def of_files(load_log: DataFrame, files: DataFrame) -> DataFrame:
    """Only the rows of the log that name an expected file, whatever their region (the
    failure test has no region condition). The names are broadcast, bounded by the
    expected-file catalog, so other files' rows are dropped where they are read and
    neither folded nor shuffled."""
    return load_log.join(F.broadcast(files.select("filename").distinct()), "filename", "left_semi")


# Bits of the load-summary flag mask.
_CURATED_OK, _FAILED, _EMPTY = 1, 2, 4


def load_mask(error_text: str | None, suffix: str = DATA_FILE_SUFFIX) -> Column:
    """What one load-log row says, as bits (see ``load_summary``). The bits of any rows,
    in any order and however often, add up by ``bit_or``."""
    pn, st = F.col("processname"), F.col("executionstatus")
    empty = F.lit(False) if error_text is None else (
        (pn == VALIDATION) & F.col("errormessage").contains(error_text) & F.col("sourcename").endswith(suffix))
    bit = lambda cond, b: F.when(F.coalesce(cond, F.lit(False)), F.lit(b)).otherwise(F.lit(0))
    # Disjoint bits, so the sum is the bitwise or.
    return bit((pn == CURATED) & (st == SUCCEEDED), _CURATED_OK) + bit(st == FAILED, _FAILED) + bit(empty, _EMPTY)


def load_summary(load_log: DataFrame, error_text: str | None,
                 suffix: str = DATA_FILE_SUFFIX) -> DataFrame:
    """One pass over the load log (the largest input) for the three per-file
    facts the readiness rules need, per (batchrundate, regionname, filename,
    processname): a succeeded curated load (J01), a failed run of the process
    (J09) and an empty-source validation row (P11; ``error_text`` is the text the
    loader writes for an empty file, None where the caller does not ask).

    The facts are one bit mask folded by a single ``bit_or`` (a fixed-width,
    code-generated hash aggregate reduced map-side), and the flags are
    projections above it, so Catalyst cannot prune the aggregate differently
    for different consumers (see ``load_facts``)."""
    return flags_of(load_log.groupBy(*KEY, "processname").agg(F.bit_or(load_mask(error_text, suffix)).alias("_flags")))


def flags_of(masks: DataFrame) -> DataFrame:
    """The three facts of each mask."""
    flags = F.col("_flags")
    return masks.select(*KEY, "processname",
                        (flags.bitwiseAND(_CURATED_OK) != 0).alias("curated_ok"),
                        (flags.bitwiseAND(_FAILED) != 0).alias("failed"),
                        (flags.bitwiseAND(_EMPTY) != 0).alias("empty_source"))


def load_facts(load_log: DataFrame, error_text: str | None,
               suffix: str = DATA_FILE_SUFFIX) -> DataFrame:
    """The load summary folded per (batchrundate, filename): the regions with a
    succeeded curated load, the sorted failed processes (any region, as the
    reference's failure test has no region condition) and the empty-source
    flag. All three file facts read this one small table, keyed by date and
    file only, so the constraints Catalyst infers from their joins are the
    same and the summary below it -- the only reader of the log -- is
    computed once per query."""
    return facts_of(load_summary(load_log, error_text, suffix))


def facts_of(summary: DataFrame) -> DataFrame:
    """A load summary folded per (batchrundate, filename)."""
    return (summary.groupBy("batchrundate", "filename")
            .agg(F.collect_set(F.when(F.col("curated_ok"), F.col("regionname"))).alias("curated_regions"),
                 F.array_sort(F.collect_set(F.when(F.col("failed"), F.col("processname")))).alias("failed_list"),
                 F.bool_or("empty_source").alias("empty_source")))


def curated_loaded(load_log: DataFrame, files: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Files with a succeeded curated load, limited to the
    expected files of their region (a semi join; an empty list gives nothing)."""
    fa = facts if facts is not None else load_facts(of_files(load_log, files), None)
    return (fa.select("batchrundate", F.explode("curated_regions").alias("regionname"), "filename")
            .join(files, ["regionname", "filename"], "left_semi").select(*KEY))


def map_procedures(loaded: DataFrame, file_procs: DataFrame, catalog: DataFrame | None = None,
                   posts: DataFrame | None = None) -> DataFrame:
    """J03 + A12: each loaded file to its procedure by ``source_filename`` containing
    the file name on the same region; files without a procedure drop out. The
    reference takes an arbitrary first match; ours is the smallest name (R2).

    The procedure of a file depends only on (region, file), so when the
    expected-file ``catalog`` the loads were limited to is given, the map is
    built from that small table and ``loaded`` (from the large log) is read
    once, by the final join."""
    proc = file_procedures(catalog if catalog is not None else loaded, file_procs, posts)
    return loaded.join(proc, ["regionname", "filename"])


def name_posts(files: DataFrame) -> DataFrame:
    """The expected file names under their rarest grams, for all substring joins of a chain."""
    return posted(files, "filename")


def file_procedures(files: DataFrame, file_procs: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """J03 on (region, file) only: the procedure of every file, no date."""
    names = files.select("regionname", "filename").distinct()
    matched = contains_join(names, "filename",
                            file_procs.select("regionname", "source_filename", "stored_procedure_name"),
                            "source_filename", on=["regionname"], posts=posts)
    return matched.groupBy("regionname", "filename").agg(
        F.min("stored_procedure_name").alias("stored_procedure_name"))


def published_scripts(load_log: DataFrame) -> DataFrame:
    """(batchrundate, regionname, stored_procedure_name) of the published loads that succeeded."""
    return (load_log.where(PUBLISHED_OK)
            .select(*DAY_REGION, F.col("scriptpath").alias("stored_procedure_name"))
            # A region publishes few procedures many times: reduced map-side, no key stays hot.
            .distinct())


def published(mapped: DataFrame, load_log: DataFrame | None, scripts: DataFrame | None = None) -> DataFrame:
    """(file, procedure) kept when a published load whose ``scriptpath`` is the
    procedure succeeded on the same date and region. Names compared as they are (R3).
    ``scripts``: ``published_scripts``, where they are known already."""
    pub = scripts if scripts is not None else published_scripts(load_log)
    return (mapped.join(pub, DAY_REGION + ["stored_procedure_name"], "left_semi")
            .select(*KEY))


def landed_objects(landing: DataFrame, metadata_prefix: str) -> DataFrame:
    """S10 + U01 + P12 + F01: data objects of the landing and archive zones with
    their base name. ``landing`` holds (regionname, batchrundate, object_key)
    for both zones; see ``arrivalgate.sources.listing`` to build it from storage."""
    return (landing.select(*DAY_REGION, T.base_name("object_key").alias("object_name"))
            .where(T.is_data_object("object_name", metadata_prefix)))


def received(landing: DataFrame, expected: DataFrame, match: str, metadata_prefix: str,
             posts: DataFrame | None = None) -> DataFrame:
    """Expected files found in the landing or archive zone of their date.

    ``exact`` (J07): the object's stem less its 15-character stamp equals the
    file name. ``contains`` (J08): the object's base name contains the file name.
    """
    objs = landed_objects(landing, metadata_prefix)
    if match == "exact":
        names = objs.select(*DAY_REGION, T.drop_stamp(T.stem("object_name")).alias("filename"))
        return expected.join(names, KEY, "left_semi").select(*KEY)
    if match == "contains":
        return contains_join(expected.select(*KEY), "filename", objs, "object_name",
                             on=DAY_REGION, how="left_semi", posts=posts).select(*KEY)
    raise ValueError(f"unknown match {match!r}")


def received_flags(landing: DataFrame, expected: DataFrame, metadata_prefix: str, posts: DataFrame | None = None) -> DataFrame:
    """Both receipts in one pass over the zones: the expected files that some object's
    name contains (J08), each with ``exact`` where one also matches exactly (J07). An
    exact match is the beginning of the object's name, so it is among the contained ones."""
    objs = landed_objects(landing, metadata_prefix)
    # The join reads the names, then their rows. The same filters (none is left to be
    # inferred) and distinct rows for both make them one scan; dealt by name, neither
    # needs another shuffle.
    objs = objs.where("batchrundate is not null and regionname is not null").select(*DAY_REGION, F.coalesce("object_name", F.lit("")).alias("object_name"))
    objs = objs.distinct().repartition("object_name")
    hits = contains_join(expected.select(*KEY).distinct(), "filename", objs, "object_name", on=DAY_REGION, posts=posts)
    return hits.groupBy(*KEY).agg(F.bool_or(T.drop_stamp(T.stem("object_name")) == F.col("filename")).alias("exact"))


def failed_processes(load_log: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Distinct failed processes of a file on a date (no region condition)."""
    fa = facts if facts is not None else load_facts(load_log, None)
    return (fa.where(F.size("failed_list") > 0)
            .select("batchrundate", "filename", F.array_join("failed_list", ",").alias("failed_processes"),
                    F.size("failed_list").cast("bigint").alias("n_failed_processes")))


def empty_sources(load_log: DataFrame, error_text: str | None,
                  suffix: str = DATA_FILE_SUFFIX, facts: DataFrame | None = None) -> DataFrame:
    """Validation rows that report an empty source file (no region condition)."""
    fa = facts if facts is not None else load_facts(load_log, error_text, suffix)
    return fa.where(F.col("empty_source")).select("batchrundate", "filename")


def reference_dates(files: DataFrame, load_log: DataFrame, curated_ref: DataFrame,
                    posts: DataFrame | None = None) -> DataFrame:
    """S09 + J14 + P13 + P14: for point-in-time (PND) files, the curated table
    their succeeded curated load wrote to (load-log ``filename`` containing the
    file), then that table's ``reference_dt`` for rows whose ``source_nm``
    contains the file, as of the batch date. The reference takes an arbitrary
    first row; ours is the smallest table name and the latest date (R2).

    ``curated_ref`` is one table for all curated tables, with ``table_name``; see
    ``reference_dates_named`` for tables of their own.
    """
    return dated_references(curated_tables(files, load_log, posts), curated_ref, posts)


def curated_tables(files: DataFrame, load_log: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """The curated table that each point-in-time file was loaded to, by the load log."""
    pnd = files.where(T.last3("filename") == PND_SUFFIX).select(*KEY)
    loads = (load_log.where((F.col("processname") == CURATED) & (F.col("executionstatus") == SUCCEEDED))
             .select(*DAY_REGION, F.col("filename").alias("load_filename"),
                     F.col("destinationname").alias("table_name")).distinct())
    return (contains_join(pnd, "filename", loads, "load_filename", on=DAY_REGION, posts=posts)
            .groupBy(*KEY).agg(F.min("table_name").alias("table_name")))


def dated_references(tables: DataFrame, curated_ref: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """J14 + P14: the latest reference date of each file in its curated table, and whether it is the day before."""
    refs = curated_ref.select("batchrundate", "table_name", "source_nm", "reference_dt").distinct()
    dated = (contains_join(tables, "filename", refs, "source_nm", on=["batchrundate", "table_name"], posts=posts)
             .groupBy(*KEY).agg(F.max("reference_dt").alias("reference_dt")))
    return dated.withColumn("ref_ok", F.col("reference_dt") == F.date_sub("batchrundate", 1))


REFERENCE_COLUMNS = {"batchrundate": "date", "source_nm": "string", "reference_dt": "date"}


def reference_dates_named(files: DataFrame, load_log: DataFrame, tables: NamedTables, posts: DataFrame | None = None) -> DataFrame:
    """S09 + J14 with a curated table for each name that the load log holds: the names
    are found first and stored, then only the tables they name are read, for the dates
    that ask for them. A name without a table has no reference date."""
    named = materialize(curated_tables(files, load_log, posts))
    return dated_references(named, tables.read(named, REFERENCE_COLUMNS, dates="batchrundate"), posts)


def _flag(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.select(*keys).distinct().withColumn(name, F.lit(True))


def file_state(expected: DataFrame, published_files: DataFrame, received_files: DataFrame,
               failed: DataFrame, empty: DataFrame, refdates: DataFrame | None = None,
               rule: str = "bmt") -> DataFrame:
    """One state per expected file and date (first match wins).

    current: published and (received or has a failed process) -> done; else missing.
    bmt:     published -> done; empty at source -> done; failed -> failed;
             received -> in_progress; else missing.
    legacy:  published PND: reference date = batch date - 1 -> done, else failed
             with a reason; published -> done; then as bmt.
    """
    if rule == "legacy" and refdates is None:
        raise ValueError("legacy rule needs reference dates")
    df = (expected.select(*KEY)
          .join(_flag(published_files, KEY, "is_published"), KEY, "left")
          .join(_flag(received_files, KEY, "is_received"), KEY, "left")
          .join(failed.select("batchrundate", "filename", "failed_processes"),
                ["batchrundate", "filename"], "left"))
    if rule != "current":
        df = df.join(_flag(empty, ["batchrundate", "filename"], "is_empty"), ["batchrundate", "filename"], "left")
    if rule == "legacy":
        df = df.join(refdates.select(*KEY, "ref_ok"), KEY, "left")
    state, detail = _state(rule, F.coalesce("is_received", F.lit(False)))
    return df.select(*KEY, state.alias("state"), detail.alias("detail"))


def _state(rule: str, received: Column) -> tuple[Column, Column]:
    """State and detail of a file under a rule, over the flags joined to it."""
    pub = F.coalesce("is_published", F.lit(False))
    has_failed = F.col("failed_processes").isNotNull()
    if rule == "current":
        return F.when(pub & (received | has_failed), "done").otherwise("missing"), F.lit(None).cast("string")
    emp = F.coalesce("is_empty", F.lit(False))
    if rule == "bmt":
        state = (F.when(pub, "done").when(emp, "done").when(has_failed, "failed")
                 .when(received, "in_progress").otherwise("missing"))
        return state, F.when(~pub & ~emp & has_failed, F.col("failed_processes"))
    if rule == "legacy":
        is_pnd = T.last3("filename") == PND_SUFFIX
        ref_ok = F.coalesce("ref_ok", F.lit(False))
        state = (F.when(pub & is_pnd & ref_ok, "done")
                 .when(pub & is_pnd, "failed")
                 .when(pub, "done").when(emp, "done").when(has_failed, "failed")
                 .when(received, "in_progress").otherwise("missing"))
        return state, (F.when(pub & is_pnd & ~ref_ok, F.lit(REFDATE_REASON))
                       .when(~pub & ~emp & has_failed, F.col("failed_processes")))
    raise ValueError(f"unknown rule {rule!r}")


def trigger_states(expected: DataFrame, published_files: DataFrame, receipts: DataFrame, facts: DataFrame,
                   refdates: DataFrame | None = None) -> DataFrame:
    """D02 to D04 for both triggers in one pass: every expected file (with its ``rule``,
    see ``trigger_files``), judged by that rule. ``receipts``: ``received_flags``."""
    known = facts.select("batchrundate", "filename", F.col("empty_source").alias("is_empty"),
                         F.when(F.size("failed_list") > 0, F.array_join("failed_list", ",")).alias("failed_processes"))
    df = (expected.select(*KEY, "rule")
          .join(_flag(published_files, KEY, "is_published"), KEY, "left")
          .join(receipts.select(*KEY, "exact"), KEY, "left")
          .join(known, ["batchrundate", "filename"], "left"))
    if refdates is not None:
        df = df.join(refdates.select(*KEY, "ref_ok"), KEY, "left")
    # Where the exact match is asked for, the contained one does not count.
    judged = {rule: _state(rule, F.coalesce("exact", F.lit(False)) if rule == "current" else F.col("exact").isNotNull())
              for rule in ("bmt", "current", *(["legacy"] if refdates is not None else []))}
    pick = lambda i: F.coalesce(*[F.when(F.col("rule") == r, x[i]) for r, x in judged.items()])      # noqa: E731
    return df.select(*KEY, "rule", pick(0).alias("state"), pick(1).alias("detail"))


def readiness(states: DataFrame, rule: str = "bmt") -> DataFrame:
    """A03 to A07 + F09: counts per (batchrundate, regionname) in one aggregate.

    ``ready``: done = expected (current, legacy) or done >= expected (bmt); an
    empty expected list is ready (R7). ``names``: the message text of the
    rule -- legacy and current: missing files; bmt: decided by the last
    missing-or-failed file in name order (its name if it failed, else the
    missing list), as the reference's loop does. ``failed_files``: the
    failed files with their reasons, for the failure alert (bounded by the
    region's expected-file catalog).

    With ``rule="each"`` the states hold a ``rule`` column: one row per date, region
    and rule, in the same one aggregate.
    """
    st = F.col("state")
    keys = DAY_REGION + (["rule"] if rule == "each" else [])
    agg = states.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if(st == "done").alias("done"),
        F.count_if(st == "missing").alias("missing"),
        F.count_if(st == "failed").alias("failed"),
        F.count_if(st == "in_progress").alias("in_progress"),
        T.comma_list(F.collect_list(F.when(st == "missing", F.col("filename")))).alias("missing_names"),
        T.comma_list(F.collect_list(F.when(st == "failed", F.col("filename")))).alias("failed_names"),
        F.max(F.when(st.isin("missing", "failed"), F.struct(F.col("filename").alias("f"), st.alias("s"))))
        .alias("_last"),
        # Under the current rule no file is ever 'failed': only the others collect the reasons.
        *([F.array_sort(F.collect_list(F.when(st == "failed", F.struct("filename", "detail")))).alias("failed_files")]
          if rule != "current" else []),
    )
    if rule == "current":
        agg = agg.withColumn("failed_files", F.array().cast("array<struct<filename:string,detail:string>>"))
    bmt = F.col("rule") == "bmt" if rule == "each" else F.lit(rule == "bmt")
    ready = F.when(bmt, F.col("done") >= F.col("expected")).otherwise(F.col("done") == F.col("expected"))
    last = (F.when(F.col("_last.s") == "failed", F.col("_last.f"))
            .when(F.col("_last.s") == "missing", F.col("missing_names"))
            .otherwise(F.lit("")))
    names = F.when(bmt, last).otherwise(F.col("missing_names"))
    return agg.select(*keys, "expected", "done", "missing", "failed", "in_progress",
                      ready.alias("ready"), "missing_names", "failed_names", names.alias("names"), "failed_files")


READINESS_COLS = ["batchrundate", "regionname", "expected", "done", "missing", "failed", "in_progress", "ready",
                  "missing_names", "failed_names", "names"]
