"""Mixing sources to target weights by Pareto order sampling.

A source whose target is r times its size takes floor(r) certain copies of
every document. The rest is a Pareto sample: with u a hash of the document in
(0, 1) and f the inclusion chance, a document's rank is the odds of u divided
by the odds of f, and documents are taken in rank order until the source's
quota of words is full. With a weight column the chances differ inside a
source too (``f * weight / mean weight``; a chance of 1 or more gives certain
copies).

The order is never sorted per source. The rank is mapped to (0, 1) and cut
into buckets; a grouped sum of words per (source, bucket) finds the bucket in
which the quota ends; only that bucket's documents are ordered, to find the
last rank taken. The decision is then a comparison of each document with its
source's cut, so the documents themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from arrivalgate.llm.common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SOURCE_BROADCAST_ROWS = 200_000
NEAR_BUCKETS = 512


def words(text_col: str) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a per-source table of known row count below the limit; above it
    the join is a shuffled one, whose hot sources AQE splits."""
    return F.broadcast(df) if rows <= SOURCE_BROADCAST_ROWS else df


def source_order(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Add ``pos``: the place of each source by code point, null last, from 0.
    Ranges are ranked by their own tasks and shifted by the rows before them."""
    placed = scratch.save(
        sources.withColumn("__null", F.col("source").isNull())
        .repartitionByRange(F.col("__null"), F.col("source")).sortWithinPartitions("__null", "source")
        .withColumn("__pid", F.spark_partition_id()), "ranges")
    size = placed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per range: as many rows as shuffle partitions
    ahead = W.orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)
    before = size.select("__pid", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__base"))
    local = F.row_number().over(W.partitionBy("__pid").orderBy("__null", "source")) - 1
    return (placed.withColumn("__r", local).join(F.broadcast(before), "__pid")
            .select("source", "source_size", "docs", (F.col("__base") + F.col("__r")).alias("pos")))


def targets(sources: DataFrame, weights: Sequence[float], most: float, scratch: Scratch) -> DataFrame:
    """Add ``target`` to a table (source, source_size, docs): the total size is
    shared by weight, targets stop at ``most`` times their source's size, and
    the excess is shared again by weight until none is above."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     F.pmod(F.col("pos"), F.lit(len(weights))).cast("int") + 1)
    t = scratch.save(source_order(sources, scratch).withColumn("w", w), "weights")
    cap = F.col("source_size") * most
    total = t.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s")).first()["s"]
    level = 0.0
    while True:
        full = cap <= F.lit(level) * F.col("w")
        got = t.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("c"),
                    F.sum(F.when(~full, F.col("w"))).alias("w")).first()
        new = level if not got["w"] else (total - got["c"]) / got["w"]
        if new <= level * (1 + 1e-12):
            break
        level = new
    return t.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("w")))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight_col: str | None = None, buckets: int = 4096) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    Sources ordered by code point (null last) weigh ``weights`` in turn. The
    result depends on the rows only, so reruns agree.

    Defined cases: a null text has size 0 and is taken 0 words; a null source
    is a source of its own; rows that agree in id and text share one rank and
    are taken or left together; a source whose words are all 0 has target 0;
    an empty table gives an empty result; a null or non-positive weight counts
    as 0; input columns named like a result are replaced, others pass through.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    out = ["size", "source_size", "target", "copies", "taken"]
    keep = [c for c in docs.columns if c not in out]
    u = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))
    u = (F.shiftrightunsigned(u, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    wt = F.lit(1.0) if weight_col is None else F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0))
    sized = docs.select(*keep, words(text_col).alias("size"), u.alias("__u"), wt.alias("__w"),
                        F.col(source_col).cast("string").alias("__src"))
    slim = scratch.save(sized.select("size", "__u", "__w", "__src"), "sizes")
    sums = slim.groupBy(F.col("__src").alias("source")).agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"),
        F.sum(F.col("size") * F.col("__w")).alias("weighted"))
    sums = scratch.save(sums, "sums")
    goals = targets(sums.select("source", "source_size", "docs"), weights, most, scratch)
    goals = goals.join(sums.select(F.col("source").alias("__k"), "weighted"), F.col("source").eqNullSafe(F.col("__k")))
    # copies expected of a document of weight w: rate * w
    rate = F.when(F.col("weighted") > 0, F.col("target") / F.col("weighted")).otherwise(F.lit(0.0))
    goals = scratch.save(goals.select(F.col("source").alias("__s"), "source_size", "target", rate.alias("__rate")), "goals")
    n_sources = goals.count()

    def placed(df: DataFrame) -> DataFrame:
        df = df.join(_small(goals, n_sources), F.col("__src").eqNullSafe(F.col("__s")))
        m = F.least(F.col("__rate") * F.col("__w"), F.lit(float(most)))
        near = F.abs(m - F.round(m)) < 1e-12
        df = df.withColumn("__m", F.when(near, F.round(m)).otherwise(m))
        df = df.withColumn("__sure", F.floor("__m").cast("long")).withColumn("__f", F.col("__m") - F.floor("__m"))
        odds = (F.col("__u") / (1 - F.col("__u"))) / (F.col("__f") / (1 - F.col("__f")))
        return df.withColumn("__v", F.when(F.col("__f") > 0, odds / (1 + odds)))

    ranked = placed(slim).where("__v is not null and size > 0")
    ranked = ranked.withColumn("__b", F.floor(F.col("__v") * buckets).cast("long"))
    need = placed(slim).groupBy("__s").agg((F.first("target") - F.sum(F.col("__sure") * F.col("size"))).alias("__need"))
    fill = ranked.groupBy("__s", "__b").agg(F.sum("size").alias("__words"))
    upto = W.partitionBy("__s").orderBy("__b").rowsBetween(W.unboundedPreceding, 0)
    fill = fill.withColumn("__upto", F.sum("__words").over(upto)).join(
        _small(need.withColumnRenamed("__s", "__ns"), n_sources), F.col("__s").eqNullSafe(F.col("__ns")))
    fill = fill.withColumn("__left", F.col("__need") - (F.col("__upto") - F.col("__words")))
    # the bucket in which the quota ends: its documents alone are put in order
    edge = scratch.save(fill.where((F.col("__left") > 0) & (F.col("__words") >= F.col("__left")))
                        .select(F.col("__s").alias("__es"), F.col("__b").alias("__eb"), "__left"), "edges")
    tied = ranked.join(_small(edge, n_sources), F.col("__s").eqNullSafe(F.col("__es")) & (F.col("__b") == F.col("__eb"))) \
        .groupBy("__es", "__v").agg(F.sum("size").alias("__words"), F.first("__left").alias("__left"))
    order = W.partitionBy("__es").orderBy("__v")
    tied = tied.withColumn("__upto", F.sum("__words").over(order.rowsBetween(W.unboundedPreceding, 0)))
    fits = (F.col("__upto") <= F.col("__left")) | (F.col("__upto") - F.col("__left") < F.col("__left") - (F.col("__upto") - F.col("__words")))
    last = tied.where(fits).groupBy("__es").agg(F.max("__v").alias("__last"))
    # no rank of the edge bucket fits: everything before the bucket is taken
    cuts = edge.join(last.withColumnRenamed("__es", "__ls"), F.col("__es").eqNullSafe(F.col("__ls")), "left") \
        .select(F.col("__es").alias("__cs"), F.col("__eb") / F.lit(float(buckets)),
                F.coalesce("__last", F.lit(-1.0))).toDF("__cs", "__open", "__last")
    # a prefix of whole documents misses the quota by up to half a document: the one document near
    # the cut whose size comes closest to the miss changes sides (still taken by rank, never by source)
    got = tied.where(fits).groupBy("__es").agg(F.max("__upto").alias("__got"))
    miss = edge.join(got.withColumnRenamed("__es", "__gs"), F.col("__es").eqNullSafe(F.col("__gs")), "left") \
        .select(F.col("__es").alias("__ms"), F.col("__eb").alias("__mb"),
                (F.col("__left") - F.coalesce("__got", F.lit(0))).alias("__miss"))
    cuts = scratch.save(cuts.join(miss.select("__ms", "__mb", "__miss"), F.col("__cs").eqNullSafe(F.col("__ms"))).drop("__ms"), "prefix")
    close = ranked.join(_small(cuts, n_sources), F.col("__s").eqNullSafe(F.col("__cs"))
                        & F.col("__b").between(F.col("__mb") - NEAR_BUCKETS, F.col("__mb") + NEAR_BUCKETS)) \
        .groupBy("__cs", "__v").agg(F.sum("size").alias("__words"), F.first("__miss").alias("__miss"),
                                    F.first((F.col("__v") < F.col("__open")) | (F.col("__v") <= F.col("__last"))).alias("__in"))
    after = F.abs(F.abs("__miss") - F.col("__words"))
    change = close.where((F.col("__in") == (F.col("__miss") < 0)) & (after < F.abs("__miss"))) \
        .groupBy("__cs").agg(F.min_by("__v", F.struct(after, F.col("__v"))).alias("__change"))
    cuts = cuts.join(change.withColumnRenamed("__cs", "__hs"), F.col("__cs").eqNullSafe(F.col("__hs")), "left")
    # sources that never reach their quota (or need nothing) take all (or none) of their ranked documents
    cuts = need.join(cuts, F.col("__s").eqNullSafe(F.col("__cs")), "left").select(
        F.col("__s").alias("__cs"), "__change",
        F.when(F.col("__need") <= 0, -1.0).otherwise(F.coalesce("__open", F.lit(2.0))).alias("__open"),
        F.when(F.col("__need") <= 0, -1.0).otherwise(F.coalesce("__last", F.lit(2.0))).alias("__last"))
    cuts = scratch.save(cuts, "cuts")
    full = placed(sized).join(_small(cuts, n_sources), F.col("__src").eqNullSafe(F.col("__cs")))
    early = (F.col("__v") < F.col("__open")) | (F.col("__v") <= F.col("__last"))
    changed = F.coalesce(F.col("__v") == F.col("__change"), F.lit(False))
    extra = F.coalesce(F.when(changed, ~early).otherwise(early) & (F.col("size") > 0), F.lit(False))
    copies = F.col("__sure") + extra.cast("long")
    return full.select(*keep, "size", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as :func:`mix` takes it, in its own columns."""
    got = mix(docs, **options).withColumn("__copy", F.explode(F.expr("sequence(1, copies)")))
    return got.where("copies > 0").select(*docs.columns)
