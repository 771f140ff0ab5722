"""Corpus pipeline: quality, language, near duplicates, mixing, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all documents
that its predecessor kept. All but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from arrivalgate.llm import langid, mixing, neardup, packing, quality
from arrivalgate.llm.common import Scratch

KEY_BROADCAST_ROWS = 2_000_000


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labels, scores 0.3 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = quality.classify(docs.withColumn("__row", F.struct(*docs.columns)), labels)
    return got.where("predicted = 1").select("__row.*")


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents accepted as the language they are identified as."""
    got = langid.classify(docs.withColumn("__row", F.struct(*docs.columns)))
    return got.where("accepted").select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the
    smallest doc_id (a null one last). Rows that repeat id and text count once."""
    scratch = Scratch(spark, "pipeline-dedup")
    key = F.xxhash64(F.col("doc_id"), F.col("doc_id").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull())
    keyed = docs.withColumn("__key", key)
    slim = scratch.save(keyed.groupBy("__key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")), "keys")
    found = neardup.near_duplicates(keyed.select("__key", "text"), id_col="__key").select("__key", "component_id").distinct()
    joined = scratch.save(found.join(slim, "__key"), "components")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__key")
    first = joined.groupBy("component_id").agg(F.min_by("__key", order).alias("__first"))
    gone = joined.join(first, "component_id").where(F.col("__key") != F.col("__first")).select("__key")
    gone = scratch.save(gone, "gone")
    again = scratch.save(slim.where("n > 1").select("__key"), "again")
    gone_rows, again_rows = gone.count(), again.count()
    kept = keyed.join(F.broadcast(gone) if gone_rows <= KEY_BROADCAST_ROWS else gone, "__key", "left_anti")
    if again_rows:
        again = F.broadcast(again) if again_rows <= KEY_BROADCAST_ROWS else again
        one = kept.join(again, "__key", "left_semi").dropDuplicates(["__key"])
        kept = kept.join(again, "__key", "left_anti").unionByName(one)
    return kept.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: every document as often as it is taken."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, ids included, with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, 2048, 0)


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fitted models and shingle sets are beyond SQL: tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
