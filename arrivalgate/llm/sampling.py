"""Bounded, reproducible samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arrivalgate.llm.common import fold_of


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int = 5, held_out: int = 0,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, y) of at most ``per_class`` labelled documents of each class,
    drawn by the hash of the id from the folds other than ``held_out``.

    The ids are chosen from the labels alone (a bounded top-k per class), so
    the documents are only filtered by a broadcast of at most 2 * ``per_class``
    ids. Null ids and labels other than 0 and 1 are not used; a document with
    several labels counts with the largest; a document id that several texts
    share is not used, as its label names none of them.
    """
    ids = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & (fold_of(id_col, folds) != held_out)) \
        .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("y"))
    part = [ids.where(F.col("y") == y).orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(per_class) for y in (0, 1)]
    chosen = part[0].unionByName(part[1])
    hit = docs.select(F.col(id_col).alias("__d"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .join(F.broadcast(chosen), F.col("__d") == F.col("__id"))
    return hit.select("__id", "text", "y")


def once(rows):
    """Rows of a collected sample whose id occurs once, in id order (pandas)."""
    return rows[~rows["__id"].duplicated(keep=False)].sort_values("__id").reset_index(drop=True)
