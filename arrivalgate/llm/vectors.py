"""Embedding vectors: which ones take part, and their cosine in double precision."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def usable(col: Column) -> Column:
    """Not null, not zero, no null or non-finite component."""
    x = col.cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    some = F.exists(x, lambda c: c != 0)
    return F.coalesce(col.isNotNull() & ~bad & some, F.lit(False))


def lengths(rows: DataFrame, vec_col: str) -> list[int]:
    """Lengths that two or more of the vectors have; a vector is compared with those of its own length."""
    got = rows.where(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("size")).count().where("count > 1")
    return sorted(r["size"] for r in got.collect())


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal rows give equal results wherever they stand."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def matrix(col, size: int) -> np.ndarray:
    """Rows of an array column as a double matrix."""
    return np.array(col.tolist(), dtype=np.float64).reshape(-1, size)
