"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from arrivalgate.llm.common import Scratch

EDGES_PER_TASK = 500_000


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, roots): the smallest id reachable from each over the edges (a, b)."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for k in (x, y, label[x], label[y]):        # the ends, and the roots that they had
            np.minimum.at(new, k, low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return ids, ids[label]
        label = new


def _part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    got = [b[["a", "b"]].to_numpy(np.int64) for b in batches]
    if got:
        ids, roots = least_labels(*np.concatenate(got).T)
        yield pd.DataFrame({"id": ids, "root": roots})


def components(edges: DataFrame, scratch: Scratch, name: str, per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(id, root) for every id of ``edges`` (a, b; a stored table): the smallest id reachable.

    The edges are first contracted where they lie, about ``per_task`` of them in a task:
    each id of a part points to the smallest id that the part's edges reach. Where there
    are several parts, rounds over all of them follow. Every round gives each id the
    smallest label among its own, its neighbours' and its label's label, so labels
    travel twice as far each round; each is a written table, the superseded ones are dropped.
    """
    edges = edges.select("a", "b").where("a <> b")
    parts = -(-edges.count() // per_task)
    flat = scratch.save(edges.coalesce(max(parts, 1)).mapInPandas(_part, "id long, root long"), f"{name}-parts")
    if parts <= 1:
        return flat
    pairs = flat.select(F.col("id").alias("a"), F.col("root").alias("b")).where("a <> b")
    both = scratch.save(pairs.union(pairs.select("b", "a")).distinct(), f"{name}-both")
    first = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("root"))
    labels = scratch.save(first, f"{name}-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.select(F.col("id").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        seen = labels.join(near.select(F.col("a").alias("id"), "m"), "id").select(
            "id", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        seen = scratch.save(seen, f"{name}-near-{step}")
        jump = seen.select(F.col("id").alias("root"), F.col("root").alias("up"))
        new = seen.join(jump, "root").select("id", "old", F.least("root", "up").alias("root"))
        new = scratch.save(new, f"{name}-{step}")
        moved = new.where("root <> old").limit(1).count()
        scratch.drop(f"{name}-{step - 1}")
        scratch.drop(f"{name}-near-{step}")
        labels = new.select("id", "root")
        if not moved:
            return labels
