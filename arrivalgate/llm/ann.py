"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample and sent to the tasks; every vector is
put into its leaf. A query walks the tree best bin first: a priority queue of
nodes ordered by closeness to the query yields leaves, and the first V of them
are searched. V is widened until a calibration set of queries, compared with
all rows in blocks, finds the wanted share of its true neighbours. Equal
vectors are one vector with its smallest ids: tree, search and audit see it
once, however many rows have it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from arrivalgate.llm.common import Scratch
from arrivalgate.llm.vectors import cosine, lengths, matrix, unit, usable

BIN_ROWS = 8192          # rows of neighbouring leaves that share a task group
TIE = 1e-9


class Tree:
    """Nodes with unit centres; ``children`` of a leaf is empty, ``leaf`` its number in depth-first order."""

    def __init__(self, sample: np.ndarray, branch: int, leaf_rows: int, seed: int = 3):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.leaves = 0
        rng = np.random.default_rng(seed)
        self._grow(sample, np.ones(sample.shape[1]) / np.sqrt(sample.shape[1]), branch, leaf_rows, rng)
        self.kid_centres = [np.array([self.centres[c] for c in kids]) for kids in self.children]

    def _grow(self, x: np.ndarray, centre: np.ndarray, branch: int, leaf_rows: int, rng) -> int:
        me = len(self.centres)
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        groups = _kmeans(x, branch, rng) if len(x) > leaf_rows else []
        if len(groups) < 2:
            self.leaf[me] = self.leaves
            self.leaves += 1
        else:
            self.children[me] = [self._grow(x[rows], c, branch, leaf_rows, rng) for c, rows in groups]
        return me

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: down the closest centres."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
            elif len(rows):
                best = (x[rows] @ self.kid_centres[node].T).argmax(axis=1)
                todo += [(c, rows[best == i]) for i, c in enumerate(self.children[node])]
        return out

    def visit(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order for one unit query."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.leaf[node]
            else:
                for c, s in zip(self.children[node], self.kid_centres[node] @ q):
                    heapq.heappush(queue, (-float(s), c))


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 8) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spherical k-means: (unit centre, rows) of the groups that are not empty."""
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    at = np.zeros(len(x), int)
    for _ in range(rounds):
        at = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        size = np.sqrt((total ** 2).sum(axis=1, keepdims=True))
        c = np.where(size > 0, total / np.maximum(size, 1e-30), c)
    at = (x @ c.T).argmax(axis=1)
    return [(c[i], np.flatnonzero(at == i)) for i in range(len(c)) if (at == i).any()]


def _best(q: np.ndarray, q_raw: np.ndarray, q_nid: np.ndarray, x: np.ndarray, x_raw: np.ndarray, x_nid: np.ndarray,
          x_id: np.ndarray, k: int, seen: np.ndarray | None = None, at: np.ndarray | None = None) -> tuple[list, list, list, list]:
    """The k closest rows of each query, ties to smaller ids; ``seen``: (queries, leaves) that may be compared, ``at``: the rows' leaves."""
    qi, ids, score, nids = [], [], [], []
    for s in range(0, len(q), 256):
        sim = q[s:s + 256] @ x.T
        sim[q_nid[s:s + 256, None] == x_nid[None, :]] = -3
        if seen is not None:
            sim[~seen[s:s + 256][:, at]] = -3
        n = min(k, sim.shape[1])
        least = -np.partition(-sim, n - 1, axis=1)[:, n - 1] - TIE
        for r in range(len(sim)):
            near = np.flatnonzero((sim[r] >= least[r]) & (sim[r] > -2))
            if len(near):
                exact = cosine(np.repeat(q_raw[s + r:s + r + 1], len(near), axis=0), x_raw[near])
                top = near[np.lexsort((x_nid[near], x_id[near], -exact))[:k]]
                qi += [s + r] * len(top)
                ids += x_id[top].tolist()
                nids += x_nid[top].tolist()
                score += cosine(np.repeat(q_raw[s + r:s + r + 1], len(top), axis=0), x_raw[top]).tolist()
    return qi, ids, score, nids


def _truth(rows: DataFrame, chosen: pd.DataFrame, size: int, k: int) -> pd.DataFrame:
    """(query, nid) of the k true neighbours of the calibration queries, from all rows in blocks."""
    raw = matrix(chosen["raw"], size)
    sent = rows.sparkSession.sparkContext.broadcast((unit(raw), raw, chosen["nid"].to_numpy()))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, q_raw, q_nid = sent.value
        held: list[pd.DataFrame] = []       # the best of this task so far; one small set leaves it

        def best() -> pd.DataFrame:
            return pd.concat(held).sort_values(["score", "id", "nid"], ascending=[False, True, True]).groupby("query").head(k)

        for pdf in batches:
            for s in range(0, len(pdf), BIN_ROWS):
                part = pdf.iloc[s:s + BIN_ROWS]
                x = matrix(part["raw"], size)
                qi, ids, score, nids = _best(q, q_raw, q_nid, unit(x), x, part["nid"].to_numpy(), part["id"].to_numpy(), k)
                held.append(pd.DataFrame({"query": q_nid[qi], "id": ids, "score": score, "nid": nids}))
            if len(held) > 16:
                held = [best()]
        if held:
            yield best()

    order = W.partitionBy("query").orderBy(F.desc("score"), "id", "nid")
    return rows.select("nid", "id", "raw").mapInPandas(scan, "query long, id long, score double, nid long") \
        .withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("query", "nid").toPandas()


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50, recall: float = 0.96, sample_rows: int = 20_000,
            branch: int = 16, leaf_rows: int = 48, calibration: int = 200, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), id and ``score`` (cosine in double
    precision) of the ``k`` nearest rows found for every row whose id is
    divisible by ``every``; candidates are all rows but the query's own.

    The tree is fitted on at most ``sample_rows`` vectors (by id hash) and the
    number of leaves searched is set on at most ``calibration`` queries, whose
    true neighbours come from a scan of all rows.

    Defined cases: vectors that are null, zero or hold a null or non-finite
    component and rows with a null id take no part; vectors are compared with
    those of their own length, every length with a tree of its own; equal scores go to the smaller
    id; rows that repeat an id are candidates of their own, and each is a
    query (with the same id) if its id is divisible; equal vectors are
    searched once and give their ``k`` smallest ids; fewer candidates than
    ``k`` are all returned; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "ann")
    ok = F.col(id_col).isNotNull() & usable(F.col(vec_col))
    rows = scratch.save(embeddings.where(ok).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("raw"))
                        .withColumn("nid", F.monotonically_increasing_id()), "rows")
    out = None
    for size in lengths(rows, "raw"):
        part = _nearest(rows.where(F.size("raw") == size), size, k, every, recall, sample_rows, branch, leaf_rows, calibration)
        if part is not None:
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    return out.withColumnRenamed("id", id_col)


def _nearest(rows: DataFrame, size: int, k: int, every: int, recall: float, sample_rows: int, branch: int, leaf_rows: int,
             calibration: int) -> DataFrame | None:
    """``query_id``, ``rank``, ``id``, ``score`` over the usable vectors (nid, id, raw) of one length; None without a query."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "ann")
    # equal vectors are one: the row with the smallest id stands for all; k + 1 ids, one of which may be a query's own, are
    # all that a result can show of them (every task keeps no more before the shuffle)
    place = F.row_number().over(W.partitionBy("raw").orderBy("id", "nid"))
    least = rows.withColumn("r", place).where(F.col("r") <= k + 1).groupBy("raw").agg(
        F.sort_array(F.collect_list(F.struct("id", "nid"))).alias("m"))
    vectors = scratch.save(least.select(F.col("m")[0]["nid"].alias("nid"), F.col("m")[0]["id"].alias("id"), "raw",
                                        F.col("m.id").alias("ids"), F.col("m.nid").alias("nids")), "vectors")
    fit = vectors.orderBy(F.xxhash64("id", F.lit(17)), "nid").limit(sample_rows).select("raw").toPandas()
    tree = Tree(unit(matrix(fit["raw"], size)), branch, leaf_rows)
    sent = spark.sparkContext.broadcast(tree)

    @F.pandas_udf("int")
    def leaf_of(raw: pd.Series) -> pd.Series:
        return pd.Series(sent.value.place(unit(matrix(raw, size)))) if len(raw) else pd.Series([], dtype="int32")

    placed = scratch.save(vectors.withColumn("leaf", leaf_of("raw")), "placed")
    counts = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():       # one row per leaf of the bounded tree
        counts[r["leaf"]] = r["count"]
    # neighbouring leaves fill a bin; a leaf that is larger than a bin is split over several groups
    bin_of = ((np.cumsum(counts) - counts) // BIN_ROWS).astype(np.int64)
    first = {int(b): int(np.flatnonzero(bin_of == b)[0]) for b in np.unique(bin_of)}
    in_bin = {int(b): int(counts[bin_of == b].sum()) for b in np.unique(bin_of)}
    asking = rows.where(F.col("id") % every == 0).join(vectors.select("raw", F.col("nid").alias("query")), "raw")
    asking = scratch.save(asking.select("query", F.col("id").alias("query_id"), F.col("nid").alias("own")), "asking")
    queries = placed.join(asking.select(F.col("query").alias("nid")).distinct(), "nid", "left_semi")
    queries = scratch.save(queries, "queries")
    chosen = queries.orderBy(F.xxhash64("id", F.lit(29)), "nid").limit(calibration).select("nid", "raw").toPandas()
    if not len(chosen):
        return None
    visits = _widen(tree, placed, chosen, size, k, recall)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = {"nid": [], "raw": [], "bin": [], "leaves": []}
            for nid, raw, q in zip(pdf["nid"], pdf["raw"], unit(matrix(pdf["raw"], size)) if len(pdf) else []):
                bins: dict[int, list[int]] = {}
                rows_seen = 0
                for n, leaf in enumerate(sent.value.visit(q)):
                    if n >= visits and rows_seen > k:
                        break
                    rows_seen += int(counts[leaf])
                    bins.setdefault(int(bin_of[leaf]), []).append(leaf)
                for b, leaves in bins.items():      # at most one row per query and bin
                    for name, value in zip(out, (nid, raw, b, leaves)):
                        out[name].append(value)
            yield pd.DataFrame(out)

    asked = queries.select("nid", "raw").mapInPandas(walk, "nid long, raw array<double>, bin int, leaves array<int>")
    # one row per leaf of the bounded tree
    plan = spark.createDataFrame([(i, int(b), max(1, -(-in_bin[int(b)] // BIN_ROWS))) for i, b in enumerate(bin_of)],
                                 "leaf int, bin int, parts int")
    stored = placed.join(F.broadcast(plan), "leaf").withColumn("part", F.pmod(F.xxhash64("nid"), F.col("parts")).cast("int"))
    asked = asked.join(F.broadcast(plan.select("bin", "parts").distinct()), "bin") \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    tree_leaves = int(np.bincount(bin_of).max())       # most leaves in a bin

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "id": [], "nid": [], "score": [], "ids": [], "nids": []})
        q_raw, x_raw = matrix(left["raw"], size), matrix(right["raw"], size)
        low = first[int(left["bin"].iloc[0])]
        at = right["leaf"].to_numpy() - low
        seen = np.zeros((len(left), tree_leaves), bool)
        for i, leaves in enumerate(left["leaves"]):
            seen[i, np.asarray(leaves) - low] = True
        qi, ids, score, nids = _best(unit(q_raw), q_raw, left["nid"].to_numpy(), unit(x_raw), x_raw, right["nid"].to_numpy(),
                                     right["id"].to_numpy(), k, seen, at)
        at = pd.Index(right["nid"]).get_indexer(nids)
        return pd.DataFrame({"query": left["nid"].to_numpy()[qi], "id": ids, "nid": nids, "score": score,
                             "ids": right["ids"].to_numpy()[at], "nids": right["nids"].to_numpy()[at]})

    @F.pandas_udf("double")
    def itself(raw: pd.Series) -> pd.Series:
        x = matrix(raw, size)
        return pd.Series(cosine(x, x) if len(x) else [], dtype=float)

    found = asked.groupBy("bin", "part").cogroup(stored.select("nid", "id", "raw", "leaf", "ids", "nids", "bin", "part").groupBy("bin", "part")) \
        .applyInPandas(search, "query long, id long, nid long, score double, ids array<long>, nids array<long>")
    order = W.partitionBy("query").orderBy(F.desc("score"), "id", "nid")
    top = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("query", "score", "ids", "nids")
    top = top.union(queries.select("nid", itself("raw"), "ids", "nids"))      # the query's own equals
    # at most (k + 1) ids of k + 1 vectors a query vector, for all rows that ask with it
    rows_of = F.transform(F.arrays_zip("ids", "nids"), lambda x: F.struct(
        (-F.col("score")).alias("s"), x["ids"].alias("id"), x["nids"].alias("nid")))
    lists = top.groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list(rows_of))), 1, k + 1).alias("best"))
    others = F.slice(F.filter("best", lambda x: x["nid"] != F.col("own")), 1, k)
    out = asking.join(lists, "query").select("query_id", F.posexplode(others).alias("p", "x"))
    return out.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("id"), (-F.col("x.s")).alias("score"))


def _widen(tree: Tree, placed: DataFrame, chosen: pd.DataFrame, size: int, k: int, recall: float) -> int:
    """Leaves to search so that the calibration queries find ``recall`` of their true neighbours."""
    truth = _truth(placed, chosen, size, k)
    ids = placed.sparkSession.createDataFrame(truth[["nid"]].drop_duplicates())     # at most k per calibration query
    leaf = placed.join(F.broadcast(ids), "nid").select("nid", "leaf").toPandas().set_index("nid")["leaf"]
    place = []
    for nid, q in zip(chosen["nid"], unit(matrix(chosen["raw"], size))):
        order = {x: i for i, x in enumerate(tree.visit(q))}
        place += [order[leaf[n]] for n in truth.loc[truth["query"] == nid, "nid"]]
    visits = 1
    while visits < tree.leaves and place and np.mean(np.array(place) < visits) < recall:
        visits = min(tree.leaves, max(visits + 1, int(visits * 1.25)))
    return visits
