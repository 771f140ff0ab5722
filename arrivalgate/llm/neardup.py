"""Near-duplicate documents by an inverted join of MinHash signature coordinates.

Texts with equal shingle sets are one class. Every class is posted under its
(coordinate, value) pairs. Two classes with at least ``matches`` of ``coords``
equal coordinates share one of the ``coords - matches + 1`` rarest pairs of
either, so only these prefixes are merged; a class with fewer than ``matches``
shared pairs is skipped altogether.

A posting list of up to ``SHORT`` classes gives all its pairs. A longer list
gives only its pairs with one hub, the class with most shared coordinates. The
pairs' collisions are counted on the whole signatures and the survivors
confirmed on the full sets. Hub groups whose members are by then still in
different components are finished exactly: the members outside the largest
component meet all members block by block inside tasks, which compare full sets of
different components and return the links that join them. No group is cut short and
no group's pairs become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from arrivalgate.llm import shingles
from arrivalgate.llm.common import Scratch
from arrivalgate.llm.graph import components

SHORT = 12
BLOCK = 512
ID_BROADCAST_ROWS = 2_000_000


def profiles(docs: DataFrame, id_col: str, text_col: str, k: int, coords: int) -> DataFrame:
    """id, ``n`` (shingles), ``d1``, ``d2`` (digests of the set), ``sig`` of every whole text."""

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = 0
            for part in shingles.chunks(pdf["text"].tolist()):
                s, n = shingles.shingle_sets(part, k)
                d = shingles.digests(s, n)
                yield pd.DataFrame({"id": pdf["id"].iloc[at:at + len(part)].to_numpy(), "n": n, "d1": d[:, 0], "d2": d[:, 1],
                                    "sig": list(shingles.signatures(s, n, coords).view(np.int32))})
                at += len(part)

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInPandas(profile, "id long, n long, d1 long, d2 long, sig array<int>")


def full_sets(docs: DataFrame, wanted: DataFrame, classes: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(cid, s): the sorted shingles of the wanted classes (column ``cid``), taken from their first documents."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in shingles.chunks(pdf["text"].tolist()):
                s, n = shingles.shingle_sets(part, k)
                d = shingles.digests(s, n)
                ends = np.cumsum(n)
                yield pd.DataFrame({"n": n, "d1": d[:, 0], "d2": d[:, 1],
                                    "s": [s[e - m:e].view(np.int64) for e, m in zip(ends, n)]})

    chosen = classes.join(wanted, "cid", "left_semi")
    ids = chosen.where("first is not null").select(F.col("first").alias("__id")).distinct()
    ids = F.broadcast(ids) if wanted.count() <= ID_BROADCAST_ROWS else ids
    slim = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("text"))
    named = slim.join(ids, "__id", "left_semi").unionByName(slim.where("__id is null")).select("text")
    got = named.mapInPandas(sets, "n long, d1 long, d2 long, s array<long>")
    return got.join(chosen.select("cid", "n", "d1", "d2"), ["n", "d1", "d2"]).groupBy("cid").agg(F.first("s").alias("s"))


def prefixes(classes: DataFrame, coords: int, matches: int, scratch: Scratch) -> DataFrame:
    """(cid, token, shared): each class under its rarest shared tokens, enough of
    them that any two classes with ``matches`` equal coordinates share one."""
    token = F.shiftleft(F.col("c").cast("long"), 32) + (F.col("v").cast("long").bitwiseAND(0xFFFFFFFF))
    tokens = classes.select("cid", F.posexplode("sig").alias("c", "v")).select("cid", token.alias("token"))
    often = scratch.save(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "tokens")
    held = tokens.join(often, "token").groupBy("cid").agg(
        F.count(F.lit(1)).alias("shared"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
    held = held.where(F.col("shared") >= matches)
    # the coordinates that no other class shares are the rarest: they use up the first places of the prefix
    part = F.slice("t", F.lit(1), (F.col("shared") - F.lit(matches - 1)).cast("int"))
    return held.select("cid", "shared", F.explode(F.transform(part, lambda x: x["token"])).alias("token"))


def _close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    one = pairs.join(sets.select(F.col("cid").alias("a"), F.col("s").alias("sa")), "a") \
        .join(sets.select(F.col("cid").alias("b"), F.col("s").alias("sb")), "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    return one.where(100 * inter >= percent * (F.size("sa") + F.size("sb") - inter)).select("a", "b")


def _finish(members: DataFrame, scratch: Scratch, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between different components of the same hub group, with the components' roots (ra, rb).

    ``members``: hub, cid, root. A group's largest component holds no link that is still
    unknown, so only its other members, the strays, are compared: each block of strays
    meets each block of members in a bounded task group. A member is sent to as many task
    groups as its hub has blocks of strays."""

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["stray", "cid"]).reset_index(drop=True)
        cid, root, size = pdf["cid"].to_numpy(), pdf["root"].to_numpy(), pdf["s"].map(len).to_numpy()
        _, local = np.unique(np.concatenate(pdf["s"].to_list()), return_inverse=True)
        ends = np.cumsum(size)
        start = ends - size
        n = int((~pdf["stray"].to_numpy(bool)).sum())        # the block's members come first, then its strays
        _, comp = np.unique(root, return_inverse=True)
        flag = np.zeros(local.max() + 1, bool)
        out = []
        for i in range(n, len(pdf)):
            other = comp[:n] != comp[i]
            if not other.any():
                continue
            flag[local[start[i]:ends[i]]] = True
            inter = np.add.reduceat(flag[local[:ends[n - 1]]], start[:n], dtype=np.int64)
            flag[local[start[i]:ends[i]]] = False
            for j in np.flatnonzero(other & (100 * inter >= percent * (size[:n] + size[i] - inter))):
                if comp[j] != comp[i]:
                    x, y = (i, j) if cid[i] < cid[j] else (j, i)
                    out.append((cid[x], cid[y], root[x], root[y]))
                    comp[comp == comp[j]] = comp[i]
        return pd.DataFrame(out, columns=["a", "b", "ra", "rb"], dtype="int64")

    held = members.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("hub").agg(
        F.sum("c").alias("m"), F.max(F.struct("c", "root")).alias("big"))
    blocks = lambda n: F.ceil(n / block).cast("int")      # noqa: E731
    open_ = scratch.save(held.where(F.col("m") > F.col("big.c")).select(
        "hub", F.col("big.root").alias("big"), blocks(F.col("m")).alias("mb"), blocks(F.col("m") - F.col("big.c")).alias("sb")), "open")
    if not open_.limit(1).count():
        return open_.select(*[F.col("hub").alias(c) for c in ("a", "b", "ra", "rb")])
    mine = members.join(open_, "hub")
    own = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")      # noqa: E731
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))      # noqa: E731
    met = mine.select("hub", "cid", "root", F.lit(False).alias("stray"), own("mb").alias("y"), each("sb").alias("x")).unionByName(
        mine.where("root <> big").select("hub", "cid", "root", F.lit(True).alias("stray"), own("sb").alias("x"), each("mb").alias("y")))
    return met.join(sets, "cid").groupBy("hub", "x", "y").applyInPandas(link, "a long, b long, ra long, rb long")


def near_duplicates(docs: DataFrame, percent: int = 75, k: int = 5, coords: int = 64, matches: int = 34,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked whose sets of distinct ``k``-word shingles (words of
    the A-Z-lower-cased whole text; a shorter text is one shingle) have
    ``100 * intersection >= percent * union``. ``component_id`` is the smallest
    id reachable over links, the document's own included; ``kept`` marks the
    document whose id that is. At similarity 0.75 a link has 34 of 64 equal
    coordinates with probability above 0.9998.

    Defined cases: null and empty texts and texts without words have no
    shingles and are linked with nothing; equal sets are linked; rows that
    repeat an id each get their row, and two of them may be kept; a null id is
    no component id unless its whole component has none; an empty table gives
    an empty result. Ids are integers. Only the id and the text are read.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    rows = scratch.save(profiles(docs, id_col, text_col, k, coords), "profiles")
    classes = rows.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("id").alias("first"), F.first("sig").alias("sig"))
    classes = scratch.save(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    posts = scratch.save(prefixes(classes, coords, matches, scratch), "posts")
    lists = posts.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.max(F.struct("shared", (-F.col("cid")).alias("c"))).alias("h"))
    lists = scratch.save(lists.where("m > 1").select("token", "m", (-F.col("h.c")).alias("hub")), "lists")

    short = posts.join(lists.where(F.col("m") <= SHORT), "token").groupBy("token").agg(F.sort_array(F.collect_list("cid")).alias("l"))
    short = short.select(F.explode("l").alias("a"), "l").select("a", F.explode(F.filter("l", lambda x: x > F.col("a"))).alias("b"))
    stars = scratch.save(posts.join(lists.where(F.col("m") > SHORT), "token").where("cid <> hub").select("hub", "cid").distinct(), "stars")
    pairs = short.union(stars.select(F.least("hub", "cid"), F.greatest("hub", "cid"))).distinct()
    sig = classes.select("cid", "sig")
    met = pairs.join(sig.select(F.col("cid").alias("a"), F.col("sig").alias("ga")), "a") \
        .join(sig.select(F.col("cid").alias("b"), F.col("sig").alias("gb")), "b")
    equal = F.size(F.filter(F.zip_with("ga", "gb", lambda x, y: x == y), lambda x: x))
    met = scratch.save(met.where(equal >= matches).select("a", "b"), "met")
    wanted = scratch.save(met.select(F.col("a").alias("cid")).union(met.select("b")).union(stars.select("cid"))
                          .union(stars.select("hub")).distinct(), "wanted")
    sets = scratch.save(full_sets(docs, wanted, classes, id_col, text_col, k), "sets")
    links = scratch.save(_close(met, sets, percent), "links")
    roots = components(links, scratch, "first")

    found = classes.select("n", "d1", "d2", "cid", "first").join(roots.withColumnRenamed("id", "cid"), "cid", "left") \
        .withColumn("root", F.coalesce("root", "cid"))
    if stars.limit(1).count():
        members = stars.union(stars.select("hub", F.col("hub").alias("cid"))).distinct() \
            .join(roots.withColumnRenamed("id", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
        more = scratch.save(_finish(scratch.save(members, "members"), scratch, sets, percent), "more")
        if more.limit(1).count():       # links between components: the graph of their roots
            up = components(more.select(F.col("ra").alias("a"), F.col("rb").alias("b")), scratch, "second").select(F.col("id").alias("root"), F.col("root").alias("up"))
            found = found.join(up, "root", "left").withColumn("root", F.coalesce("up", "root")).drop("up")

    least = scratch.save(found.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    found = found.join(least, "root").select("n", "d1", "d2", "component_id")
    out = rows.drop("sig").join(found, ["n", "d1", "d2"], "left")
    comp = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(F.col("id") == comp, F.lit(False)).alias("kept"))
