"""Sharding by balanced label propagation.

Documents linked by a shared key (a hub, here an equal text) should share a
shard, while every shard keeps its exact number of rows. Links are kept as
memberships (document, hub), never as pairs, so a hub that a third of all
documents share costs one row per document. Each round counts every hub's
members per shard, sums the counts of a document's hubs, and lets the document
wish for its best shard that still has room. Wishes are admitted under the
shard quotas: exchanges between two shards first, then free room. Documents
without links fill what is left, so the shards' row counts differ by one at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from arrivalgate.llm.common import Scratch, buckets_for, rank_in_groups, text_crc32


def admitted(wishes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many of the wished moves (from, to) can be made at once: swaps between
    two shards, then moves into free room. No shard ends above its quota."""
    ok = np.minimum(wishes, wishes.T)
    rest, room = wishes - ok, room.copy()
    moved = True
    while moved:
        moved = False
        for b in range(len(room)):
            for a in np.argsort(-rest[:, b]):
                n = int(min(rest[a, b], room[b]))
                if n > 0:
                    ok[a, b] += n
                    rest[a, b] -= n
                    room[b] -= n
                    room[a] += n
                    moved = True
    return ok


def quotas(rows: int, shards: int) -> np.ndarray:
    """Rows per shard: at most one apart."""
    return np.array([rows // shards + (i < rows % shards) for i in range(shards)], dtype=np.int64)


def propagate(members: DataFrame, shards: int, quota: np.ndarray, scratch: Scratch, rounds: int) -> DataFrame:
    """(nid, shard) for the linked documents of ``members`` (nid, hub), each shard within its quota."""
    nodes = scratch.save(members.groupBy("nid").agg(F.min("hub").alias("hub")), "nodes")
    total = nodes.count()
    nodes = nodes.withColumn("one", F.lit(1))
    start = rank_in_groups(nodes, ["one"], ["hub", "nid"], "r", buckets_for(total))
    # dealt in turn, largest quotas first by number: within every quota because the linked rows are at most all rows
    state = scratch.save(start.select("nid", F.pmod("r", F.lit(shards)).cast("int").alias("shard")), "state-0")
    ids = list(range(shards))
    for step in range(1, rounds + 1):
        count = {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}
        room = quota - np.array([count.get(i, 0) for i in ids])
        placed = scratch.save(members.join(state, "nid"), f"placed-{step}")
        # stored, so that the join with it meets two plain shuffles and a hot hub's members can be split
        hubs = scratch.save(placed.groupBy("hub").agg(
            *[F.count(F.when(F.col("shard") == i, 1)).alias(f"c{i}") for i in ids]), f"hubs-{step}")
        votes = placed.join(hubs, "hub").groupBy("nid").agg(
            F.first("shard").alias("shard"), F.min("hub").alias("hub"), *[F.sum(f"c{i}").alias(f"c{i}") for i in ids])
        full = F.array(*[F.lit(bool(room[i] <= 0)) for i in ids])
        # best shard: most linked documents, then one with room, then a fixed order per hub
        pref = [F.struct(F.col(f"c{i}").alias("n"), F.lit(bool(room[i] > 0)).alias("open"),
                         F.xxhash64(F.lit(i), "hub").alias("tie"), F.lit(i).alias("to")) for i in ids]
        best = F.array_max(F.filter(F.array(*pref), lambda x: ~F.get(full, x["to"]) | (x["to"] == F.col("shard"))))
        wish = scratch.save(votes.select("nid", "shard", best["to"].alias("to"),
                                         (best["n"] - F.get(F.array(*[F.col(f"c{i}") for i in ids]), F.col("shard"))).alias("gain")),
                            f"wish-{step}")
        moves = wish.where("to <> shard")
        asked = np.zeros((shards, shards), np.int64)
        for r in moves.groupBy("shard", "to").count().collect():
            asked[r["shard"], r["to"]] = r["count"]
        ok = admitted(asked, room)
        if not ok.sum():
            break
        if (ok == asked).all():
            state_new = wish.select("nid", F.col("to").alias("shard"))
        else:
            allowed = F.array(*[F.array(*[F.lit(int(x)) for x in row]) for row in ok])
            ranked = rank_in_groups(moves.withColumn("__loss", -F.col("gain")), ["shard", "to"], ["__loss", "nid"], "r",
                                    buckets_for(int(asked.max())))
            made = ranked.where(F.col("r") < F.get(F.get(allowed, F.col("shard")), F.col("to"))).select("nid", F.col("to").alias("new"))
            state_new = state.join(made, "nid", "left").select("nid", F.coalesce("new", "shard").alias("shard"))
        state = scratch.save(state_new, f"state-{step}")
        scratch.drop(f"state-{step - 1}")
        for name in ("wish", "placed", "hubs"):
            scratch.drop(f"{name}-{step}")
    return state


def shard_rows(nodes: DataFrame, members: DataFrame, shards: int, scratch: Scratch, rounds: int = 12) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in its shard) to ``nodes`` (column ``nid``, unique).

    ``members`` (nid, hub) holds the links; a hub with one member links nothing.
    """
    shared = members.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hub")
    members = scratch.save(members.join(shared, "hub", "left_semi"), "members")
    rows = nodes.count()
    quota = quotas(rows, shards)
    linked = propagate(members, shards, quota, scratch, rounds)
    count = {r["shard"]: r["count"] for r in linked.groupBy("shard").count().collect()}
    left = quota - np.array([count.get(i, 0) for i in range(shards)])
    lone = nodes.join(linked.select("nid"), "nid", "left_anti").withColumn("one", F.lit(1))
    lone = rank_in_groups(scratch.save(lone, "lone"), ["one"], ["nid"], "r", buckets_for(rows))
    ends = np.cumsum(left)
    at = F.lit(shards - 1)
    for i in reversed(range(shards)):
        at = F.when(F.col("r") < int(ends[i]), F.lit(i)).otherwise(at)
    lone = lone.select("nid", at.cast("int").alias("shard"))
    every = scratch.save(linked.select("nid", "shard").unionByName(lone), "shards")
    slots = rank_in_groups(every, ["shard"], ["nid"], "slot", buckets_for(rows // shards + 1))
    return nodes.join(slots, "nid")


def shard_documents(docs: DataFrame, shards: int = 16, rounds: int = 12, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard``, ``slot``.

    Documents of equal text are linked. Row counts of the shards differ by at
    most one (the law ``rows``), so a group larger than a shard is cut into as
    few shards as the quotas allow.

    Defined cases: a null text counts as no bytes (size 1, CRC 0) and is linked
    with the other texts without bytes; null and repeated ids are rows like all
    others; fewer rows than shards leave shards empty; an empty table gives an
    empty result. Only the id and the text are read, so further columns never clash.
    """
    scratch = Scratch(docs.sparkSession, "shard")
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"),
                       text_crc32(text).alias("text_crc32"), F.xxhash64(text).alias("__h"))
    nodes = scratch.save(slim.withColumn("nid", F.monotonically_increasing_id()), "nodes-all")
    hub = F.concat_ws(":", F.hex("__h"), "text_crc32", "size")
    members = nodes.select("nid", hub.alias("hub"))
    return shard_rows(nodes, members, shards, scratch, rounds).select(id_col, "size", "text_crc32", "shard", "slot")
