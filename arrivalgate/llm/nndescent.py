"""Near-duplicate embeddings by NN-descent.

1. Dense classes. Vectors within 9 degrees of one centre are within 18 of each
   other, so all of them link at cosine 0.95 without any pair being looked at.
   Centres are the means of crowds found in cells of random sign sketches; a
   class can hold any share of the rows.
2. NN-descent over the classes and the remaining vectors. Lists start from the
   pairs that meet in a cell of any of the sketches: cells are cut to ``CELL``
   vectors and compared as matrices, only near pairs become rows. Each round every
   node introduces its neighbours (and those it is a neighbour of) to each
   other, and every list keeps the best it has met and all that link. Rounds go
   on until few entries change and an audit finds the wanted share of the
   links; short of it, lists are doubled and further sketches are added. The
   audit compares a sample of vectors with all, and looks for planted vectors,
   each at the threshold from a vector of the table, so that it has links to
   judge by where the table has few. If the last round is still below that
   share, all nodes are compared with all in blocks.
3. Links. Pairs are confirmed on the original vectors in double precision.
   Two classes link wholly, not at all, or pair by pair, by the triangle
   inequality on their centres' angle and their radii.

A vector costs a row for each sketch, in jobs of a few sketches whose shuffle
files go when they end; its neighbours cost rows only where they are near.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import ArrayType, FloatType

from arrivalgate.llm.common import Scratch
from arrivalgate.llm.graph import components
from arrivalgate.llm.vectors import cosine, unit

TABLES, MOST_TABLES, SKETCH_BITS = 8, 64, 48
CELL = 2048          # vectors of a cell that are compared with each other
MISSED = 0.004       # share of the links at the threshold that no sketch finds
DENSE_TABLES, SAMPLE, TOP_CENTRES = 2, 128, 256
STRIP = 512          # rows of a matrix product
BLOCK = 4096         # members of a class that meet those of another in one task
TASK_ROWS, JOB_ROWS = 50_000, 2_000_000
SMALL_ROWS, SMALL_CENTRES = 1_000_000, 50_000   # keys, and keys with a vector, that are broadcast
PLAIN = {"parquet.enable.dictionary": "false"}   # vectors and signs do not repeat
AUDIT_LINKS = 500    # links that an audit must have seen, if there are so many
AUDIT_BLOCK = 4096   # nodes that are sent to the tasks at a time
PLANTED, PLANTED_FROM = 1000, -(1 << 62)
SLACK = 0.004        # half-precision vectors are off by less; pairs are confirmed in double
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PAIRS = "u long, v long, a long, b long, sim float"


@contextmanager
def _lean(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when their job ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """A stored table of keys, broadcast unless it is large."""
    return F.broadcast(df) if df.count() <= most else df


def _planes(size: int, tables: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(tables, SKETCH_BITS, size))


def _prefix(rows: int) -> int:
    """Leading signs that cut the vectors into cells of ``CELL`` on average."""
    return min(SKETCH_BITS, math.ceil(math.log2(max(1.0, rows / CELL))))


def tables_for(rows: int, floor: float) -> int:
    """So many tables that two vectors at similarity ``floor`` share a cell in one of
    them but for the share ``MISSED``, whatever the number of rows; ``TABLES`` at least.
    Beyond ``MOST_TABLES`` (low floors) the rounds and the audit have to do the rest."""
    same = 1 - math.acos(max(-1.0, min(1.0, floor))) / math.pi
    alone = 1 - same ** _prefix(rows)
    return TABLES if alone <= 0 else min(MOST_TABLES, max(TABLES, math.ceil(math.log(MISSED) / math.log(alone))))


def _matrix(col: pa.Array, size: int, kind=None) -> np.ndarray:
    """Rows of an array column, or of the bytes of arrays, as a matrix."""
    if not len(col):
        return np.zeros((0, size), kind or np.float64)
    if pa.types.is_binary(col.type):
        at = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
        kind = kind or {2: np.float16, 4: np.float32, 8: np.float64}[int(at[1] - at[0]) // size]
        return np.frombuffer(col.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind).reshape(-1, size)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _packed(x: np.ndarray) -> pa.Array:
    """The bytes of each row."""
    x = np.ascontiguousarray(x)
    at = np.arange(len(x) + 1, dtype=np.int32) * (x.itemsize * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(at), pa.py_buffer(x)])


def _joined_rows(col: pd.Series, size: int) -> np.ndarray:
    """As ``_matrix``, in double precision, of a pandas column of bytes."""
    x = np.empty((len(col), size))
    for kind in (np.float32, np.float64):
        at = (col.map(len) == size * np.dtype(kind).itemsize).to_numpy(bool)
        x[at] = np.frombuffer(b"".join(col[at]), kind).reshape(-1, size)
    return x


def sketched(nodes: DataFrame, size: int, tables: int = TABLES, seed: int = 5) -> DataFrame:
    """(nid, own, wide, h, codes): each vector (nid, v, wide) in half precision, and its
    48 signs in every table, the most significant first. ``own``: the vector's class,
    or itself if the nodes have none."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _planes(size, tables, seed).reshape(-1, size).T.astype(np.float32)
        for b in batches:
            if len(b):
                x = unit(_matrix(b.column("v"), size).astype(np.float64)).astype(np.float32)
                signs = np.packbits(((x @ planes) > 0).reshape(len(x) * tables, SKETCH_BITS), axis=1)
                code = np.zeros((len(signs), 8), np.uint8)
                code[:, 2:] = signs
                code = pa.array(code.view(">i8").ravel().astype(np.int64))
                at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * tables)
                yield pa.RecordBatch.from_arrays(
                    [b.column("nid"), b.column("own"), b.column("wide"), _packed(x.astype(np.float16)), pa.ListArray.from_arrays(at, code)],
                    names=["nid", "own", "wide", "h", "codes"])

    own = F.col("own") if "own" in nodes.columns else F.col("nid")
    return nodes.select("nid", own.alias("own"), "wide", "v").mapInArrow(sketch, "nid long, own long, wide double, h binary, codes array<long>")


def _split(code: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Sorted codes that share ``depth`` signs, cut by the next signs into ranges of at
    most ``CELL`` (equal codes: anywhere)."""
    todo, out = [(0, len(code), depth)], []
    while todo:
        lo, hi, d = todo.pop()
        if hi - lo <= CELL:
            out.append((lo, hi))
        elif d >= SKETCH_BITS:
            out += [(s, min(s + CELL, hi)) for s in range(lo, hi, CELL)]
        else:
            place = SKETCH_BITS - 1 - d
            cut = lo + int(np.searchsorted(code[lo:hi], ((code[lo] >> (place + 1)) << (place + 1)) | (1 << place)))
            todo += [(s, e, d + 1) for s, e in ((lo, cut), (cut, hi)) if e > s]
    return out


def _meet(codes: DataFrame, tables: list[int], rows: int, size: int, work: Callable, schema: str) -> DataFrame:
    """``work(t, code, nid, own, x, depth)`` on the vectors of each cell, sorted by code."""
    depth = _prefix(rows)
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    each = F.array(*[F.struct(F.lit(t).alias("t"), F.get("codes", F.lit(t)).alias("code")) for t in tables])
    flat = codes.select("nid", "own", "h", F.inline(each))
    least = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-rows * len(tables) // TASK_ROWS))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        t, code, nid, own = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in got]) for c in ("t", "code", "nid", "own"))
        h = np.concatenate([_matrix(b.column("h"), size, np.float16) for b in got])
        order = np.lexsort((nid, code, t))
        t, code, nid, own = t[order], code[order], nid[order], own[order]
        cell = code >> (SKETCH_BITS - depth)
        cut = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (cell[1:] != cell[:-1]), [True]]))
        for s, e in zip(cut[:-1], cut[1:]):
            if e - s > 1:
                x = h[order[s:e]].astype(np.float32)
                for columns in work(int(t[s]), code[s:e], nid[s:e], own[s:e], x, depth):
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    return flat.repartition(parts, "t", F.shiftright("code", SKETCH_BITS - depth)).mapInArrow(meet, schema)


def _crowds(size: int, radius: float, least: int) -> Callable:
    """Work of a cell: (nid, m, cid, c), the members of its crowds. ``c``, the centre, stands in one row of each."""
    bound = math.cos(radius)

    def centred(x: np.ndarray, near: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(2):
            centre = x[near].mean(axis=0)
            centre /= max(float(np.linalg.norm(centre)), 1e-9)
            near = (x @ centre >= bound) & open_
            if not near.any():
                break
        return centre, near

    def crowds(x: np.ndarray, code: np.ndarray, depth: int, rng) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        rest = np.arange(len(x))
        while len(rest) > CELL:            # what a sample shows to be crowded is taken out first
            y = x[rest]
            some = rng.choice(len(rest), SAMPLE, replace=False)
            near = y[some] @ y.T >= bound
            m = near.sum(axis=1)
            if m.max() < max(least, len(rest) // 16):
                break
            centre, inside = centred(y, near[m.argmax()], np.ones(len(y), bool))
            if inside.sum() < least:
                break
            yield rest[inside], centre
            rest = rest[~inside]
        for s, e in _split(code[rest], depth):
            at = rest[s:e]
            if len(at) < least:
                continue
            y = x[at]
            near = y @ y.T >= bound
            m = near.sum(axis=1)
            left = np.ones(len(at), bool)
            while m.max() >= least:
                first = int(m.argmax())
                centre, inside = centred(y, near[first] & left, left)
                if inside.sum() < least:
                    centre, inside = y[first], near[first] & left
                yield at[inside], centre
                left &= ~inside
                m = m - near[:, inside].sum(axis=1)
                m[~left] = 0

    def work(t, code, nid, own, x, depth):
        for at, centre in crowds(x, code, depth, np.random.default_rng(7)):
            ids = nid[at]
            c = [None] * len(ids)
            c[0] = centre.astype(np.float32).tobytes()
            yield ids, np.full(len(ids), len(ids), np.int64), np.full(len(ids), ids[0] * DENSE_TABLES + t), pa.array(c, pa.binary())

    return work


def dense_classes(nodes: DataFrame, codes: DataFrame, size: int, rows: int, radius: float, least: int,
                  scratch: Scratch) -> tuple[DataFrame, DataFrame] | None:
    """(nid, cid, copies) of the members, each in one class, and the classes (cid, c,
    r, copies): all members are within ``r``, at most ``radius`` (radians), of the
    centre ``c``. None if there is no class. Of its crowds a member takes the
    largest, and before it the first of the largest crowds of all that reach it."""
    found = scratch.save(_meet(codes, list(range(DENSE_TABLES)), rows, size, _crowds(size, radius, least),
                               "nid long, m long, cid long, c binary"), "crowds")
    centres = scratch.save(found.where("c is not null").select("cid", "m", "c"), "centres")
    top = centres.orderBy(F.desc("m"), "cid").limit(TOP_CENTRES).collect()
    if not top:
        return None
    top_ids = np.array([r["cid"] for r in top])
    top_c = unit(np.array([np.frombuffer(r["c"], np.float32) for r in top], np.float64))
    pick = scratch.save(found.groupBy("nid").agg(F.max(F.struct("m", "cid")).alias("k")).select("nid", "k.cid"), "pick")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                x = unit(_matrix(b.column("raw"), size).astype(np.float64))
                c = unit(_matrix(b.column("c"), size, np.float32).astype(np.float64))
                cid, cos = b.column("cid").to_numpy().copy(), (x * c).sum(axis=1)
                every = x @ top_c.T
                first = (every >= math.cos(radius)).argmax(axis=1)
                best = every[np.arange(len(x)), first]
                cid, cos = np.where(best >= math.cos(radius), top_ids[first], cid), np.where(best >= math.cos(radius), best, cos)
                in_ = cos >= math.cos(radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[in_]) for x in (b.column("nid").to_numpy(), b.column("copies").to_numpy(), cid, np.arccos(np.minimum(cos, 1.0)))],
                    names=["nid", "copies", "cid", "angle"])

    seen = nodes.join(_small(pick), "nid").join(_small(centres.select("cid", "c"), SMALL_CENTRES), "cid").select("nid", "copies", "cid", "raw", "c")
    member = scratch.save(seen.mapInArrow(exact, "nid long, copies long, cid long, angle double"), "member")
    classes = member.groupBy("cid").agg(F.min("nid").alias("m"), F.sum("copies").alias("copies"), F.max("angle").alias("r"), F.count(F.lit(1)).alias("got"))
    classes = scratch.save(classes.where("got > 1").join(centres.select("cid", "c"), "cid")
                           .select("cid", (-F.col("m") - 1).alias("cls"), "c", (F.col("r") + 1e-7).alias("r"), "copies"), "classes")
    inside = scratch.save(member.join(_small(classes.select("cid", "cls")), "cid").select("nid", F.col("cls").alias("cid"), "copies"), "inside")
    return inside, classes.select(F.col("cls").alias("cid"), "c", "r", "copies")


def _best(u, v, a, b, sim, k: int, link: float) -> np.ndarray:
    """Which of the pairs stay: all that link, and those among the ``k`` best of either end."""
    keep = sim >= link
    if not keep.all():
        ends, twice, place = np.concatenate([u, v]), np.concatenate([sim, sim]), np.arange(len(u))
        order = np.lexsort((-twice, ends))
        e = ends[order]
        start = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
        rank = np.arange(len(e)) - np.repeat(start, np.diff(np.append(start, len(e))))
        keep[np.concatenate([place, place])[order][rank < k]] = True
    return keep


def _merged(u, v, a, b, sim) -> tuple:
    """One pair (u < v) of two owners, the one most alike; ``a``, ``b``: its vectors."""
    turn = u > v
    u, v, a, b = np.where(turn, v, u), np.where(turn, u, v), np.where(turn, b, a), np.where(turn, a, b)
    order = np.lexsort((b, a, -sim, v, u))
    u, v, a, b, sim = u[order], v[order], a[order], b[order], sim[order]
    one = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])[:len(u)]
    return u[one], v[one], a[one], b[one], sim[one]


def _near_pairs(k: int, near: float, link: float) -> Callable:
    """Work of a cell: the pairs of different owners that are near."""

    def work(t, code, nid, own, x, depth):
        for s, e in _split(code, depth):
            y, n, o = x[s:e], nid[s:e], own[s:e]
            got = []
            for at in range(0, len(y), STRIP):
                sim = y[at:at + STRIP] @ y[at:].T
                hit = np.flatnonzero(sim >= near)
                i, j = np.divmod(hit, sim.shape[1])
                take = (j > i) & (o[at + i] != o[at + j])
                if take.any():
                    got.append((at + i[take], at + j[take], sim.ravel()[hit[take]]))
            if got:
                i, j, sim = (np.concatenate(c) for c in zip(*got))
                pairs = _merged(o[i], o[j], n[i], n[j], sim)
                keep = _best(*pairs, k, link)
                yield tuple(c[keep] for c in pairs)

    return work


def _local_join(size: int, k: int, near: float, link: float) -> Callable:
    """Introduces the members of each pivot's list to each other."""

    def introduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        p, o, w, new = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in got]) for c in ("p", "o", "w", "fresh"))
        h = np.concatenate([_matrix(b.column("h"), size, np.float16) for b in got])
        order = np.lexsort((o, p))
        p, o, w, new, h = p[order], o[order], w[order], new[order], h[order]
        cut = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1], [True]]))
        out, held = [], 0
        for s, e in zip(cut[:-1], cut[1:]):
            if e - s < 2 or not new[s:e].any():
                continue
            x = h[s:e].astype(np.float32)
            sim = x @ x.T
            i, j = np.nonzero((sim >= near) & (new[s:e, None] | new[None, s:e]))
            i, j = i[i < j], j[i < j]
            if len(i):
                pairs = (o[s + i], o[s + j], w[s + i], w[s + j], sim[i, j])
                keep = _best(*pairs, k, link)
                out.append(tuple(c[keep] for c in pairs))
                held += int(keep.sum())
            if held > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _merged(*(np.concatenate(c) for c in zip(*out)))], names=["u", "v", "a", "b", "sim"])
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _merged(*(np.concatenate(c) for c in zip(*out)))], names=["u", "v", "a", "b", "sim"])

    return introduce


def _ends(edges: DataFrame) -> DataFrame:
    """Each pair from both of its ends: ``p`` with its neighbour ``o``, whose vector is ``w``."""
    pair = [F.col(c) for c in ("u", "v", "a", "b", "sim", "fresh")]
    one = edges.select(F.col("u").alias("p"), F.col("v").alias("o"), F.col("b").alias("w"), *pair)
    two = edges.select(F.col("v").alias("p"), F.col("u").alias("o"), F.col("a").alias("w"), *pair)
    return one.union(two).withColumn("r", F.row_number().over(W.partitionBy("p").orderBy(F.desc("sim"), "o")))


def _trimmed(pairs: DataFrame, k: int, link: float) -> DataFrame:
    """One row of two owners, if it links or is among the ``k`` best of either."""
    best = pairs.groupBy("u", "v").agg(F.max(F.struct("sim", "a", "b")).alias("k"), F.min("fresh").alias("fresh"))
    best = best.select("u", "v", "k.a", "k.b", "k.sim", "fresh")
    return _ends(best).where((F.col("r") <= k) | (F.col("sim") >= link)).select(*best.columns).distinct()


def _start(codes: DataFrame, tables: int, size: int, rows: int, k: int, near: float, link: float, scratch: Scratch, name: str) -> DataFrame:
    """The near pairs of the vectors that share a cell, a few tables a job."""
    out, fresh = None, F.lit(True).alias("fresh")
    tables = tables if _prefix(rows) else 1      # one cell holds all
    step = max(3, JOB_ROWS // max(rows, 1))
    for at in range(0, tables, step):
        met = _meet(codes, list(range(at, min(at + step, tables))), rows, size, _near_pairs(k, near, link), PAIRS)
        met = scratch.save(met.select("*", fresh), f"{name}-{at}")
        out = met if out is None else out.union(met)
    return out


def descend(nodes: DataFrame, codes: DataFrame, size: int, rows: int, floor: float, scratch: Scratch, k: int = 8,
            rounds: int = 10, recall: float = 0.99, audit_nodes: int = 1000) -> DataFrame:
    """(u, v, sim), u < v: the owners of ``codes`` (of ``sketched``, for the same ``nodes``)
    that have vectors at ``floor`` or nearly.

    A list holds all that link and the ``k`` best of those within one and a half
    times the angle. The lists hold at least the share ``recall`` of the audited
    links: where ``rounds`` do not reach it, the pairs that may link are added from
    a comparison of all nodes in blocks.
    """
    link = floor - SLACK
    near = min(link, math.cos(min(math.pi, 1.5 * math.acos(max(-1.0, min(1.0, floor))))))
    tables = len(codes.select("codes").first()["codes"])
    probes = _planted(nodes, codes, size, rows, floor, scratch)
    codes = codes.unionByName(sketched(probes.select("nid", "v", F.lit(link).alias("wide")), size, tables)) if probes is not None else codes
    slim = codes.select("nid", "own", "wide", "h")
    edges = scratch.save(_trimmed(_start(codes, tables, size, rows, k, near, link, scratch, "start"), k, link), "edges-0")
    truth = None
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    real = (F.col("u") > PLANTED_FROM) & (F.col("v") > PLANTED_FROM)
    n = edges.count()
    for step in range(1, rounds + 1):
        fresh = 0
        if n:
            # the list of a pivot: the best of its neighbours and of those that have it as one
            lists = scratch.save(_ends(edges).where(F.col("r") <= 3 * k).select("p", "o", "w", "fresh"), f"lists-{step}")
            asked = scratch.save(lists.select(F.col("w").alias("nid")).distinct(), f"asked-{step}")
            known = scratch.save(slim.join(_small(asked), "nid", "left_semi").select(F.col("nid").alias("w"), "h"), f"known-{step}")
            met = lists.join(known, "w").select("p", "o", "w", "fresh", "h").repartition(max(parts, -(-6 * n // TASK_ROWS)), "p") \
                .mapInArrow(_local_join(size, 3, near, link), PAIRS)
            pairs = met.withColumn("fresh", F.lit(True)).union(edges.withColumn("fresh", F.lit(False)).select("u", "v", "a", "b", "sim", "fresh"))
            edges = scratch.save(_trimmed(pairs, k, link), f"edges-{step}")
            for name in ("edges", "lists", "asked", "known"):
                scratch.drop(f"{name}-{step - (name == 'edges')}")
            count = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("fresh").cast("int")).alias("f")).first()
            n, fresh = count["n"], count["f"] or 0
        settled = fresh <= 0.05 * max(1, n)
        if settled or step >= 4:
            if truth is None:
                truth = _audit(slim.where(F.col("nid") > PLANTED_FROM), size, rows, audit_nodes, scratch, probes is None)
                truth = truth.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
                truth = scratch.save(truth if probes is None else truth.union(probes.select("nid", "own")), "truth")
            got = truth.join(edges.select("u", "v", F.lit(1).alias("found")), ["u", "v"], "left").agg(
                F.count(F.lit(1)).alias("n"), F.count("found").alias("found")).first()
            enough = got["found"] >= recall * got["n"]
            if enough and (settled or step == rounds):
                return edges.where(real).select("u", "v", "sim")
            if not enough and step < rounds:
                k = 2 * k
                more = scratch.save(sketched(slim.withColumnRenamed("h", "v"), size, tables, 5 + step), f"codes-{step}", PLAIN)
                pairs = _start(more, tables, size, rows, k, near, link, scratch, f"more-{step}").union(edges)
                edges = scratch.save(_trimmed(pairs, k, link), f"edges-{step}-more")
                n = edges.count()
                scratch.drop(f"codes-{step}")
    every = _compared(slim.where(F.col("nid") > PLANTED_FROM), size, rows, 0, max(1, -(-rows // AUDIT_BLOCK)), 0.0, scratch, "every")
    every = every.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    return edges.where(real).select("u", "v", "sim").union(every.select("u", "v", F.lit(floor).cast("float"))).groupBy("u", "v").agg(F.max("sim").alias("sim"))


def _planted(nodes: DataFrame, codes: DataFrame, size: int, rows: int, floor: float, scratch: Scratch) -> DataFrame | None:
    """(nid, v, own): about ``PLANTED`` vectors, each in a random direction from a vector
    of the table and just within ``floor`` of it; ``own``: that vector's owner. None
    where one cell holds all vectors, as then all are compared, or where they have no direction."""
    if not _prefix(rows) or size < 2:
        return None
    some = F.pmod(F.xxhash64("nid", F.lit(2)), F.lit(max(1, rows // PLANTED))) == 0
    got = scratch.save(codes.where(some).select("nid", "own", "h"), "planted-by").toPandas().sort_values("nid")
    if not len(got):
        return None
    x = unit(np.frombuffer(b"".join(got["h"]), np.float16).reshape(-1, size).astype(np.float64))
    away = np.random.default_rng(11).normal(size=x.shape)
    away = unit(away - (away * x).sum(axis=1, keepdims=True) * x)
    cos = min(1.0, floor + SLACK / 4)
    v = cos * x + math.sqrt(1 - cos * cos) * away
    rows_ = [(PLANTED_FROM - 1 - i, r.tolist(), int(o)) for i, (r, o) in enumerate(zip(v, got["own"]))]
    return scratch.save(nodes.sparkSession.createDataFrame(rows_, "nid long, v array<double>, own long"), "planted")


def _audit(slim: DataFrame, size: int, rows: int, audit_nodes: int, scratch: Scratch, enlarged: bool = True) -> DataFrame:
    """(u, v): every pair of an audited node that may link, by comparing them with
    all nodes. Nodes are audited in groups of about ``audit_nodes``, each time as
    many more as before if the audit may be ``enlarged``, until ``AUDIT_LINKS`` pairs
    are found or all nodes are audited."""
    parts = max(1, -(-rows // audit_nodes))
    truth = _compared(slim, size, rows, 0, 1, SLACK, scratch, "truth-1", parts)
    done = 1
    while enlarged and done < parts and truth.count() < AUDIT_LINKS:
        more = min(parts, 2 * done)
        truth = truth.union(_compared(slim, size, rows, done, more, SLACK, scratch, f"truth-{more}", parts))
        done = more
    return truth


def _compared(slim: DataFrame, size: int, rows: int, first: int, last: int, slack: float, scratch: Scratch, name: str,
              parts: int | None = None) -> DataFrame:
    """(u, v): owners of pairs that may link, ``slack`` above their bound, of the nodes of the groups
    ``first`` to ``last - 1`` (of ``parts``, by hash) with all nodes, ``AUDIT_BLOCK`` at a time."""
    parts = parts or last
    slim = slim if "own" in slim.columns else slim.withColumn("own", F.col("nid"))
    group = F.pmod(F.xxhash64("nid", F.lit(1)), F.lit(parts))
    step = max(1, AUDIT_BLOCK * parts // max(rows, 1))
    out = None
    for at in range(first, last, step):
        queries = slim.where((group >= at) & (group < min(at + step, last))).toPandas()
        if len(queries):
            met = scratch.save(_scan(slim, queries, size, slack), f"{name}-{at}")
            out = met if out is None else out.union(met)
    return out if out is not None else slim.sparkSession.createDataFrame([], "u long, v long")


def _scan(slim: DataFrame, queries: pd.DataFrame, size: int, slack: float) -> DataFrame:
    qx = np.frombuffer(b"".join(queries["h"]), np.float16).reshape(-1, size).astype(np.float32)
    sent = slim.sparkSession.sparkContext.broadcast((queries["own"].to_numpy(), qx, queries["wide"].to_numpy()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qown, q, wide = sent.value
        for b in batches:
            if len(b):
                x = _matrix(b.column("h"), size, np.float16).astype(np.float32)
                own, bound = b.column("own").to_numpy(), b.column("wide").to_numpy()
                least = min(wide.min(), bound.min()) + slack
                got = []
                for s in range(0, len(q), STRIP):
                    sim = q[s:s + STRIP] @ x.T
                    hit = np.flatnonzero(sim >= least)
                    i, j = np.divmod(hit, len(x))
                    take = (qown[s + i] != own[j]) & (sim.ravel()[hit] >= np.minimum(wide[s + i], bound[j]) + slack)
                    got.append(np.stack([qown[s + i[take]], own[j[take]]], axis=1))
                u, v = np.unique(np.concatenate(got), axis=0).T
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return slim.select("own", "wide", "h").mapInArrow(scan, "u long, v long")


def _parsed(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, size, raw): the vector's bytes where it is usable (not null, not zero, no null
    or non-finite component), in single precision if the column has it, else in double."""
    kind = embeddings.schema[vec_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    v = F.col(vec_col) if single else F.col(vec_col).cast("array<double>")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                n = pc.fill_null(pc.list_value_length(b.column("v")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float32 if single else np.float64)
                at = np.concatenate([[0], np.cumsum(n)])
                raw, size = np.full(len(n), None, dtype=object), np.zeros(len(n), np.int32)
                for s in np.unique(n[n > 0]):
                    rows = np.flatnonzero(n == s)
                    x = flat[at[rows][:, None] + np.arange(s)]
                    good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
                    raw[rows[good]] = [r.tobytes() for r in x[good]]
                    size[rows[good]] = s
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(size), pa.array(raw, pa.binary())], names=["id", "size", "raw"])

    return embeddings.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).mapInArrow(parse, "id long, size int, raw binary")


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
                    dense: int = 24, k: int = 8, recall: float = 0.99) -> DataFrame:
    """One row per vector: id, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable) and ``kept`` (its own id is that).

    Vectors link whose cosine is ``threshold`` or more. Defined cases: vectors
    that are null, zero or hold a null or non-finite component link with nothing;
    vectors link with those of their own length, every length by itself; equal vectors link; repeated ids are rows of their own; a null id is no
    component id unless its whole component has none; an empty table gives an
    empty result. Only the id and the vector are read.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "nndescent")
    with _lean(spark):
        key = [F.when(F.col("raw").isNotNull(), F.xxhash64(*c, "raw")) for c in ([], [F.lit(7)])]
        rows = _parsed(embeddings, id_col, vec_col).select("id", "size", "raw", key[0].alias("k1"), key[1].alias("k2"))
        rows = scratch.save(rows.withColumn("nid", F.monotonically_increasing_id()), "read", PLAIN)
        # equal vectors are one vector with copies
        twice = rows.where("size > 0").groupBy("k1", "k2").agg(F.min("nid").alias("first"), F.count(F.lit(1)).alias("copies"))
        twice = scratch.save(twice.where("copies > 1"), "twice")
        if twice.isEmpty():
            rows = rows.select("id", "size", "raw", "nid", F.col("nid").alias("first"), F.lit(1).cast("long").alias("copies"))
        else:
            rows = rows.join(_small(twice), ["k1", "k2"], "left")
            rows = scratch.save(rows.select("id", "size", "raw", "nid", F.coalesce("first", "nid").alias("first"), F.coalesce("copies", F.lit(1)).alias("copies")), "rows", PLAIN)
            scratch.drop("read")
        got = None
        for r in sorted(rows.where("size > 0").groupBy("size").count().where("count > 1").collect()):
            part = _linked(rows.where((F.col("size") == r["size"]) & (F.col("nid") == F.col("first"))).select("nid", "raw", "copies"),
                           r["size"], threshold, dense, k, recall)
            got = part if got is None else got.unionByName(part)
        if got is None:
            return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                               F.col("id").isNotNull().alias("kept"))
        got = scratch.save(got, "linked")
        least = rows.select("id", F.col("first")).join(_small(got.select("nid", "root")), F.col("first") == F.col("nid"))
        least = scratch.save(least.groupBy("root").agg(F.min("id").alias("component_id")), "least")
        named = scratch.save(got.join(_small(least), "root").select(F.col("nid").alias("first"), "n_links", "component_id"), "named")
        out = rows.select("id", "first").join(_small(named), "first", "left")
    comp = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(False)).alias("kept"))


def _linked(nodes: DataFrame, size: int, threshold: float, dense: int, k: int, recall: float) -> DataFrame:
    """(nid, root, n_links) of the different vectors (nid, raw, copies) of one length that link
    or have copies."""
    scratch = Scratch(nodes.sparkSession, "nndescent")
    limit = math.acos(threshold)
    n = nodes.count()
    start = nodes.select("nid", F.col("raw").alias("v"), F.lit(threshold - SLACK).alias("wide"))
    codes = scratch.save(sketched(start, size, tables_for(n, threshold)), "codes", PLAIN)
    found = dense_classes(nodes, codes, size, n, 0.495 * limit, dense, scratch)
    inside = found and found[0]
    if found:
        owned = codes.drop("own").join(_small(inside.select("nid", "cid")), "nid", "left") \
            .select("nid", F.coalesce("cid", "nid").alias("own"), "wide", "h", "codes")
        codes = scratch.save(owned, "owned", PLAIN)
        scratch.drop("codes")
    edges = descend(start, codes, size, n, threshold, scratch, k, recall=recall)

    # confirm on the vectors themselves; of a class: its centre and radius
    one = scratch.save(edges.where(F.col("sim") >= threshold - SLACK).select(F.col("u").alias("a"), F.col("v").alias("b")), "pairs")
    asked = scratch.save(one.select(F.col("a").alias("nid")).union(one.select("b")).distinct(), "asked")
    side = nodes.join(_small(asked), "nid", "left_semi").select(F.col("nid").alias("cid"), F.col("raw").alias("v"), F.lit(0.0).alias("r"), "copies")
    if found:
        side = side.union(found[1].join(_small(asked.withColumnRenamed("nid", "cid")), "cid", "left_semi").select("cid", F.col("c"), "r", "copies"))
    side = scratch.save(side, "side")
    met = one.join(side.select(F.col("cid").alias("a"), F.col("v").alias("va"), F.col("r").alias("ra"), F.col("copies").alias("na")), "a") \
        .join(side.select(F.col("cid").alias("b"), F.col("v").alias("vb"), F.col("r").alias("rb"), F.col("copies").alias("nb")), "b")

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(cosine(_joined_rows(a, size), _joined_rows(b, size))) if len(a) else pd.Series([], dtype=float)

    met = met.withColumn("cos", exact("va", "vb")).withColumn("angle", F.acos(F.greatest(F.least("cos", F.lit(1.0)), F.lit(-1.0))))
    met = scratch.save(met.where(F.col("angle") - F.col("ra") - F.col("rb") <= limit + 1e-6).drop("va", "vb"), "confirmed")
    both_lone = (F.col("ra") == 0) & (F.col("rb") == 0)
    whole = met.where(F.when(both_lone, F.col("cos") >= threshold).otherwise(F.col("angle") + F.col("ra") + F.col("rb") <= limit - 1e-6))
    whole = whole.select("a", "b", "na", "nb")
    total = whole.select(F.col("a").alias("cid"), F.col("nb").alias("n")).union(whole.select("b", "na")) \
        .groupBy("cid").agg(F.sum("n").alias("n_whole"))
    links = whole.select("a", "b")
    member = nodes.where("copies > 1").select("nid", "copies", F.col("nid").alias("cid"), F.col("copies").alias("inside"))
    part = None
    if found:
        partly = scratch.save(met.where(~both_lone & (F.col("angle") + F.col("ra") + F.col("rb") > limit - 1e-6)).select("a", "b"), "partly")
        ends = partly.select(F.col("a").alias("cid")).union(partly.select("b")).distinct()
        owner = nodes.join(_small(inside.select("nid", "cid")), "nid", "left").select("nid", F.coalesce("cid", "nid").alias("cid"), "raw", "copies")
        owner = scratch.save(owner.join(_small(scratch.save(ends, "ends")), "cid", "left_semi"), "owner")
        between = scratch.save(_between(partly, owner, size, threshold).where("n > 0"), "between")
        part = between.groupBy("nid").agg(F.sum("n").alias("n_part"))
        links = links.union(between.select("a", "b").distinct())
        of = inside.join(_small(found[1].select("cid", F.col("copies").alias("inside"))), "cid").select("nid", "copies", "cid", "inside")
        member = member.join(_small(inside.select("nid")), "nid", "left_anti").union(of)
    links = scratch.save(links, "links")
    roots = components(links, scratch, "roots")
    # a lone vector that links and has no copies
    lone = links.select(F.col("a").alias("nid")).union(links.select("b")).distinct().where("nid >= 0")
    member = scratch.save(member, "touched")
    lone = lone.join(member.select("nid"), "nid", "left_anti").select("nid", F.lit(1).cast("long"), F.col("nid").alias("cid"), F.lit(1).cast("long"))
    own = member.union(lone).join(total, "cid", "left").join(roots.select(F.col("id").alias("cid"), "root"), "cid", "left")
    own = own.join(part, "nid", "left") if part is not None else own.withColumn("n_part", F.lit(0))
    return scratch.save(own.select("nid", F.coalesce("root", "cid").alias("root"),
                                   (F.col("inside") - 1 + F.coalesce("n_whole", F.lit(0)) + F.coalesce("n_part", F.lit(0))).alias("n_links")), "own")


def _between(partly: DataFrame, owner: DataFrame, size: int, threshold: float) -> DataFrame:
    """(nid, n, a, b): links of each member of one class with the members of
    another, for class pairs that link partly. Classes meet block by block, and
    only counts leave a block."""
    blocks = owner.groupBy("cid").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    held = owner.join(blocks, "cid").withColumn("block", F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int"))
    a = partly.join(blocks.select(F.col("cid").alias("b"), F.col("blocks").alias("other")), "b") \
        .join(held.withColumnRenamed("cid", "a"), "a").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("other") - 1)))
    b = partly.join(blocks.select(F.col("cid").alias("a"), F.col("blocks").alias("other")), "a") \
        .join(held.withColumnRenamed("cid", "b"), "b").withColumn("x", F.explode(F.sequence(F.lit(0), F.col("other") - 1)))
    rows = a.select("a", "b", F.col("block").alias("x"), "y", F.lit(0).alias("side"), "nid", "raw", "copies") \
        .union(b.select("a", "b", "x", F.col("block").alias("y"), F.lit(1), "nid", "raw", "copies"))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        x, y = _joined_rows(left["raw"], size), _joined_rows(right["raw"], size)
        ux, uy = unit(x) if len(x) else x, unit(y) if len(y) else y
        nx, ny = left["copies"].to_numpy(), right["copies"].to_numpy()
        here, there = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        for s in range(0, len(x), STRIP):
            sim = ux[s:s + STRIP] @ uy.T
            link = sim >= threshold
            i, j = np.nonzero(np.abs(sim - threshold) < 1e-9)      # as the cosine row by row decides
            if len(i):
                link[i, j] = cosine(x[s + i], y[j]) >= threshold
            here[s:s + STRIP] = link @ ny
            there += nx[s:s + STRIP] @ link
        return pd.DataFrame({"nid": np.concatenate([left["nid"], right["nid"]]).astype(np.int64), "n": np.concatenate([here, there]),
                             "a": pdf["a"].iloc[0], "b": pdf["b"].iloc[0]})

    return rows.groupBy("a", "b", "x", "y").applyInPandas(count, "nid long, n long, a long, b long")
