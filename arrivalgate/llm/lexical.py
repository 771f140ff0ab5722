"""Ranked lexical search by Block-Max MaxScore over document shards.

Every task cuts its documents into shards and writes one row per shard: for
each term of the queries a posting list in blocks of ``BLOCK`` documents, as
narrow deltas and counts, with the greatest impact of each block beside it. An
impact is a posting's score before the term's weight, so it needs the corpus'
length statistics only, and these come first. The lists' lengths and greatest
impacts are then added up over all shards, which gives every term its weight
and its global bound.

A query's terms are ordered by their global bound. In each shard the lists are
essential as long as the bounds of the rest reach the score of the worst of the
best documents so far (the threshold): only these lists find candidates. The
other lists are asked for the candidates only, and a candidate whose score, plus
the maximum of its block and the bounds of the lists after it, stays below the
threshold is rejected before that block is unpacked. The best documents of a
query pass from shard to shard of a task, so the threshold rises; the tasks'
heaps are merged at the end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from arrivalgate.llm.common import Scratch

BLOCK = 128
SHARD_DOCS, SHARD_POSTINGS = 16_384, 1_500_000
QUERY_ROWS, QUERY_BYTES = 20_000, 16 << 20
_SPLIT = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
INDEX = ("ids binary, no_id binary, m binary, terms array<int>, counts array<long>, maxima array<long>, blocks array<int>, "
         "doc_width array<int>, tf_width array<int>, last binary, top binary, doc_data binary, tf_data binary")


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text: maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPLIT).split()


def length_norm(n: int, docs: int, total: int) -> int:
    """``m`` of a document of ``n`` terms, in a corpus of ``docs`` documents and ``total`` terms."""
    return 100 - 75 + (75 * n * docs) // total


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Score of a term's ``tf`` occurrences in a document, before the term's weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(docs: int, df: int) -> int:
    """A term's weight."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint8 if x.max() < 1 << 8 else np.uint16 if x.max() < 1 << 16 else np.uint32)


def _shard(ids: list, m: list[int], term: list[int], tf: list[int], held: list[int]) -> pd.DataFrame:
    """One index row; ``held``: how many postings each document has."""
    norm = np.array(m, np.int64)
    term, tf = np.array(term, np.int64), np.array(tf, np.int64)
    doc = np.repeat(np.arange(len(m)), held)
    order = np.argsort(term, kind="stable")
    term, tf, doc = term[order], tf[order], doc[order]
    f = impact(tf, norm[doc])
    starts = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
    row = {c: [] for c in ("terms", "counts", "maxima", "blocks", "doc_width", "tf_width", "last", "top", "doc_data", "tf_data")}
    for a, b in zip(starts, np.append(starts[1:], len(term))):
        heads = np.arange(a, b, BLOCK)
        gap = np.diff(doc[a:b], prepend=0)
        gap[::BLOCK] = 0            # a block's first document is kept whole, as its base in ``last``
        d, t = gap, tf[a:b]
        if b - a > BLOCK:           # whole blocks, so that any of them can be unpacked alone
            fill = -(b - a) % BLOCK
            d, t = np.append(d, np.zeros(fill, np.int64)), np.append(t, np.zeros(fill, np.int64))
        d, t = _narrow(d), _narrow(t)
        row["terms"].append(int(term[a]))
        row["counts"].append(int(b - a))
        row["maxima"].append(int(f[a:b].max()))
        row["blocks"].append(len(heads))
        row["doc_width"].append(d.itemsize)
        row["tf_width"].append(t.itemsize)
        row["last"].append(np.stack([doc[heads], doc[np.append(heads[1:], b) - 1]], axis=1).astype(np.int32).tobytes())
        row["top"].append(np.maximum.reduceat(f[a:b], heads - a).tobytes())
        row["doc_data"].append(d.tobytes())
        row["tf_data"].append(t.tobytes())
    null = np.array([i is None for i in ids])
    row |= {c: b"".join(row[c]) for c in ("last", "top", "doc_data", "tf_data")}
    row |= {"ids": np.array([0 if i is None else i for i in ids], np.int64).tobytes(), "no_id": null.tobytes(), "m": norm.tobytes()}
    return pd.DataFrame({k: [v] for k, v in row.items()})


class _List:
    """One posting list of a shard, unpacked whole or by blocks."""

    def __init__(self, count, first, last, top, doc, tf, m):
        self.count, self.first, self.last, self.top, self.doc, self.tf, self.m = count, first, last, top, doc, tf, m
        self.whole: tuple[np.ndarray, np.ndarray] | None = None

    def unpack(self) -> tuple[np.ndarray, np.ndarray]:
        """All documents and their impacts."""
        if self.whole is None:
            docs = self._docs(np.arange(len(self.first)), self.doc)[:self.count]
            self.whole = docs, impact(self.tf[:self.count].astype(np.int64), self.m[docs])
        return self.whole

    def _docs(self, blocks: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        if len(self.first) == 1:
            return self.first[0] + np.cumsum(gaps, dtype=np.int64)
        return (self.first[blocks][:, None] + np.cumsum(gaps.reshape(-1, BLOCK), axis=1, dtype=np.int64)).ravel()

    def block_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block in which each document would be, and that block's maximum (0 where there is none)."""
        b = np.searchsorted(self.last, docs)
        inside = b < len(self.last)
        b[~inside] = 0
        inside &= self.first[b] <= docs
        return b, np.where(inside, self.top[b], 0)

    def impacts(self, docs: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Impacts of some documents; only their blocks are unpacked."""
        need = np.unique(b)
        if self.whole is not None or 2 * len(need) > len(self.first):
            at, f = self.unpack()
        else:
            pick = (need[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            held = int((pick < self.count).sum())       # the last block may be filled up
            at = self._docs(need, self.doc[pick])[:held]
            f = impact(self.tf[pick[:held]].astype(np.int64), self.m[at])
        i = np.minimum(np.searchsorted(at, docs), len(at) - 1)
        return np.where(at[i] == docs, f[i], 0)


class Shard:
    """One shard's lists, by term number."""

    def __init__(self, row):
        self.ids = np.frombuffer(row.ids, np.int64)
        self.null = np.frombuffer(row.no_id, bool)
        m = np.frombuffer(row.m, np.int64)
        edge, top = np.frombuffer(row.last, np.int32).reshape(-1, 2).astype(np.int64), np.frombuffer(row.top, np.int64)
        self.lists: dict[int, _List] = {}
        b = d = t = 0
        kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32}
        for term, count, blocks, dw, tw in zip(row.terms, row.counts, row.blocks, row.doc_width, row.tf_width):
            held = count if blocks == 1 else blocks * BLOCK
            self.lists[int(term)] = _List(
                int(count), edge[b:b + blocks, 0], edge[b:b + blocks, 1], top[b:b + blocks],
                np.frombuffer(row.doc_data, kinds[dw], held, d), np.frombuffer(row.tf_data, kinds[tw], held, t), m)
            b, d, t = b + blocks, d + held * dw, t + held * tw
        self.sums = np.zeros(len(self.ids), np.int64)

    def best(self, query: list[tuple[int, int, int]], k: int, least: int) -> list[tuple[int, bool, int]]:
        """(-score, id is null, id) of the documents that may be among the ``k`` best with a score of at least ``least``.

        ``query``: (term, factor, bound of this and all later terms) by falling global bound."""
        acc, lists = self.sums, self.lists
        acc[:] = 0
        j = 0
        while j < len(query) and query[j][2] >= least:          # essential lists
            term, factor, _ = query[j]
            got = lists.get(term)
            if got is not None:
                docs, f = got.unpack()
                acc[docs] += factor * f
                least = max(least, _kth(acc[docs], k))
            j += 1
        rest = query[j][2] if j < len(query) else 0
        docs = np.flatnonzero(acc >= max(least - rest, 1))
        score = acc[docs]
        for i in range(j, len(query)):                          # the others, for the candidates only
            term, factor, _ = query[i]
            got = lists.get(term)
            after = query[i + 1][2] if i + 1 < len(query) else 0
            if got is None:
                on = score + after >= least
                docs, score = docs[on], score[on]
                continue
            b, top = got.block_of(docs)
            on = score + factor * top + after >= least
            docs, score, b, top = docs[on], score[on], b[on], top[on]
            held = top > 0
            if held.any():
                score[held] += factor * got.impacts(docs[held], b[held])
                least = max(least, _kth(score, k))
            if not len(docs):
                break
        on = score >= max(least, 1)
        docs, score = docs[on], score[on]
        order = np.lexsort((self.ids[docs], self.null[docs], -score))[:k]
        return list(zip((-score[order]).tolist(), self.null[docs[order]].tolist(), self.ids[docs[order]].tolist()))


def _kth(x: np.ndarray, k: int) -> int:
    """The k-th largest value (0 where there are fewer)."""
    return int(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else 0


def lengths(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per task the documents with a term, and their terms with repeats."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = [len(terms(t)) for t in pdf["text"].tolist()]
            yield pd.DataFrame({"docs": [sum(map(bool, n))], "terms": [sum(n)]})

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(count, "docs long, terms long")


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], n_docs: int, n_terms: int, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per shard with the posting lists of the vocabulary's terms in every document."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent.value
        names = known.keys()
        ids, m, term, tf, held = [], [], [], [], []
        for pdf in batches:
            for i, no_id, text in zip(pdf["id"].fillna(0).astype("int64").tolist(), pdf["id"].isna().tolist(), pdf["text"].tolist()):
                words = terms(text)
                if not words:
                    continue
                count = Counter(words)
                mine = names & count.keys()
                if not mine:
                    continue
                ids.append(None if no_id else i)
                m.append(length_norm(len(words), n_docs, n_terms))
                held.append(len(mine))
                term.extend([known[w] for w in mine])
                tf.extend([count[w] for w in mine])
                if len(ids) >= SHARD_DOCS or len(term) >= SHARD_POSTINGS:
                    yield _shard(ids, m, term, tf, held)
                    ids, m, term, tf, held = [], [], [], [], []
        if ids:
            yield _shard(ids, m, term, tf, held)

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInPandas(build, INDEX)


def _search_block(docs: DataFrame, queries: DataFrame, k: int, n_docs: int, n_terms: int, scratch: Scratch, name: str,
                  id_col: str, text_col: str) -> DataFrame:
    """(key, doc, score): the k best of each shard task for one block of queries."""
    asked = [(r["key"], Counter(terms(r["text"]))) for r in queries.collect()]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in asked for t in c}))}
    index = scratch.save(build_index(docs, vocabulary, n_docs, n_terms, id_col, text_col), f"index-{name}")
    entry = F.explode(F.arrays_zip("terms", "counts", "maxima")).alias("e")
    totals = index.select(entry).groupBy("e.terms").agg(F.sum("e.counts").alias("df"), F.max("e.maxima").alias("top"))
    known = {r["terms"]: (weight(n_docs, r["df"]), r["top"]) for r in totals.collect()}     # at most the vocabulary
    plans = []
    for key, count in asked:
        at = [(vocabulary[t], known[vocabulary[t]][0] * c, known[vocabulary[t]][1]) for t, c in count.items() if vocabulary[t] in known]
        at = sorted(((t, w, w * top) for t, w, top in at if w > 0), key=lambda x: (-x[2], x[0]))
        bound = np.cumsum([b for _, _, b in at][::-1])[::-1].tolist()
        plans.append((key, [(t, w, b) for (t, w, _), b in zip(at, bound)]))
    sent = docs.sparkSession.sparkContext.broadcast(plans)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heaps: dict[int, list] = {}
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                shard = Shard(row)
                for key, query in sent.value:
                    heap = heaps.get(key, [])
                    got = shard.best(query, k, -heap[-1][0] if len(heap) == k else 1)
                    if got:
                        heaps[key] = sorted(heap + got)[:k]
        rows = [(key, None if null else i, -score) for key, heap in heaps.items() for score, null, i in heap]
        out = pd.DataFrame(rows, columns=["key", "doc", "score"])
        yield out.astype({"key": "int64", "doc": "Int64", "score": "int64"})

    return scratch.save(index.mapInPandas(search, "key long, doc long, score long"), f"best-{name}")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           query_id_col: str = "item_id", query_text_col: str = "text", query_rows: int = QUERY_ROWS,
           query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` best documents of each query: query id, ``rank`` (from 1), document id, ``score``.

    A document's score is the sum, over the query's terms with repeats, of the term's
    weight times its impact (integers throughout, see ``weight``, ``impact`` and
    ``length_norm``); documents without a positive score are not returned. All
    documents are indexed, and results are exact. Queries are taken in blocks of about
    ``query_rows`` rows and ``query_bytes`` of text, one index each, so what the driver
    and the broadcasts hold is bounded.

    Defined cases: null and empty texts have no terms (such documents count nowhere,
    such queries have no rows); equal scores are ordered by the document id, null ids
    last; documents that repeat an id are documents of their own; a query id that
    repeats (or is null) gives each of its rows its own ranks; an empty table on either
    side gives an empty result; no other column is read, so none clashes.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    size = lengths(docs, text_col).agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    asked = queries.select(F.monotonically_increasing_id().alias("key"), F.col(query_id_col).alias("__id"),
                           F.col(query_text_col).cast("string").alias("text"))
    asked = scratch.save(asked, "queries")
    many = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-many["n"] // query_rows), -(-(many["bytes"] or 0) // query_bytes))
    kind = f"{queries.schema[query_id_col].dataType.simpleString()}"
    if not size["docs"] or not many["n"]:
        return spark.createDataFrame([], f"`{query_id_col}` {kind}, rank int, `{id_col}` long, score long")
    found = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).select("key", "text")
        part = _search_block(docs, block, k, size["docs"], size["terms"], scratch, str(b), id_col, text_col)
        found = part if found is None else found.unionByName(part)
    order = W.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(asked.select("key", "__id"), "key").select(
        F.col("__id").alias(query_id_col), "rank", F.col("doc").alias(id_col), "score")
