"""Best-fit packing of tokenised documents, planned on a histogram of lengths.

1. Tokenise: one row per piece (a document's ids and an end id, cut into
   pieces of at most ``capacity`` ids; only the first piece may be shorter).
2. Plan: count pieces per length (at most ``capacity`` counts) and run
   best-fit decreasing over the counts. Equal bins are one entry, so the plan
   has a few rows per length whatever the number of documents is.
3. Place: rank the pieces within their length and join the rank with the
   plan's ranges; the rank gives the sequence and the offset in it. Every task
   numbers its own pieces per length while they are stored, and one number per
   task and length shifts them, so that the ids are not shuffled.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from arrivalgate.llm.common import Scratch, ship

VOCABULARY = "byte_bpe_50k.json"
CACHE_UNITS = 250_000  # about 50 MB a worker
SPACE_RUN = re.compile(r" \s")
SHIFT_TASKS = 4_000     # tasks whose sums per length (about 24 kB each) are broadcast; those of more are joined by a shuffle
CUT_RUN = re.compile(r"\s \s|\s \Z")


class UnitTokenizer:
    """Ids of whole texts through a bounded cache of space-separated units.

    The vocabulary's pre-tokeniser starts a new token at every space that a
    non-space follows, so the ids of a text are those of its units, each with
    its leading space, one after the other. A space inside or at the end of a
    longer run of white space is no such boundary; texts that have one are
    encoded whole. The result equals ``Tokenizer.encode`` on the whole text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        self.special = [s for s in special if s]
        to_byte = {c: b for b, c in _byte_chars().items()}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.units = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        got = np.array(self.units.encode_ordinary(unit), dtype="<u4").tobytes()
        if len(self.cache) >= CACHE_UNITS:
            self.cache.clear()
        if len(unit) <= 64:
            self.cache[unit] = got
        return got

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if (" \n" in text or "  " in text or SPACE_RUN.search(text) or text.endswith(" ")) and CUT_RUN.search(text) \
                or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        find = self.cache.get
        out = [self._unit(first)] if first else []
        for unit in rest:
            out.append(find(" " + unit) or self._unit(" " + unit))
        return b"".join(out)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> UnitTokenizer:
    """One per worker process, so that its cache serves all its tasks."""
    return UnitTokenizer(path)


def _byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in own}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return out


def pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary: str | None = None,
           id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per piece: id, ``piece`` (from 0), ``start`` (the document's ids
    before it), ``length``, ``ids_crc32`` (of the little-endian unsigned 32-bit
    ids) and, with ``keep_ids``, ``ids`` (array of int).

    A null or empty text is the end id alone. Repeated documents give repeated
    pieces. Texts are read whole; one text must fit in a worker's memory.
    """
    return _cut(docs, capacity, end_id, vocabulary, id_col, text_col, keep_ids, False)


def _cut(docs: DataFrame, capacity: int, end_id: int, vocabulary: str | None, id_col: str, text_col: str, keep_ids: bool,
         number: bool) -> DataFrame:
    """The rows of ``pieces``; with ``number`` those of ``numbered`` in the same pass, by the same worker."""
    ship(docs.sparkSession)
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if number:
        fields += [T.StructField("__part", T.IntegerType()), T.StructField("__nth", T.LongType())]
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer(path)
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for pdf in batches:
            rows: dict[str, list] = {f.name: [] for f in fields}
            for doc, text in zip(pdf[id_col], pdf[text_col]):
                ids = tok.ids(text or "") + end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = (n - at) % capacity or capacity
                    raw = ids[4 * at:4 * (at + size)]
                    rows[id_col].append(doc)
                    rows["piece"].append(k)
                    rows["start"].append(at)
                    rows["length"].append(size)
                    rows["ids_crc32"].append(zlib.crc32(raw))
                    if keep_ids:
                        rows["ids"].append(np.frombuffer(raw, dtype="<i4"))
                    if number:
                        rows["__part"].append(part)
                        rows["__nth"].append(seen[size])
                        seen[size] += 1
                    at, k = at + size, k + 1
            yield pd.DataFrame(rows)

    slim = docs.select(id_col, F.col(text_col).cast("string").alias(text_col))
    return slim.mapInPandas(cut, T.StructType(fields))


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts. Rows (length, first_rank, ranks, first_bin,
    per_bin, offset): the ranks first_rank .. first_rank + ranks - 1 of a length go
    to consecutive bins from first_bin on, per_bin to each, side by side from offset.

    Open bins are kept as ranges of bins with equal free room. Placing c pieces
    of one length fills the tightest fitting range first; a range is cut at
    most twice per length, so the plan stays small.
    """
    plan: list[tuple[int, int, int, int, int, int]] = []
    open_: dict[int, list[tuple[int, int]]] = {}   # free room -> heap of (first bin, bins)
    rooms: list[int] = []
    bins = 0

    def keep(room: int, first: int, n: int) -> None:
        if room > 0 and n > 0:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            heapq.heappush(open_[room], (first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left > 0:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = heapq.heappop(open_[room])
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
            else:
                room, first = capacity, bins
                n = -(-left // (capacity // length))
                bins += n
            per = room // length
            whole = min(n, left // per)
            if whole:
                plan.append((length, rank, whole * per, first, per, capacity - room))
                keep(room - per * length, first, whole)
                left, rank, first, n = left - whole * per, rank + whole * per, first + whole, n - whole
            if n and left:   # one bin takes the last, fewer than per
                plan.append((length, rank, left, first, left, capacity - room))
                keep(room - left * length, first, 1)
                first, n, left = first + 1, n - 1, 0
            keep(room, first, n)
    return plan


def numbered(piece_rows: DataFrame, length_col: str, capacity: int) -> DataFrame:
    """Add ``__part`` (the task) and ``__nth`` (from 0, among the task's rows of that
    length). Only meaningful once stored: a plan that runs again may deal rows anew."""
    at = piece_rows.columns.index(length_col)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in piece_rows.schema.fields]
                          + [T.StructField("__part", T.IntegerType()), T.StructField("__nth", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            n = batch.column(at).fill_null(0).to_numpy(zero_copy_only=False)
            n = np.where((n < 1) | (n > capacity), 0, n)        # refused by ``pack``
            order = np.argsort(n, kind="stable")
            kinds, first, count = np.unique(n[order], return_index=True, return_counts=True)
            nth = np.empty(len(n), np.int64)
            nth[order] = np.arange(len(n)) - np.repeat(first - seen[kinds], count)
            seen[kinds] += count
            own = [pa.array(np.full(len(n), part, np.int32)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=schema.names)

    return piece_rows.mapInArrow(number, schema)


def pack(piece_rows: DataFrame, capacity: int = 2048, length_col: str = "length", shift_tasks: int = SHIFT_TASKS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every row; all other columns pass along.

    Rows are placed in as few sequences of ``capacity`` as best-fit decreasing
    finds; offsets are gapless from 0 in every sequence. ``piece_rows`` is
    stored once (tokenising is not repeated) and no row of it is shuffled: a
    row's rank within its length is its number in the task that stored it plus
    the rows of that length in the tasks before. Those sums (a row per task, of
    at most ``capacity`` numbers) are broadcast up to ``shift_tasks`` tasks and
    joined by a shuffle beyond. Lengths must lie in 1 to ``capacity``; other rows and null lengths
    raise an error. An empty table gives an empty result.
    """
    return _placed(numbered(piece_rows.drop("sequence_id", "offset"), length_col, capacity), capacity, length_col, shift_tasks)


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, shift_tasks: int = SHIFT_TASKS) -> DataFrame:
    """``pack(pieces(docs))`` with the numbers given by the worker that cuts the texts,
    so that a task needs one Python worker, not two."""
    return _placed(_cut(docs, capacity, end_id, vocabulary, id_col, text_col, keep_ids, True), capacity, "length", shift_tasks)


def _placed(rows: DataFrame, capacity: int, length_col: str, shift_tasks: int) -> DataFrame:
    """Store the numbered rows, plan on their counts and add ``sequence_id`` and ``offset``."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "pack")
    stored = scratch.save(rows, "pieces")
    counts = scratch.save(stored.groupBy("__part", F.col(length_col).cast("long").alias("s_length")).agg(F.count(F.lit(1)).alias("n")), "counts")
    hist = {r["s_length"]: r["n"] for r in counts.groupBy("s_length").agg(F.sum("n").alias("n")).collect()}
    if any(n is None or n < 1 or n > capacity for n in hist):
        raise ValueError(f"piece lengths must lie in 1 to {capacity}")
    plan = best_fit_plan(hist, capacity)
    schema = "p_length long, p_rank long, p_ranks long, p_bin long, p_per long, p_offset long"
    # one range per (length, first rank); the range of a rank is found by its place among the length's starts
    by_length = spark.createDataFrame([tuple(map(int, r)) for r in plan], schema).groupBy("p_length").agg(
        F.sort_array(F.collect_list(F.struct("p_rank", "p_ranks", "p_bin", "p_per", "p_offset"))).alias("__ranges"))
    before = W.partitionBy("s_length").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)      # one row per task
    shift = counts.select(F.col("__part").alias("s_part"), F.col("s_length").cast("int").alias("s_length"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    shift = shift.groupBy("s_part").agg(F.map_from_entries(F.collect_list(F.struct("s_length", "base"))).alias("__base"))
    shift = F.broadcast(shift) if counts.select("__part").distinct().count() <= shift_tasks else shift
    ranked = stored.join(shift, F.col("__part") == F.col("s_part")) \
        .withColumn("__r", F.col("__nth") + F.element_at("__base", F.col(length_col).cast("int")))
    got = ranked.join(F.broadcast(by_length), F.col(length_col) == F.col("p_length"))
    got = got.withColumn("__p", F.get(F.filter("__ranges", lambda x: (x["p_rank"] <= F.col("__r")) & (
        F.col("__r") < x["p_rank"] + x["p_ranks"])), F.lit(0)))
    step = F.col("__r") - F.col("__p.p_rank")
    return got.select(*[c for c in stored.columns if c not in ("__part", "__nth")],
                      (F.col("__p.p_bin") + F.floor(step / F.col("__p.p_per")).cast("long")).alias("sequence_id"),
                      (F.col("__p.p_offset") + F.pmod(step, F.col("__p.p_per")) * F.col(length_col)).cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and its ``ids`` in order
    (at most ``capacity`` ids, so each group is bounded)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
