"""Runs (maximal periodic stretches) of the words of texts, by a dictionary of basic factors.

A run with period q is a stretch of at least 2 q words in which words q apart
are equal, that no neighbouring word extends, and that has no smaller period.

The dictionary names every stretch ("factor") of 1, 2, 4, ... words so that
equal stretches of one text have equal names; the names of one length follow
from those of half the length. Stretches that occur once need no name: nothing
longer that holds them occurs twice either, so the dictionary of ordinary prose
ends after a few lengths. For each length m, the occurrences of a factor that
follow each other within m / 2 form one arithmetic progression (their step is
the factor's smallest period). A run with period q, m <= q < 2 m, that starts
with the factor at s holds it again at s + q, in another progression, which is
at most the third after that of s. That later progression then starts at s + q,
or both progressions end q apart (were neither so, the run had a smaller
period). So two kinds of distance propose every period: from each occurrence to
the first of the next three progressions, and from the last of a progression to
the last of the next three. Proposals are extended to both sides by descending
the dictionary; each result's stretch keeps its smallest period.

The texts of a batch are laid behind each other, with a separate word between
them and with words named per text, so one pass of array operations serves all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from arrivalgate.llm.common import ship

CHUNK_BYTES = 2 << 20
RUNS = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))


def _level(pos: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names per position, -1 where the key occurs once; positions and group numbers of the others, by group and position)."""
    order = np.argsort(key, kind="stable")
    key, at = key[order], pos[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    group = np.cumsum(new) - 1
    often = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
    at, group = at[often], group[often]
    names = np.full(n, -1, np.int32)
    names[at] = group
    return names, at, group


def _proposals(at: np.ndarray, group: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) with m <= period < 2 m, from the progressions of one length."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.ones(len(at), bool)
    start[1:] = (group[1:] != group[:-1]) | (2 * (at[1:] - at[:-1]) > m)
    ap = np.cumsum(start) - 1
    first = np.flatnonzero(start)
    last = np.append(first[1:], len(at)) - 1
    found = []
    for t in (1, 2, 3):
        for here, edge in ((np.arange(len(at)), first), (last, last)):
            here = here[ap[here] + t < len(first)]
            there = edge[ap[here] + t]
            p = at[there] - at[here]
            ok = (group[there] == group[here]) & (p >= m) & (p < 2 * m)
            found.append((at[here][ok], p[ok]))
    i, p = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    order = np.lexsort((i, p))
    i, p = i[order], p[order]
    if len(i):      # the stretches [i, i + m) of one period that touch belong to one proposal
        keep = np.ones(len(i), bool)
        keep[1:] = (p[1:] != p[:-1]) | (i[1:] - i[:-1] > m)
        i, p = i[keep], p[keep]
    return i, p


def _extend(levels: list[np.ndarray], i: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretch around [i, i + p) in which words p apart are equal."""
    n = len(levels[0])
    right, left = i.copy(), i.copy()
    for k in range(len(levels) - 1, -1, -1):
        size, name = 1 << k, levels[k]
        a = np.minimum(right, n - 1)
        b = np.minimum(right + p, n - 1)
        same = (right + p < n) & (name[a] >= 0) & (name[a] == name[b])
        right = np.where(same, right + size, right)
        a = np.maximum(left - size, 0)
        b = np.maximum(left - size + p, 0)
        same = (left >= size) & (name[a] >= 0) & (name[a] == name[b])
        left = np.where(same, left - size, left)
    return left, right + p


def runs(names: np.ndarray, least: int = 2) -> np.ndarray:
    """(start, length, period) of every run of at least ``least`` words, by start and period.

    ``names``: a number per word, equal for equal words; negative numbers equal nothing.
    Memory: four bytes per word and length of the dictionary (at most log2 of the words)."""
    n = len(names)
    pos = np.flatnonzero(names >= 0)
    name, at, group = _level(pos, names[pos], n)
    levels, found = [], []
    m = 1
    while len(at):
        levels.append(name)
        found.append(_proposals(at, group, m))
        pos = np.sort(at)
        pos = pos[pos + m < n]
        pos = pos[name[pos + m] >= 0]
        key = name[pos].astype(np.int64) * (int(name.max()) + 1) + name[pos + m]
        name, at, group = _level(pos, key, n)
        m *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    i, p = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    start, end = _extend(levels, i, p)
    ok = end - start >= 2 * p
    got = np.unique(np.stack([start[ok], end[ok], p[ok]], axis=1), axis=0)
    keep = np.ones(len(got), bool)      # of several periods of one stretch the first, smallest one
    keep[1:] = (got[1:, 0] != got[:-1, 0]) | (got[1:, 1] != got[:-1, 1])
    got = got[keep]
    got = np.stack([got[:, 0], got[:, 1] - got[:, 0], got[:, 2]], axis=1)
    got = got[got[:, 1] >= least]
    return got[np.lexsort((got[:, 2], got[:, 0]))]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()       # at space and 0x09 to 0x0D


def _chunk(texts: list[list[bytes]], least: int, factor: int) -> list[tuple[list[tuple[int, int, int]], str]]:
    """Per text its runs and its words outside all runs' repeats, joined by one space."""
    names, base, ends = [], 0, []
    for words in texts:
        number: dict[bytes, int] = {}
        names.extend([number.setdefault(w, base + len(number)) for w in words])
        base += len(number)
        names.append(-1)
        ends.append(len(names))
    ends = np.array(ends)
    got = runs(np.array(names, np.int64), least)
    got = got[got[:, 1] >= factor * got[:, 2]]
    text = np.searchsorted(ends, got[:, 0], side="right")
    out = []
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    for t, words in enumerate(texts):
        mine = got[cut[t]:cut[t + 1]]
        if len(mine):
            mine = mine - np.array([ends[t] - len(words) - 1, 0, 0])
            drop = np.zeros(len(words) + 1, np.int64)
            np.add.at(drop, mine[:, 0] + mine[:, 2], 1)
            np.add.at(drop, mine[:, 0] + mine[:, 1], -1)
            keep = np.cumsum(drop[:-1]) == 0
            words = [w for w, k in zip(words, keep.tolist()) if k]
        out.append(([tuple(r) for r in mine.tolist()], b" ".join(words).decode("utf-8", "replace")))
    return out


def find_runs(docs: DataFrame, least: int = 12, factor: int = 2, text_col: str = "text", runs_col: str = "runs",
              collapsed_col: str = "collapsed") -> DataFrame:
    """Add to every row the runs of its whole text's words, and the text without their repeats.

    ``runs``: (start, length, period), word numbers from 0, of every run of at least
    ``max(least, factor * period)`` words (``factor`` 2 or more), by start, then period.
    ``collapsed``: the words, joined by one space, that no run contains after its first
    ``period`` words. Words are ``[^\\x20\\x09-\\x0D]+`` and compared as they are.

    Defined cases: null and empty texts and texts without words have no runs and an
    empty collapsed text; rows that repeat are treated alike; an empty table gives an
    empty result; columns named like the two results are replaced, all others pass
    through. A text is one row of one task, so its words must fit a task's memory
    (about 100 bytes a word and 4 more per dictionary length).
    """
    if factor < 2:
        raise ValueError("a run repeats its period at least twice")
    ship(docs.sparkSession)
    docs = docs.drop(runs_col, collapsed_col)
    kind = StructType([*docs.schema.fields, StructField(runs_col, RUNS), StructField(collapsed_col, StringType())])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, at, size = [], 0, 0
            for end, text in enumerate(pdf[text_col].tolist(), 1):
                texts.append(_words(text))
                size += len(text or "")
                if size >= CHUNK_BYTES or end == len(pdf):
                    got = _chunk(texts, least, factor)
                    part = pdf.iloc[at:end].copy()
                    part[runs_col] = [[dict(zip(("start", "length", "period"), r)) for r in g[0]] for g in got]
                    part[collapsed_col] = [g[1] for g in got]
                    yield part
                    texts, at, size = [], end, 0

    return docs.mapInPandas(find, kind)
