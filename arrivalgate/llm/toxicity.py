"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: every distinct word and the word's
prefixes of 3 to 6 letters. The machine scores it as

    z = b + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2)

so pairs of terms (an insult and the mention of a group) add what a linear
model cannot. It is trained on a bounded sample of labelled documents in two
passes: a pass with a strong L1 penalty on weights and factors that selects terms,
and a pass without it on the selected terms, so the thousands of other words of a
long text add nothing. Selected are the terms that speak for toxicity by themselves
and all whose weight or factors stand out, whatever their sign: a term that only
makes another one toxic, or harmless, has no positive weight of its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from arrivalgate.llm.common import fold_of, ship
from arrivalgate.llm.sampling import labelled_sample, once

WORD = re.compile(r"[^\W\d_]+")
BITS = 18
PREFIXES = (3, 4, 5, 6)
CACHE_WORDS = 400_000
STANDS_OUT = 0.1        # share of the greatest |weight| + |factors|


def word_terms(word: str) -> list[int]:
    """Hashed terms of one lower-case word."""
    mask = (1 << BITS) - 1
    return [zlib.crc32(b"=" + word.encode("utf-8", "surrogatepass")) & mask,
            *(zlib.crc32(word[:k].encode("utf-8", "surrogatepass")) & mask for k in PREFIXES if len(word) > k)]


def terms(text: str) -> np.ndarray:
    """Sorted distinct terms of a whole text."""
    return np.array(sorted({t for w in set(WORD.findall(text.lower())) for t in word_terms(w)}), dtype=np.int32)


class Machine:
    """Fitted terms (sorted), weights, factors and bias."""

    def __init__(self, keys: np.ndarray, w: np.ndarray, v: np.ndarray, b: float):
        self.w, self.v, self.b = w, v, b
        self.place = {int(k): i for i, k in enumerate(keys)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def _word(self, word: str) -> tuple[int, ...]:
        got = tuple({self.place[t] for t in word_terms(word) if t in self.place})
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        if len(word) <= 64:
            self.cache[word] = got
        return got

    def score(self, text: str) -> float:
        find, on = self.cache.get, set()
        for word in set(WORD.findall(text.lower())):
            got = find(word)
            if got is None:
                got = self._word(word)
            if got:
                on.update(got)
        i = np.array(sorted(on), dtype=np.int64)
        s = self.v[i].sum(axis=0)
        z = self.b + self.w[i].sum() + 0.5 * float((s * s - (self.v[i] ** 2).sum(axis=0)).sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def _train(term: np.ndarray, ends: np.ndarray, y: np.ndarray, keys: np.ndarray, rank: int, epochs: int, l1: float,
           l2: float, positive: float, rate: float = 0.1, batch: int = 64, seed: int = 1):
    """AdaGrad on the terms in ``keys``; ``l1`` shrinks weights and factors towards 0."""
    rng = np.random.default_rng(seed)
    place = np.full(1 << BITS, -1)
    place[keys] = np.arange(len(keys))
    doc = np.repeat(np.arange(len(y)), np.diff(ends))
    kept = place[term] >= 0
    j_all, doc = place[term][kept], doc[kept]
    at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(y)))])
    w, v = np.zeros(len(keys)), rng.normal(0, 0.01, (len(keys), rank))
    gw, gv, gb = np.full(len(keys), 1e-2), np.full((len(keys), rank), 1e-2), 1e-2
    mean = (y.sum() + 0.5) / (len(y) + 1)
    b = float(np.log(mean / (1 - mean)))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(order), batch):
            d = order[s:s + batch]
            size = at[d + 1] - at[d]
            off = np.concatenate([[0], np.cumsum(size)])
            j = j_all[np.repeat(at[d] - off[:-1], size) + np.arange(off[-1])]
            r = np.repeat(np.arange(len(d)), size)
            vj = v[j]
            total = np.stack([np.bincount(r, vj[:, f], len(d)) for f in range(rank)], axis=1)
            square = np.bincount(r, (vj ** 2).sum(axis=1), len(d))
            z = b + np.bincount(r, w[j], len(d)) + 0.5 * ((total ** 2).sum(axis=1) - square)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[d]) * np.where(y[d] > 0, positive, 1.0)
            u, back = np.unique(j, return_inverse=True)
            dw = np.bincount(back, e[r], len(u)) / len(d) + l2 * w[u]
            dv = np.stack([np.bincount(back, e[r] * (total[r, f] - vj[:, f]), len(u)) for f in range(rank)], axis=1) / len(d) + l2 * v[u]
            gw[u] += dw ** 2
            gv[u] += dv ** 2
            sw, sv = rate / np.sqrt(gw[u]), 0.3 * rate / np.sqrt(gv[u])
            w[u] -= sw * dw
            v[u] -= sv * dv
            if l1:
                w[u] = np.sign(w[u]) * np.maximum(0, np.abs(w[u]) - l1 * sw)
                v[u] = np.sign(v[u]) * np.maximum(0, np.abs(v[u]) - l1 * sv)
            g = e.mean()
            gb += g * g
            b -= rate * g / np.sqrt(gb)
    return w, v, b


def select(keys: np.ndarray, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The terms that the second pass is trained on."""
    size = np.abs(w) + np.sqrt((v ** 2).sum(axis=1))
    return keys[(w > 0) | (size > STANDS_OUT * size.max(initial=0))]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 3000, folds: int = 5,
        held_out: int = 0, rank: int = 4, l1: float = 4e-3, min_docs: int = 3, id_col: str = "doc_id",
        text_col: str = "text") -> Machine:
    """Train on at most ``per_class`` labelled documents of each class from the
    folds other than ``held_out``. The executors hash the terms; the driver
    receives term numbers of that bounded sample only. Without labelled rows,
    or with one class only, the machine knows no terms and scores the base rate."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, per_class, folds, held_out, id_col, text_col)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"__id": pdf["__id"].astype(str), "y": pdf["y"], "t": [terms(t) for t in pdf["text"]]})

    rows = once(sample.mapInPandas(hashed, "__id string, y int, t array<int>").toPandas())
    y = rows["y"].to_numpy(float)
    base = (y.sum() + 0.5) / (len(y) + 1)
    none = Machine(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, rank)), float(np.log(base / (1 - base))))
    if len(y) == 0 or y.min() == y.max():
        return none
    term = np.concatenate([np.asarray(t, np.int64) for t in rows["t"]] + [np.zeros(0, np.int64)])
    ends = np.concatenate([[0], np.cumsum([len(t) for t in rows["t"]])])
    keys = np.flatnonzero(np.bincount(term, minlength=1 << BITS) >= min_docs)
    positive = min(3.0, (len(y) - y.sum()) / y.sum())
    chosen = select(keys, *_train(term, ends, y, keys, rank, 10, l1, 1e-4, positive)[:2])
    if not len(chosen):
        return none
    w, v, b = _train(term, ends, y, chosen, rank, 8, 0.0, 1e-3, positive)
    return Machine(chosen, w, v, b)


def score(docs: DataFrame, machine: Machine, out: str = "score", text_col: str = "text") -> DataFrame:
    """Add the toxicity ``out`` (0 to 1) of every whole text; a null or empty text has the score of no terms."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)   # at most a few thousand terms

    @F.pandas_udf("double")
    def toxic(text: pd.Series) -> pd.Series:
        return pd.Series([sent.value.score(t or "") for t in text], dtype=float)

    return docs.withColumn(out, toxic(F.col(text_col).cast("string")))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, folds: int = 5, held_out: int = 0,
             id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Add ``held_out``, ``score`` and ``predicted`` (score >= ``threshold``) to every row of ``docs``.

    Defined cases: null and empty texts score as texts without terms; rows that
    repeat are scored alike; a null id counts as the empty text in the fold; an
    empty table gives an empty result; input columns named like a result are
    replaced and all others pass through. Only the text decides a score.
    """
    machine = fit(docs, labels, folds=folds, held_out=held_out, id_col=id_col, text_col=text_col, **options)
    got = score(docs.drop("held_out", "score", "predicted"), machine, "score", text_col)
    return got.withColumn("held_out", fold_of(id_col, folds) == held_out) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
