"""Text quality by a sparse rule ensemble.

Boosted shallow trees over text statistics propose rules: every path from the
root to a node is a conjunction of comparisons. A lasso logistic regression
keeps the few rules that matter, and the kept rules are compiled into one
Spark column expression over the statistics columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from arrivalgate.llm.common import fold_of, ship
from arrivalgate.llm.sampling import labelled_sample, once

STATISTICS = ("words", "word_length", "upper", "digits", "marks", "symbols", "bars", "bangs", "repeats", "distinct",
              "lines", "distinct_lines", "letters", "stops")
SYMBOLS = np.frombuffer(b"#$%&*@^~=<>\\", np.uint8)
Condition = tuple[int, bool, float]     # statistic, below or equal, threshold
Rule = tuple[Condition, ...]


def statistics(text: str) -> list[float]:
    """The statistics of a whole text, in the order of ``STATISTICS``; all finite.
    Shares are of the letters, bytes, words or lines there are; 0 where there are none."""
    raw = text.encode("utf-8", "replace")
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = text.split()
    k, size = len(words), max(1, len(raw))
    upper, lower = int(n[65:91].sum()), int(n[97:123].sum())
    lines = [x for x in text.split("\n") if x]
    punct = int(n[33:48].sum() + n[58:65].sum() + n[91:97].sum() + n[123:127].sum())
    return [float(k), sum(map(len, words)) / max(1, k), upper / max(1, upper + lower), int(n[48:58].sum()) / size,
            punct / size, int(n[SYMBOLS].sum()) / size, int(n[124]) / max(1, k), int(n[33]) / max(1, k),
            sum(map(eq, words, words[1:])) / max(1, k - 1), len(set(words)) / max(1, k) if k else 0.0,
            float(len(lines)), len(set(lines)) / max(1, len(lines)) if lines else 0.0,
            (upper + lower + int(n[128:].sum())) / size, int(n[46]) / max(1, k)]


STRUCT = T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS])


def with_statistics(docs: DataFrame, out: str, text_col: str) -> DataFrame:
    """Add the statistics of every whole text as one struct column."""

    @F.pandas_udf(STRUCT)
    def stats(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t or "") for t in text], columns=list(STATISTICS), dtype=float)

    return docs.withColumn(out, stats(F.col(text_col).cast("string")))


def _tree(x: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int,
          path: Rule, found: list[Rule], least: int, step: np.ndarray) -> None:
    """Grow one regression tree on gradients; record every node's path; set the leaves' steps."""
    if path:
        found.append(path)
    gs, hs = g[rows].sum(), h[rows].sum()
    best = (1e-6, -1, 0.0)
    if depth:
        for f, cut in enumerate(cuts):
            if len(cut):
                b = np.searchsorted(cut, x[rows, f], side="left")   # bin i: value <= cut[i]
                gl, hl = np.cumsum(np.bincount(b, g[rows], len(cut) + 1))[:-1], np.cumsum(np.bincount(b, h[rows], len(cut) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(cut) + 1))[:-1]
                gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
                gain[(nl < least) | (len(rows) - nl < least)] = 0
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], f, float(cut[i]))
    if best[1] < 0:
        step[rows] = -gs / (hs + 1)
        return
    _, f, at = best
    low = x[rows, f] <= at
    _tree(x, cuts, g, h, rows[low], depth - 1, (*path, (f, True, at)), found, least, step)
    _tree(x, cuts, g, h, rows[~low], depth - 1, (*path, (f, False, at)), found, least, step)


def _tidy(rule: Rule) -> Rule:
    """One condition per statistic and direction: the tightest."""
    tight: dict[tuple[int, bool], float] = {}
    for f, low, at in rule:
        old = tight.get((f, low))
        tight[f, low] = at if old is None else (min(old, at) if low else max(old, at))
    return tuple(sorted((f, low, at) for (f, low), at in tight.items()))


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for f, low, at in rule:
        ok &= (x[:, f] <= at) if low else (x[:, f] > at)
    return ok


def _lasso(a: np.ndarray, y: np.ndarray, weight: np.ndarray, l1: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression by accelerated proximal gradient; the bias is free."""
    m = np.hstack([a, np.ones((len(a), 1))])
    size = 4.0 / max(1e-9, np.linalg.norm(m * np.sqrt(weight / weight.sum())[:, None], 2) ** 2)
    t, beta = 1.0, np.zeros(m.shape[1])
    ahead = beta.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(m @ ahead, -30, 30)))
        new = ahead - size * (m.T @ (weight * (p - y)) / weight.sum())
        new[:-1] = np.sign(new[:-1]) * np.maximum(0, np.abs(new[:-1]) - size * l1)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, beta, t = new + (t - 1) / t_new * (new - beta), new, t_new
    return beta[:-1], float(beta[-1])


class Ensemble:
    """Rules with weights and a bias."""

    def __init__(self, rules: list[Rule], weights: list[float], bias: float):
        self.rules, self.weights, self.bias = rules, weights, bias

    def column(self, stats: str) -> Column:
        """The score as one column expression over the statistics struct."""
        z = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            ok = F.lit(True)
            for f, low, at in rule:
                s = F.col(f"{stats}.{STATISTICS[f]}")
                ok = ok & ((s <= at) if low else (s > at))
            z = z + F.when(ok, weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-z))


def learn(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, l1: float = 2e-3, seed: int = 3,
          prior: float | None = None) -> Ensemble:
    """Rules from boosted trees, weights from the lasso. ``prior``: the share of
    class 1 outside the sample, to which the classes are weighed back."""
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 1.0) / (len(y) + 1.5) if len(y) else 0.5
        return Ensemble([], [], float(np.log(rate / (1 - rate))))
    rng = np.random.default_rng(seed)
    mean = y.mean()
    prior = mean if prior is None else min(max(prior, 0.01), 0.99)
    weight = np.where(y > 0, prior / mean, (1 - prior) / (1 - mean))
    cuts = []
    for f in range(x.shape[1]):
        v = np.unique(np.quantile(x[:, f], np.linspace(0.01, 0.99, 64)))
        cuts.append((v[:-1] + v[1:]) / 2)
    z = np.zeros(len(y))
    found: list[Rule] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        use = rng.random(len(y)) < 0.5        # each tree sees half of the rows
        g, h = (p - y) * use, np.maximum(p * (1 - p), 1e-6) * use
        step = np.zeros(len(y))
        _tree(x, cuts, g, h, np.arange(len(y)), depth, (), found, max(3, len(y) // 400), step)
        z += 0.5 * step
    rules = sorted(set(map(_tidy, found)))
    a = np.stack([_holds(r, x) for r in rules], axis=1).astype(float)
    _, first = np.unique(a, axis=1, return_index=True)     # rules that hold for the same rows count once
    rules, a = [rules[i] for i in sorted(first)], a[:, sorted(first)]
    w, b = _lasso(a, y, weight, l1)
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    # weights without the penalty's shrinkage on the kept rules
    w, b = _lasso(a[:, kept], y, weight, l1 / 20) if len(kept) else (np.zeros(0), b)
    return Ensemble([rules[i] for i in kept], [float(v) for v in w], b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 4000, folds: int = 5,
        held_out: int = 0, id_col: str = "doc_id", text_col: str = "text") -> Ensemble:
    """Fit on at most ``per_class`` labelled documents of each class from the
    folds other than ``held_out``; the driver receives their statistics only."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, per_class, folds, held_out, id_col, text_col)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"__id": pdf["__id"].astype(str), "y": pdf["y"], "x": [statistics(t) for t in pdf["text"]]})

    rows = once(sample.mapInPandas(measured, "__id string, y int, x array<double>").toPandas())
    share = labels.where(F.col(label).isin(0, 1) & (fold_of(id_col, folds) != held_out)).agg(F.avg(F.col(label).cast("double"))).first()[0]
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(STATISTICS))
    return learn(x, rows["y"].to_numpy(float), prior=share)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, held_out: int = 0,
             id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Add ``held_out``, ``score`` (0 to 1, higher: better text) and ``predicted`` (score >= ``threshold``).

    Defined cases: null and empty texts have the statistics of no words and are
    scored by the same rules; repeated rows are scored alike; without labels of
    both classes every text has the base rate; a null id counts as the empty
    text in the fold; an empty table gives an empty result; input columns named
    like a result are replaced, all others pass through. Only the text decides.
    """
    model = fit(docs, labels, folds=folds, held_out=held_out, id_col=id_col, text_col=text_col, **options)
    got = with_statistics(docs.drop("held_out", "score", "predicted"), "__stats", text_col)
    return got.withColumn("score", model.column("__stats")).drop("__stats") \
        .withColumn("held_out", fold_of(id_col, folds) == held_out) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
