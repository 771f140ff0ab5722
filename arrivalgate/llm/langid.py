"""Language identification by interpolated Kneser-Ney character models.

Counts of character 5-grams per language are taken over all training
documents: each task counts its own texts with numpy, Spark adds the counts
up. The lower orders (continuation counts, contexts) follow from the distinct
5-grams. Every order is a sorted array of 64-bit n-gram hashes (12 bits a
character) with probabilities beside it. No gram is left out: orders 3 to 5 are
cut into slices by the third and fourth character, which a 5-gram shares with
all its lower orders and contexts, and tasks load one slice at a time. A text gets the language with the
lowest cross-entropy per character; all training documents of a language give
the cross-entropy above which a text is not accepted as that language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from arrivalgate.llm.common import Scratch, fold_of

ORDER, BITS = 5, 12
LOW = 2                    # orders up to this one are in every slice
PAIR = (1 << 2 * BITS) - 1
DISCOUNT = 0.75
CHUNK = 500_000            # characters counted or scored at once
UNDETERMINED = "und"
UNIFORM = BITS * np.log(2.0)    # cross-entropy of any text if all characters are alike: the limit where nothing is measured


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """12-bit code of every code point: letters below 4096 keep theirs, other
    letters share the upper half; 32 (a space) stands for everything else."""
    n = 0x110000
    out = np.full(n, 32, np.int64)
    letter = np.fromiter(((0xD800 > i or i > 0xDFFF) and chr(i).isalpha() for i in range(n)), dtype=bool)
    cp = np.arange(n)
    out[letter] = np.where(cp < 4096, cp, 2048 + cp % 2048)[letter]
    return out


def encode(text: str) -> np.ndarray:
    """Codes of a whole text: lower case, every run of other characters one
    space, four spaces before and one after. Empty if there is no letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = _codes()[np.minimum(cp, 0x10FFFF)]
    space = c == 32
    if space.all():
        return np.zeros(0, np.int64)
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    c = c[keep]
    c = c[1:] if c[0] == 32 else c
    c = c[:-1] if c[-1] == 32 else c
    return np.concatenate([np.full(ORDER - 1, 32, np.int64), c, np.full(1, 32, np.int64)])


def grams(codes: np.ndarray) -> np.ndarray:
    """The packed 5-gram that ends at each character from the fifth on."""
    n = len(codes) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.zeros(n, np.int64)
    for i in range(ORDER):
        out = (out << BITS) | codes[i:i + n]
    return out


def chunks(texts: list[str]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """(text numbers, gram arrays) of about CHUNK characters at a time; a long
    text is one chunk of its own size."""
    at, got, size = [], [], 0
    for i, text in enumerate(texts):
        g = grams(encode(text))
        at.append(i)
        got.append(g)
        size += len(g)
        if size >= CHUNK:
            yield at, got
            at, got, size = [], [], 0
    if at:
        yield at, got


def count_grams(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, gram, n): how often each 5-gram occurs in the texts of each language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            g, n = (np.concatenate(x) for x in zip(*held[lang]))
            u, back = np.unique(g, return_inverse=True)
            return u, np.bincount(back, n, len(u)).astype(np.int64)

        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                for _, got in chunks(part["text"].tolist()):
                    u, n = np.unique(np.concatenate(got), return_counts=True)
                    held.setdefault(lang, []).append((u, n))
                    sizes[lang] = sizes.get(lang, 0) + len(u)
                    if sizes[lang] > 2_000_000:
                        u, n = merged(lang)
                        held[lang], sizes[lang] = [(u, n)], len(u)
                        if len(u) > 1_000_000:      # hand on what does not fit, the sums are made later
                            yield pd.DataFrame({"lang": lang, "gram": u, "n": n})
                            held[lang], sizes[lang] = [], 0
        for lang in held:
            if held[lang]:
                u, n = merged(lang)
                yield pd.DataFrame({"lang": lang, "gram": u, "n": n})

    slim = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .where("lang is not null and text is not null")
    return slim.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """One language: per order the sorted grams with their log probabilities and
    the sorted contexts with the log weight they give to the next lower order.

    With ``low``, the model of the lowest orders, only the orders above it are
    made from ``gram``."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, order: int = ORDER, low: Model | None = None):
        at = np.argsort(gram)
        key, count = gram[at], n[at].astype(float)
        done = len(low.keys) if low else 0
        levels = []
        for k in range(order, done, -1):       # count of the highest order; distinct left neighbours below
            levels.append((key, count))
            if k > done + 1:
                key, count = np.unique(key & ((1 << BITS * (k - 1)) - 1), return_counts=True)
                count = count.astype(float)
        self.keys, self.logp, self.ctx, self.logw = ([*x] for x in ((low.keys, low.logp, low.ctx, low.logw) if low else [()] * 4))
        lower_key, lower_p = (low.keys[-1], low.top) if low else (None, None)
        for key, count in reversed(levels):
            ctx, start = np.unique(key >> BITS, return_index=True)
            total = np.add.reduceat(count, start)
            kinds = np.diff(np.append(start, len(key)))
            # single counts below the discount (distinct neighbours of 1) keep a quarter of their mass
            weight = DISCOUNT * kinds / total
            at = np.searchsorted(ctx, key >> BITS)
            if lower_key is None:
                base = np.full(len(key), 1.0 / (1 << BITS))
            else:
                short = key & ((1 << BITS * len(self.keys)) - 1)
                base = lower_p[np.searchsorted(lower_key, short)]
            p = (count - DISCOUNT) / total[at] + weight[at] * base
            self.keys.append(key)
            self.logp.append(np.log(p).astype(np.float32))
            self.ctx.append(ctx)
            self.logw.append(np.log(weight).astype(np.float32))
            lower_key, lower_p = key, p
        self.top = lower_p if order < ORDER else None      # what the next order is built on

    def log_probability(self, gram: np.ndarray) -> np.ndarray:
        """Of the last character of each 5-gram (sorted or not) after the four before it."""
        out = np.zeros(len(gram))
        todo = np.arange(len(gram))
        for k in range(len(self.keys), 0, -1):
            if not len(todo):
                return out
            g = gram[todo] & ((1 << BITS * k) - 1)
            key = self.keys[k - 1]
            i = np.minimum(np.searchsorted(key, g), len(key) - 1)
            hit = key[i] == g
            out[todo[hit]] += self.logp[k - 1][i[hit]]
            todo, g = todo[~hit], g[~hit]
            ctx = self.ctx[k - 1]
            i = np.minimum(np.searchsorted(ctx, g >> BITS), len(ctx) - 1)
            known = ctx[i] == g >> BITS
            out[todo[known]] += self.logw[k - 1][i[known]]
        out[todo] += -BITS * np.log(2.0)
        return out


class Identifier:
    """The models of all languages, in name order, cut into slices.

    ``starts``: the smallest pair (third and fourth character) of each slice;
    ``slices``: per slice a broadcast of the languages' models of its grams."""

    def __init__(self, langs: list[str], starts: np.ndarray, slices: list):
        self.langs, self.starts, self.slices = langs, starts, slices

    def _models(self, i: int) -> list[Model]:
        """A single slice stays in the worker; of several, one at a time is in memory."""
        sent = self.slices[i]
        if len(self.slices) == 1 or not hasattr(sent, "_path"):
            return sent.value
        return sent.load_from_path(sent._path)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character and language, number of characters) of whole texts."""
        out, size = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for at, got in chunks(texts):
            n = np.array([len(g) for g in got])
            size[at] = n
            if n.sum():
                u, back = np.unique(np.concatenate(got), return_inverse=True)
                doc = np.repeat(np.arange(len(at)), n)
                part = np.maximum(np.searchsorted(self.starts, (u >> BITS) & PAIR, side="right") - 1, 0)
                logp = np.zeros((len(self.langs), len(u)))
                for i in np.unique(part):
                    mine = np.flatnonzero(part == i)
                    for j, m in enumerate(self._models(i)):
                        logp[j, mine] = m.log_probability(u[mine])
                for j in range(len(self.langs)):
                    out[at, j] = -np.bincount(doc, logp[j][back], len(at)) / np.maximum(n, 1)
        return out, size

    def judge(self, texts: list[str], limit: np.ndarray) -> pd.DataFrame:
        """lang_pred, score (0 to 1) and accepted (by each language's ``limit``) of each text."""
        if not self.langs:
            return pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": 0.0, "accepted": False})
        h, n = self.entropies(texts)
        best = h.argmin(axis=1)
        low = h[np.arange(len(h)), best]
        odds = np.exp(-(h - low[:, None]) * np.minimum(n, 60)[:, None])
        some = n > 0
        ok = some & (low <= limit[best] + 3.0 / np.sqrt(np.maximum(n, 1)))
        names = np.array(self.langs, dtype=object)[best]
        names[~some] = UNDETERMINED
        return pd.DataFrame({"lang_pred": names, "score": np.where(some, 1.0 / odds.sum(axis=1), 0.0), "accepted": ok})


class Fitted:
    """The sliced models and, per language, the cross-entropy up to which a text is accepted."""

    def __init__(self, model: Identifier):
        self.model, self.langs, self.limit = model, model.langs, np.full(len(model.langs), UNIFORM)


def _slices(counts: DataFrame, langs: list[str], max_grams: int) -> Identifier:
    """The models of all counted 5-grams, in slices of about ``max_grams``.

    The driver holds the pairs of characters (as many as the alphabets have)
    and one slice at a time."""
    spark = counts.sparkSession
    number = F.lit(-1)
    for i, lang in enumerate(langs):
        number = F.when(F.col("lang") == lang, i).otherwise(number)
    pair = F.shiftright("gram", BITS).bitwiseAND(PAIR).cast("int").alias("pair")
    rows = counts.select(number.cast("int").alias("l"), "gram", F.least(F.col("n"), F.lit(2**31 - 1)).cast("int").alias("n"), pair)
    # the lowest orders: distinct left neighbours of each pair that ends a gram
    ends = rows.select("l", F.col("gram").bitwiseAND((1 << (LOW + 1) * BITS) - 1).alias("g")).distinct() \
        .groupBy("l", F.col("g").bitwiseAND(PAIR).alias("gram")).agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    low = {int(i): Model(p["gram"].to_numpy(), p["n"].to_numpy(), LOW) for i, p in ends.groupby("l")}
    sizes = rows.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas().sort_values("pair")
    before = (sizes["n"].cumsum() - sizes["n"]).to_numpy() // max_grams
    starts = sizes["pair"].to_numpy()[np.flatnonzero(np.diff(before, prepend=-1))].astype(np.int64)
    sent = []
    for lo, hi in zip(starts, [*starts[1:], PAIR + 1]):
        got = rows.where((F.col("pair") >= int(lo)) & (F.col("pair") < int(hi))).drop("pair").toArrow().to_pandas()
        own = {int(i): Model(p["gram"].to_numpy(), p["n"].to_numpy(), ORDER, low[int(i)]) for i, p in got.groupby("l")}
        sent.append(spark.sparkContext.broadcast([own.get(i, low[i]) for i in range(len(langs))]))
        del got, own
    return Identifier(langs, starts, sent)


def fit(docs: DataFrame, folds: int = 3, held_out: int = 1, max_grams: int = 500_000, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Fitted:
    """Learn from text and non-null language of all documents outside fold ``held_out``.

    The models hold every 5-gram of every such document. About ``max_grams`` of
    them make a slice, the part that driver and workers hold at once; the
    results do not depend on it. The cross-entropies of all training documents
    set each language's limit: half as much again as their 99.9 % quantile, so
    that only texts far from the language are refused. A language without a
    document to measure has ``UNIFORM`` as its limit.
    """
    train = docs.where(F.col(lang_col).isNotNull() & (fold_of(id_col, folds) != held_out))
    scratch = Scratch(docs.sparkSession, "langid")
    counts = scratch.save(count_grams(train, lang_col, text_col), "grams")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    model = _slices(counts, langs, max_grams)
    fitted = Fitted(model)
    if not fitted.langs:
        return fitted
    place = {lang: i for i, lang in enumerate(langs)}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, n = model.entropies(pdf["text"].tolist())
            own = pdf["lang"].map(place).fillna(0).to_numpy(int)      # a language without grams has no row to measure
            some = n > 0
            yield pd.DataFrame({"lang": pdf["lang"][some], "h": h[np.arange(len(h)), own][some]})

    every = train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    top = every.mapInPandas(measure, "lang string, h double").groupBy("lang").agg(F.expr("percentile_approx(h, 0.999, 10000)").alias("q"))
    for r in top.collect():
        fitted.limit[fitted.langs.index(r["lang"])] = 1.5 * r["q"]
    return fitted


def identify(docs: DataFrame, fitted: Fitted, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``accepted`` to every row, by the whole text."""
    model, limit = fitted.model, fitted.limit
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                         T.StructField("accepted", T.BooleanType())])

    @F.pandas_udf(kind)
    def judged(text: pd.Series) -> pd.DataFrame:
        return model.judge([t or "" for t in text], limit)

    got = docs.drop("lang_pred", "score", "accepted").withColumn("__l", judged(F.col(text_col).cast("string")))
    return got.select("*", "__l.*").drop("__l")


def classify(docs: DataFrame, folds: int = 3, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", **options) -> DataFrame:
    """Add ``held_out``, ``lang_pred``, ``score`` and ``accepted`` to every row of ``docs``.

    Defined cases: a null text and one without letters get ``und``, score 0 and
    are not accepted; where no training row exists all texts do; null languages
    are not learned; repeated rows are judged alike (and count as often as they
    occur); a null id counts as the empty text in the fold; an empty table gives
    an empty result; input columns named like a result are replaced, all others
    pass through. Only the text decides.
    """
    fitted = fit(docs, folds, held_out, id_col=id_col, text_col=text_col, lang_col=lang_col, **options)
    return identify(docs.drop("held_out"), fitted, text_col).withColumn("held_out", fold_of(id_col, folds) == held_out)
