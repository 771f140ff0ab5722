"""URL rules by a Bloom filter cascade.

A rule is ``host + path prefix`` (``example.org/es/``) with a verdict. Every
url yields a few candidate keys: the last k labels of its host joined with the
first n characters of its path, for the (k, n) shapes that occur in the rules.
Level 0 of the cascade is a Bloom filter of the listed keys; level 1 holds the
unlisted keys of the whole corpus that pass level 0; level 2 the listed keys
that pass level 1; and so on until a level lets nothing wrong through. So
membership is exact for every key the corpus can produce, without a join of
the pages with the rules.

Sizes follow the listed keys: with r listed and s other keys, level 0 has a
false-positive rate of sqrt(1/2) * r / s and every later level 1/2, so a
cascade takes about ``r * (1.44 * log2(1.41 s / r) + 5)`` bits. Lists whose
cascade would exceed ``max_bytes`` are cut into parts by key hash, each with
its own cascade and its own pass over the pages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from arrivalgate.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_LEVELS = 200
SHAPES = tuple[tuple[int, int], ...]


def url_parts(df: DataFrame, url_col: str) -> DataFrame:
    """Add ``host`` (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased) and ``path`` (from there up to ``?``, ``#`` or the end); both
    are empty for a null url or one without ``://``."""
    has = F.coalesce(F.instr("__u", "://") > 0, F.lit(False))
    df = df.withColumn("__u", F.col(url_col).cast("string"))
    df = df.withColumn("__rest", F.when(has, F.expr("substring(__u, instr(__u, '://') + 3)")).otherwise(""))
    raw = F.regexp_extract("__rest", r"^[^/?#]*", 0)
    df = df.withColumn("__raw", raw)
    df = df.withColumn("host", F.translate("__raw", UPPER, LOWER))
    df = df.withColumn("path", F.regexp_extract(F.expr("substring(__rest, length(__raw) + 1)"), r"^[^?#]*", 0))
    return df.drop("__u", "__rest", "__raw")


def key_shapes(rules: DataFrame) -> SHAPES:
    """The (host labels, path length) pairs that occur in the rules: a grouped
    count, a few dozen rows however long the list is."""
    rows = (rules.select(F.size(F.split(F.split_part("rule", F.lit("/"), F.lit(1)), r"\.")).alias("k"),
                         (F.length("rule") - F.length(F.split_part("rule", F.lit("/"), F.lit(1)))).alias("n"))
            .distinct().collect())
    return tuple(sorted((int(r.k), int(r.n)) for r in rows))


def candidates(host: str, path: str, shapes: SHAPES) -> list[str]:
    """The keys under which a rule for this url can be listed."""
    if not host:
        return []
    labels = host.split(".")
    return [".".join(labels[-k:]) + path[:n] for k, n in shapes if k <= len(labels) and n <= len(path)]


def hashes(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes per key."""
    raw = b"".join(xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass")) for k in keys)
    pair = np.frombuffer(raw, dtype=">u8").reshape(-1, 2).astype(np.uint64)
    return pair[:, 0], pair[:, 1] | np.uint64(1)


def bit_positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
    """Probe positions per key (rows) in a filter of ``bits`` bits; each level mixes anew."""
    steps = np.uint64(level * 64 + 1) + np.arange(probes, dtype=np.uint64)
    x = h1[:, None] + steps[None, :] * h2[:, None]
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x % np.uint64(bits)


class Level:
    """One Bloom filter: its words, probe count and place in the cascade."""

    def __init__(self, level: int, bits: int, probes: int, words: np.ndarray):
        self.level, self.bits, self.probes, self.words = level, bits, probes, words

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        p = bit_positions(h1, h2, self.level, self.bits, self.probes)
        return ((self.words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).all(axis=1)


def listed(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Membership by the cascade: the first level that says no decides by its parity."""
    out = np.zeros(len(h1), dtype=bool)
    open_ = np.arange(len(h1))
    for lv in levels:
        if not len(open_):
            break
        hit = lv.has(h1[open_], h2[open_])
        out[open_[~hit]] = lv.level % 2 == 1
        open_ = open_[hit]
    out[open_] = len(levels) % 2 == 1
    return out


def _fill(keys: DataFrame, count: int, level: int, rate: float) -> Level:
    """Build one filter from a key column: positions per task, bits joined by ``bit_or`` per word."""
    probes = max(1, min(60, round(-math.log2(rate))))
    bits = max(64, math.ceil(count * probes / math.log(2) / 64) * 64)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                p = bit_positions(*hashes(pdf["key"].tolist()), level, bits, probes).ravel()
                w, at = np.unique(p >> np.uint64(6), return_inverse=True)
                v = np.zeros(len(w), np.uint64)
                np.bitwise_or.at(v, at, np.uint64(1) << (p & np.uint64(63)))
                yield pd.DataFrame({"w": w.astype(np.int64), "v": v.view(np.int64)})

    got = keys.mapInPandas(words, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[got["w"].to_numpy(np.int64)] = got["v"].to_numpy(np.int64).view(np.uint64)
    return Level(level, bits, probes, out)


def build_cascade(keys: DataFrame, parts: DataFrame, shapes: SHAPES, scratch: Scratch, name: str,
                  universe: int) -> list[Level]:
    """Cascade of the listed ``keys`` (column ``key``, distinct) against every
    candidate key of ``parts`` (columns ``host``, ``path``). ``universe`` is an
    upper bound on the number of candidate keys; it sets sizes only."""
    n = keys.count()
    if n == 0:
        return []
    rate0 = min(0.5, math.sqrt(0.5) * n / max(universe, n))
    levels = [_fill(keys, n, 0, rate0)]
    spark = keys.sparkSession
    first = spark.sparkContext.broadcast(levels[:])

    def passing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen = sorted({k for h, p in zip(pdf["host"], pdf["path"]) for k in candidates(h, p, shapes)})
            if seen:
                yield pd.DataFrame({"key": np.array(seen, dtype=object)[first.value[0].has(*hashes(seen))]})

    wrong = (parts.select("host", "path").mapInPandas(passing, "key string").distinct()
             .join(keys, "key", "left_anti"))
    sets = [keys, scratch.save(wrong, f"{name}-1")]  # level i encodes sets[i % 2], filtered by the level before
    for level in range(1, MAX_LEVELS):
        side = sets[level % 2]
        count = side.count()
        if count == 0:
            return levels
        levels.append(_fill(side, count, level, 0.5))
        made = spark.sparkContext.broadcast(levels[-1])

        def through(batches: Iterator[pd.DataFrame], made=made) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    yield pdf[made.value.has(*hashes(pdf["key"].tolist()))]

        other = (level + 1) % 2
        sets[other] = scratch.save(sets[other].mapInPandas(through, "key string"), f"{name}-{level + 1}")
    raise RuntimeError(f"two keys agree in every hash: {MAX_LEVELS} levels do not separate them")


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
          max_bytes: int = 64 << 20) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    ``rules``: columns ``rule`` (host + path prefix) and ``verdict``. A rule
    fits its host and all subdomains if the url's path starts with the rule's
    path; the longest rule wins (of equally long ones the longer host). Urls
    that the cascades find under no rule get ``default`` and a null rule.

    Defined cases: a null url or one without ``://`` has empty host and path
    and fits nothing; repeated pages are judged alike; repeated rules count
    once; a rule listed with two verdicts counts as its smallest one in text
    order that is not ``default``; null rules are ignored; empty tables give
    empty results; input columns named like the four results are replaced,
    and all other columns pass unchanged.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "urls")
    one = F.coalesce(F.min(F.when(F.col("verdict") != default, F.col("verdict"))), F.min("verdict"))
    rules = scratch.save(rules.where("rule is not null and verdict is not null")
                         .groupBy("rule").agg(one.alias("verdict")), "rules")
    shapes = key_shapes(rules)
    parts = url_parts(pages.drop("host", "path", "rule", "verdict"), url_col)
    size = {r["verdict"]: r["count"] for r in rules.groupBy("verdict").count().collect()}
    universe = max(1, pages.count() * max(1, len(shapes)))
    n = sum(size.values())
    cuts = max(1, math.ceil(n * (1.44 * math.log2(1.42 * universe / max(n, 1) + 2) + 8) / 8 / max_bytes))
    out = parts.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    for cut in range(cuts):
        part = rules.where(F.pmod(F.xxhash64("rule"), F.lit(cuts)) == cut)
        made = {v: build_cascade(part.where(F.col("verdict") == v).select(F.col("rule").alias("key")),
                                 parts, shapes, scratch, f"{cut}-{i}", universe)
                for i, v in enumerate(sorted(size))}
        out = _apply(out, spark.sparkContext.broadcast(made), shapes)
        if cut + 1 < cuts:
            out = scratch.save(out, f"judged-{cut}")
    return out


def _apply(df: DataFrame, made, shapes: SHAPES) -> DataFrame:
    kind = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    @F.pandas_udf(kind)
    def best(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        at, keys = [], []
        for i, (h, p) in enumerate(zip(host, path)):
            c = candidates(h, p, shapes)
            keys += c
            at += [i] * len(c)
        rule, verdict = [None] * len(host), [None] * len(host)
        if keys:
            h1, h2 = hashes(keys)
            for v, levels in made.value.items():
                if levels:
                    for j in np.flatnonzero(listed(levels, h1, h2)):
                        old, new = rule[at[j]], keys[j]
                        if old is None or (len(new), new.find("/") % (1 << 30)) > (len(old), old.find("/") % (1 << 30)):
                            rule[at[j]], verdict[at[j]] = new, v
        return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": pd.Series(verdict, dtype=object)})

    df = df.withColumn("__best", best("host", "path"))
    # a later part of the list replaces an earlier find as inside a part: by a longer rule, or one as long with a longer host
    rank = lambda c: F.struct(F.length(c), F.when(F.instr(c, "/") == 0, F.length(c)).otherwise(F.instr(c, "/")))      # noqa: E731
    wins = F.col("__best.rule").isNotNull() & (F.col("rule").isNull() | (rank(F.col("__best.rule")) > rank(F.col("rule"))))
    return (df.withColumn("verdict", F.when(wins, F.col("__best.verdict")).otherwise(F.col("verdict")))
            .withColumn("rule", F.when(wins, F.col("__best.rule")).otherwise(F.col("rule"))).drop("__best"))
