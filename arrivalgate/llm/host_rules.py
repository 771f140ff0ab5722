"""Quality rules of documents, and of the hosts that they come from.

Every document is measured (words, symbols, repeated lines and passages) and
judged by rules over these measures. The failures are then added up per host.
A host with few documents says little, so its rate of failures is shrunk
towards the rate of all hosts: the hosts' true rates are taken as drawn from a
beta distribution, whose mean and spread are estimated from the hosts
themselves (moments of the beta-binomial), and the host's rate becomes the mean
of its posterior

    (failures + strength * mean) / (documents + strength).

A host whose shrunk rate exceeds a rule's limit fails that rule with all its
documents. Everything is Spark columns: a document's windows are hashed, sorted
and compared inside its own row, so no window of words is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arrivalgate.llm.common import Scratch, let

GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Failures (SQL over the measures) that a document itself must not have.
BASE_RULES = {"few_words": "n_words < 10", "repeats": "100 * n_repeat_words > 20 * n_words"}
#: Failures counted per host, with the shrunk rate that a host may reach.
HOST_RULES = {
    "base": ("n_words < 10 or 100 * n_repeat_words > 20 * n_words", 0.5),
    "symbols": ("10 * n_symbols > word_chars", 0.5),
    "dup_lines": ("10 * n_dup_lines > 3 * n_lines", 0.5),
}
#: Bounds of 1 / (strength + 1): the prior is worth at least nine documents, so that a few never condemn a host.
LEAST_SPREAD, MOST_SPREAD = 1e-6, 0.1
BROADCAST_HOSTS, BROADCAST_BYTES = 200_000, 32 << 20
HOT_SHARE = 20_000


def _repeated(windows: Column, size: int) -> Column:
    """Words that lie in a window whose hash occurs twice or more."""
    def covered(at: Column) -> Column:
        step = F.transform(at, lambda x, j: F.least(F.lit(size), F.coalesce(F.get(at, j + 1) - x, F.lit(size))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    def marked(s: Column) -> Column:
        twin = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])     # noqa: E731
        at = F.transform(s, lambda x, j: F.when(twin(x, j), x["i"]))
        return let(F.sort_array(F.array_compact(at)), covered)

    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(some, let(F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), marked)) \
        .otherwise(F.lit(0).cast("long"))


def _measures(words: Column, text: Column, size: int) -> Column:
    def windows(h: Column) -> Column:
        return F.when(F.size(h) >= size, F.transform(F.sequence(F.lit(0), F.size(h) - size),
                                                     lambda i: F.xxhash64(*[F.get(h, i + d) for d in range(size)]))) \
            .otherwise(F.array().cast("array<bigint>"))

    repeated = let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), lambda w: _repeated(w, size))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                           (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"), repeated.alias("n_repeat_words"))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            window: int = 5) -> DataFrame:
    """id, host and the measures of every whole text.

    ``n_words``: words ``[^\\x20\\x09-\\x0D]+``; ``word_chars``: their code points;
    ``n_symbols``: characters of ``#*$%&|<>``; ``n_lines``: ``\\n``-split lines with a
    word; ``n_dup_lines``: those equal to an earlier line; ``n_repeat_words``: words
    in windows of ``window`` words that the text holds twice or more. Windows of one
    text are compared by 64-bit hashes."""
    text = F.coalesce(F.col("__text"), F.lit(""))
    words = F.filter(F.split(text, GAP, -1), lambda w: w != "")
    slim = docs.select(F.col(id_col).alias("__id"), F.col(host_col).cast("string").alias("__host"),
                       F.col(text_col).cast("string").alias("__text"))
    got = slim.select("__id", "__host", let(words, lambda w: _measures(w, text, window)).alias("m"))
    return got.select(F.col("__id").alias(id_col), F.col("__host").alias("host"), "m.n_words", "m.word_chars", "m.n_symbols",
                      F.col("m.lines.dup").alias("n_dup_lines"), "m.n_repeat_words", F.col("m.lines.n").alias("n_lines"))


def host_rates(measured: DataFrame, rules: dict[str, tuple[str, float]] | None = None) -> DataFrame:
    """One row per non-null host: ``host_docs``, per rule ``failed_<rule>`` and the
    shrunk ``rate_<rule>``, and ``host_ok``. Counted with partial sums, so a hot host
    costs one row per task; the prior is one row of sums over the hosts."""
    rules = HOST_RULES if rules is None else rules
    hosts = measured.where("host is not null").groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"),
        *[F.count_if(F.expr(c)).alias(f"failed_{r}") for r, (c, _) in rules.items()])
    hosts = Scratch(measured.sparkSession, "hosts").save(hosts, "hosts")
    n = F.col("host_docs").cast("double")
    sums = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum("host_docs").alias("n"), F.sum(n * n).alias("nn"),
                     *[F.sum(f"failed_{r}").alias(f"x_{r}") for r in rules],
                     *[F.sum(F.col(f"failed_{r}").cast("double") * F.col(f"failed_{r}") / n).alias(f"s_{r}") for r in rules]).first()
    ok = F.lit(True)
    for r, (_, limit) in rules.items():
        mean, strength = prior(sums["k"], sums["n"] or 0, sums["nn"] or 0.0, sums[f"x_{r}"] or 0, sums[f"s_{r}"] or 0.0)
        rate = (F.col(f"failed_{r}") + F.lit(mean * strength)) / (F.col("host_docs") + F.lit(strength))
        hosts = hosts.withColumn(f"rate_{r}", rate)
        ok = ok & (F.col(f"rate_{r}") <= limit)
    return hosts.withColumn("host_ok", ok)


def prior(hosts: int, docs: int, squares: float, failed: int, spread: float) -> tuple[float, float]:
    """Mean and strength of the beta prior, by the moments of the beta-binomial.

    ``squares``: sum of the hosts' squared document counts; ``spread``: sum of
    failures squared over documents. Hosts that differ no more than chance would
    make them give the greatest strength, a single host or a rate of 0 or 1 too."""
    mean = failed / docs if docs else 0.0
    strongest = 1 / LEAST_SPREAD - 1
    room = docs - squares / docs - (hosts - 1) if docs else 0.0
    if hosts < 2 or room <= 0 or mean in (0.0, 1.0):
        return mean, strongest
    share = ((spread - docs * mean * mean) / (mean * (1 - mean)) - (hosts - 1)) / room
    return mean, 1 / min(max(share, LEAST_SPREAD), MOST_SPREAD) - 1


def judge(docs: DataFrame, base: dict[str, str] | None = None, rules: dict[str, tuple[str, float]] | None = None,
          id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", window: int = 5,
          broadcast_hosts: int = BROADCAST_HOSTS, hot_share: int = HOT_SHARE) -> DataFrame:
    """One row per document: id, ``host``, the measures, ``base_failed``, the host's
    counts and shrunk rates, ``host_ok`` and ``kept`` (no base rule failed and the host passes).

    The hosts are broadcast up to ``broadcast_hosts`` rows and 32 MB. Beyond that the
    hosts that hold more than one ``hot_share``-th of all documents each (fewer than
    ``hot_share`` of them) are broadcast, and all other hosts are joined by a shuffle in
    which no key is hot.

    Defined cases: null texts are empty texts, with all measures 0; a null host has no
    verdict, so its documents are judged by the base rules alone; the empty text is a
    host like others; rows that repeat count each and get a row each; ids pass through,
    nulls too; an empty table gives an empty result; no other column is read, so none clashes.
    """
    base = BASE_RULES if base is None else base
    spark = docs.sparkSession
    scratch = Scratch(spark, "host-rules")
    measured = scratch.save(measure(docs, id_col, text_col, host_col, window), "measured")
    hosts = host_rates(measured, rules)
    size = hosts.agg(F.count(F.lit(1)).alias("n"), F.sum("host_docs").alias("docs"),
                     F.sum(F.octet_length("host") + 8 * len(hosts.columns)).alias("bytes")).first()
    if size["n"] <= broadcast_hosts and (size["bytes"] or 0) <= BROADCAST_BYTES:
        joined = measured.join(F.broadcast(hosts), "host", "left")
    else:
        hot = F.col("host_docs") > size["docs"] // hot_share
        some = F.broadcast(hosts.where(hot))
        rest = measured.join(some.select("host"), "host", "left_anti").join(hosts.where(~hot), "host", "left")
        joined = measured.join(some, "host").unionByName(rest)
    failed = F.lit(False)
    for rule in base.values():
        failed = failed | F.coalesce(F.expr(rule), F.lit(False))
    out = joined.withColumn("base_failed", failed)
    out = out.withColumn("kept", ~F.col("base_failed") & F.coalesce("host_ok", F.lit(True)))
    first = [id_col, "host", *STATS, "base_failed", "kept"]
    return out.select(*first, *[c for c in hosts.columns if c != "host"])
