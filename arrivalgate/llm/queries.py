"""The registered queries of the operators, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arrivalgate.llm import ann, host_rules, langid, lexical, mixing, neardup, nndescent, packing, periodic, quality, sharding, \
    toxicity, url_filter
from arrivalgate.llm.common import let, text_crc32

URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the five rules; urls under no rule are allowed."""
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links at cosine 0.95 or more and their component."""
    return nndescent.near_duplicates(_table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces of at most 2048 tokens, placed in sequences."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = packing.pack_documents(docs, 2048, 0, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by the factorization machine."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by the sparse rule ensemble."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by the Kneser-Ney models."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.classify(docs).select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op7_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix of sources (weights 5, 2, 1) takes of it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its near duplicates."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op9_kmeans_tree_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every vector whose id is divisible by 50."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), 5, 50).select("query_id", "rank", "vec_id", "score")


def op10_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards whose row counts are at most one apart."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_documents(docs, 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    items = _table(spark, sf_dir, "benchmark").select("item_id", "text")
    return lexical.search(docs, items, 10).select("item_id", "rank", "doc_id", "score")


def _planted(doc_id: Column, text: Column) -> Column:
    """The words of a text, joined by one space, in which the contract plants a period
    for a tenth of the documents: from word a on, word i becomes word a + (i - a) % p."""
    words = F.filter(F.split(text, host_rules.GAP, -1), lambda w: w != "")
    h = text_crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def plant(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        a = F.pmod(g, n)
        at = let(F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).alias("p")),
                 lambda s: F.transform(ws, lambda w, i: F.when(i < s["a"], w).otherwise(
                     F.get(ws, (s["a"] + F.pmod(i - s["a"], s["p"])).cast("int")))))
        return F.when(n > 0, F.array_join(at, " ")).otherwise(F.lit(""))

    return F.when(F.pmod(h, F.lit(10)) == 0, let(words, plant)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words: how many, the longest, and digests of all runs and of the rest."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", _planted(F.col("doc_id"), F.coalesce("text", F.lit(""))))
    got = periodic.find_runs(docs).select("doc_id", "runs", "collapsed")
    row = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = F.array_join(F.transform(row, lambda x: F.concat(x, F.lit("\n"))), "")
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("short"))))
    return got.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"), F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
        F.sha2(rows, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document measured, judged by its own rules and by those of its source."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return host_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "host", "host_docs", "failed_base", "host_ok")


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_nn_descent": op2_nn_descent,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_language_id": op6_language_id,
    "op7_pareto_mixing": op7_pareto_mixing,
    "op8_minhash_neardup": op8_minhash_neardup,
    "op9_kmeans_tree_ann": op9_kmeans_tree_ann,
    "op10_label_propagation": op10_label_propagation,
    "op11_block_max_search": op11_block_max_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_host_rules": op13_host_rules,
}

ORACLE_SQL = {
    "op1_url_filter": """
        with parts as (
            select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages),
        split as (
            select page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
            from parts),
        ruled as (
            select *, case
                when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
                when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
                when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
                when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
                when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/'
                end as rule
            from split)
        select page_id, host, path, rule,
               case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block' else 'allow' end as verdict
        from ruled""",
    "op11_block_max_search": r"""
        with d as (
            select row_number() over () as rid, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws
            from documents),
        q as (
            select row_number() over () as qid, item_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws
            from benchmark),
        corpus as (select count(*) as n_docs, sum(len(ws)) as n_terms from d where len(ws) > 0),
        asked as (select qid, term, count(*) as qtf from (select qid, unnest(ws) as term from q) group by all),
        posts as (
            select rid, term, count(*) as tf from (select rid, unnest(ws) as term from d)
            where term in (select term from asked) group by all),
        weights as (
            select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w
            from posts, corpus group by term, n_docs),
        norms as (select rid, doc_id, 100 - 75 + ((75 * len(ws) * n_docs) // n_terms)::bigint as m from d, corpus where len(ws) > 0),
        scores as (
            select qid, rid, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
            from asked join posts using (term) join weights using (term) join norms using (rid) group by all),
        ranked as (
            select qid, doc_id, score,
                   row_number() over (partition by qid order by score desc, doc_id asc nulls last) as rank
            from scores join norms using (rid) where score > 0)
        select item_id, rank::int as rank, doc_id, score from ranked join q using (qid) where rank <= 10""",
    "op13_host_rules": r"""
        with d as (select row_number() over () as rid, doc_id, source as host, coalesce(text, '') as t from documents),
        w as (
            select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
                   [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as ls
            from d),
        wins as (
            select rid, unnest([array_to_string(ws[i:i+4], ' ') for i in range(1, len(ws) - 3)]) as win,
                   unnest(range(1, len(ws) - 3)) as pos
            from w where len(ws) >= 5),
        twice as (select rid, win from wins group by all having count(*) > 1),
        marked as (
            select rid, count(distinct pos + o) as n
            from wins join twice using (rid, win), (select unnest(range(0, 5)) as o) group by rid),
        m as (
            select w.rid, doc_id, host, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
                   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
                   len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n, 0) as n_repeat_words, len(ls) as n_lines
            from w left join marked using (rid)),
        f as (
            select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
                   10 * n_symbols > word_chars as symbols_failed, 10 * n_dup_lines > 3 * n_lines as lines_failed
            from m),
        hosts as (
            select host, count(*) as host_docs, count(*) filter (base_failed) as failed_base,
                   count(*) filter (symbols_failed) as failed_symbols, count(*) filter (lines_failed) as failed_lines
            from f where host is not null group by host),
        long as (
            select host, host_docs::double as n, unnest(['base', 'symbols', 'lines']) as rule,
                   unnest([failed_base, failed_symbols, failed_lines])::double as x
            from hosts),
        sums as (
            select rule, count(*) as k, sum(n) as n, sum(n * n) as nn, sum(x) as x, sum(x * x / n) as s, sum(x) / sum(n) as mean
            from long group by rule),
        priors as (
            select rule, mean,
                   1 / case when k < 2 or mean = 0 or mean = 1 or n - nn / n - (k - 1) <= 0 then 1e-6
                       else least(greatest(((s - n * mean * mean) / (mean * (1 - mean)) - (k - 1)) / (n - nn / n - (k - 1)), 1e-6), 0.1)
                       end - 1 as strength
            from sums),
        verdicts as (
            select host, bool_and((x + mean * strength) / (n + strength) <= 0.5) as host_ok
            from long join priors using (rule) group by host)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not base_failed and coalesce(host_ok, true) as kept, n_lines, f.host, host_docs, failed_base, host_ok
        from f left join hosts on f.host = hosts.host left join verdicts on f.host = verdicts.host""",
}
