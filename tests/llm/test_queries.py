"""The registered queries: one per operator, whole tables, the SQL, and the pipeline against its stages."""

import collections
import re
import zlib

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from arrivalgate.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    ops = [re.match(r"op(\d+)_", k) for k in E.queries()]
    assert sorted(int(m[1]) for m in ops if m) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(ORACLE_SQL) <= set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    df = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(str, want)) == sorted(str(tuple(r[n] for n in names)) for r in df.collect())


COLUMNS = {
    "op2": ["vec_id", "n_links", "component_id", "kept"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "held_out", "score", "predicted"],
    "op6": ["doc_id", "held_out", "lang_pred", "score", "accepted"],
    "op7": ["doc_id", "size", "source_size", "target", "taken"],
    "op8": ["doc_id", "n_shingles", "component_id", "kept"],
    "op12": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op13": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "n_lines", "host", "host_docs", "failed_base", "host_ok"],
    "op10": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_one_row_per_input(spark, op):
    name = next(k for k in QUERIES if k.startswith(op + "_"))
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[op]
    table = "embeddings" if op == "op2" else "documents"
    assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "src0", None), (9002, "", None, None, 0)], docs.schema)
    docs = docs.union(extra).union(docs.limit(3))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mixing", "packing"]
    kept = docs
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns and kept.schema == docs.schema
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        seen.append(kept)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    after = {r["doc_id"] for r in seen[0].collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in after for d in good) >= 0.97 * len(good)
    assert sum(d in after for d, q in labels.items() if q == 0) <= 1

    def shingles(t):
        w = t.encode().lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    rest = [(r["doc_id"], shingles(r["text"])) for r in seen[2].collect()]
    for i, (_, a) in enumerate(rest):
        for _, b in rest[:i]:
            assert not a or 100 * len(a & b) < 75 * len(a | b)
    reached = {r["doc_id"]: shingles(r["text"]) for r in seen[1].collect()}
    left = {d for d, _ in rest}
    assert all(any(100 * len(s & reached[o]) >= 75 * len(s | reached[o]) for o in reached if o != d) for d, s in reached.items() if d not in left and s)
    times = collections.Counter(r["doc_id"] for r in seen[3].collect())
    assert max(times.values()) <= 3
    out = corpus_pipeline.STAGES[-1][1](spark, seen[3], SF).collect()
    assert collections.Counter(r["doc_id"] for r in out if r["piece"] == 0) == times


def test_fold_column(spark):
    from arrivalgate.llm.common import fold_of
    df = spark.createDataFrame([(i,) for i in (0, 7, -3, 10**12)] + [(None,)], "doc_id long")
    for r in df.select("doc_id", fold_of("doc_id", 5).alias("f")).collect():
        assert r["f"] == zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5


def test_packed_pieces_hold_their_tokens(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    packed = corpus_pipeline.pack_sequences(spark, docs, SF)
    from arrivalgate.llm import packing
    total = packed.agg({"length": "sum"}).first()[0]
    got = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in got) == total and all(0 < len(r["ids"]) <= 2048 for r in got)
