"""The substring join equals a brute-force contains test on any strings."""

from hypothesis import given, settings
from hypothesis import strategies as st

from arrivalgate.operators.joins import contains_join

ALPHA = st.text(alphabet="ab_%.", max_size=7)


@settings(max_examples=15, deadline=None)
@given(needles=st.lists(st.tuples(st.sampled_from(["r1", "r2"]), ALPHA), max_size=6),
       hays=st.lists(st.tuples(st.sampled_from(["r1", "r2"]), ALPHA), max_size=6))
def test_contains_join_matches_brute_force(spark, needles, hays):
    n = spark.createDataFrame(needles, "regionname string, filename string")
    h = spark.createDataFrame(hays, "regionname string, source_filename string")
    got = sorted(tuple(r) for r in contains_join(n, "filename", h, "source_filename", on=["regionname"]).collect())
    want = sorted((rn, f, s) for rn, f in needles for rh, s in hays if rn == rh and f in s)
    assert got == want
    semi = sorted(tuple(r) for r in contains_join(n, "filename", h, "source_filename", ["regionname"], "left_semi").collect())
    assert semi == sorted((rn, f) for rn, f in needles if any(rh == rn and f in s for rh, s in hays))
    anti = sorted(tuple(r) for r in contains_join(n, "filename", h, "source_filename", ["regionname"], "left_anti").collect())
    assert anti == sorted((rn, f) for rn, f in needles if not any(rh == rn and f in s for rh, s in hays))


LONG = st.text(alphabet="abc%.", min_size=0, max_size=40)


@settings(max_examples=12, deadline=None)
@given(hays=st.lists(st.tuples(st.sampled_from(["r1", "r2"]), LONG), min_size=1, max_size=8), data=st.data())
def test_needles_of_any_length(spark, hays, data):
    """Needles of 1 to 40 characters, many of them cut from the haystacks, and NULLs on both sides."""
    cut = st.sampled_from(hays).flatmap(lambda h: st.tuples(st.just(h[0]), st.integers(0, 40), st.integers(0, 40)).map(
        lambda t: (t[0], h[1][min(t[1:]):max(t[1:])])))
    needles = data.draw(st.lists(st.one_of(cut, st.tuples(st.sampled_from(["r1", "r2"]), LONG)), max_size=8))
    n = spark.createDataFrame(needles + [("r1", None)], "regionname string, filename string")
    h = spark.createDataFrame(hays + [("r1", None)], "regionname string, source_filename string")
    got = sorted(tuple(r) for r in contains_join(n, "filename", h, "source_filename", on=["regionname"]).collect())
    assert got == sorted((rn, f, s) for rn, f in needles for rh, s in hays if rn == rh and f in s)
    anti = contains_join(n, "filename", h, "source_filename", ["regionname"], "left_anti").collect()
    assert sorted((r[0], r[1] or "") for r in anti if r[1] is not None) == sorted(
        (rn, f) for rn, f in needles if not any(rh == rn and f in s for rh, s in hays))


def test_building_a_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    n = spark.createDataFrame([("r1", "abc")], "regionname string, filename string")
    h = spark.createDataFrame([("r1", "xabcx" * 20)], "regionname string, source_filename string")
    spark.sparkContext.setJobGroup("build-only", "no job expected")
    joined = contains_join(n, "filename", h, "source_filename", on=["regionname"])
    assert list(tracker.getJobIdsForGroup("build-only")) == []
    assert joined.count() == 1


def test_pieces_are_linear_in_the_name(spark):
    from pyspark.sql import functions as F

    from arrivalgate.operators import joins
    import random
    r = random.Random(1)
    name = "".join(r.choice("abcdefghijklmnop") for _ in range(100))
    sizes = F.explode(F.sequence(F.lit(1), F.lit(joins.GRAM))).alias("k")
    got = spark.createDataFrame([(name,)], "h string").select("h", sizes).select(F.size(joins._pieces("h", "k")).alias("n"))
    assert got.agg(F.sum("n")).first()[0] <= joins.GRAM * len(name)


def test_grams_are_not_shuffled_with_a_catalog(spark):
    """With a catalog's posts the grams of a text are matched where they are made, whatever the session broadcasts by itself."""
    from arrivalgate.operators.joins import posted
    n = spark.createDataFrame([("r1", "abcdef"), ("r1", "ab"), ("r2", "fghijk")], "regionname string, filename string")
    h = spark.createDataFrame([("r1", "xabcdefabcdefx"), ("r1", "xabcdefabcdefx"), ("r2", "yab"), ("r2", None)],
                              "regionname string, source_filename string")
    joined = contains_join(n, "filename", h, "source_filename", on=["regionname"], posts=posted(n, "filename"))
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    gram = [line for line in plan.splitlines() if "Join" in line and "__hg#" in line]
    assert len(gram) == 1 and "BroadcastHashJoin" in gram[0]
    assert sorted(map(tuple, joined.collect())) == [("r1", "ab", "xabcdefabcdefx")] * 2 + [("r1", "abcdef", "xabcdefabcdefx")] * 2
