"""Substring ("contains") joins as equi-joins.

The reference matches a file name inside a longer name three times:
``source_filename LIKE '%' || f || '%'`` (J03), "name in object key" (J08) and
``source_nm LIKE '%f%'`` (J14). Written as a join condition, Catalyst can only
plan it as a sort-merge join on the equality keys (region) with the LIKE as a
residual: a few giant partitions, quadratic inside each.

Exact form on grams. A needle of ``GRAM`` characters or more is posted under
one of its grams, the one that the fewest needles have; a shorter needle is
posted as it is. The distinct haystack texts (a name occurs on many dates, it
is matched once) are expanded into their substrings of the posted lengths, at
most ``GRAM`` per character position however many needle lengths there are.
The lengths come from a scalar subquery, so nothing runs while a query is
built. The join is an equality on the gram; ``contains`` then confirms each
hit, and the matched (needle, text) pairs are joined with both sides' rows on
their keys. Matching is literal and case-sensitive (R4: no LIKE wildcards from
data). An empty needle is contained in every haystack, NULL in none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 5


def _pieces(text: str, size: str | Column) -> Column:
    """Distinct substrings of ``size`` characters of the column ``text`` (which has at least that many)."""
    size = F.col(size) if isinstance(size, str) else size
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(F.col(text), i, size)))


def posted(needles: DataFrame, needle_col: str) -> DataFrame:
    """(needle, gram) for the distinct needles: a short needle itself, else its rarest gram."""
    own = needles.select(F.col(needle_col).alias("__n")).where("__n is not null").distinct()
    # no filter on the length: Catalyst would carry it to the tables the names come from
    grams = F.when(F.length("__n") >= GRAM, _pieces("__n", F.lit(GRAM))).otherwise(F.array("__n"))
    grams = own.select("__n", F.explode(grams).alias("__g"))
    often = grams.groupBy("__g").agg(F.count(F.lit(1)).alias("__c"))
    return grams.join(often, "__g").groupBy("__n").agg(F.min(F.struct("__c", "__g")).alias("__m")).select("__n", F.col("__m.__g").alias("__g"))


def contains_join(needles: DataFrame, needle_col: str, haystacks: DataFrame, hay_col: str,
                  on: list[str] | None = None, how: str = "inner", posts: DataFrame | None = None) -> DataFrame:
    """Rows of ``needles`` x ``haystacks`` where ``hay_col`` contains ``needle_col``
    (and the ``on`` columns are equal). ``how`` is ``inner``, ``left_semi``
    (needles with at least one match) or ``left_anti``.

    Output columns (``inner``): needles' columns, then haystacks' columns that
    are not already in needles.

    ``posts``: ``posted`` of a catalog that holds every needle, where several
    joins look for names of one catalog (Spark then computes it once). They are
    broadcast: two short texts per name of the catalog.
    """
    on = list(on or [])
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    extra = [c for c in haystacks.columns if c not in on and c not in needles.columns] if how == "inner" else []
    catalog, posts = posts, posts if posts is not None else posted(needles, needle_col)
    sizes = F.coalesce(posts.agg(F.collect_set(F.length("__g"))).scalar(), F.array().cast("array<int>"))
    grams = (haystacks.select(F.col(hay_col).alias("__h")).where("__h is not null").distinct()
             .select("__h", F.explode(sizes).alias("__k")).where(F.col("__k") <= F.length("__h"))
             .select("__h", F.explode(_pieces("__h", "__k")).alias("__hg")))
    # A text has many grams and few of them are posted: with a catalog's posts broadcast
    # they are dropped where they are made. Posts of needles that no catalog bounds are a
    # shuffle stage of their own: its measured size lets AQE broadcast them.
    hit = grams.join(posts if catalog is None else F.broadcast(posts), F.col("__hg") == F.col("__g")).where(F.col("__h").contains(F.col("__n"))).select("__h", "__n")
    # Right side renamed so the join resolves by name even when both sides
    # come from the same table.
    rows = haystacks.select(F.col(hay_col).alias("__t"), *[F.col(c).alias(f"__r_{c}") for c in on],
                            *[F.col(c).alias(f"__x_{c}") for c in extra]).join(hit, F.col("__t") == F.col("__h"))
    if how != "inner":
        # Semi and anti join on the few matched keys.
        matched = rows.select(*[F.col(f"__r_{c}").alias(c) for c in on], F.col("__n").alias(needle_col)).distinct()
        return needles.join(matched, [*on, needle_col], how)
    cond = [F.col(f"__r_{c}") == F.col(c) for c in on] + [F.col("__n") == F.col(needle_col)]
    return needles.join(rows, cond).select(*needles.columns, *[F.col(f"__x_{c}").alias(c) for c in extra])
