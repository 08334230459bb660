"""Near-duplicate links and comparison of two extractions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.text import jaccard, let, normalised, tokens
from docflow.session import scratch_path
from docflow.sinks.tables import materialise

SHINGLE = 3


def shingles(text: str | Column, n: int = SHINGLE) -> Column:
    """Distinct word n-grams; a shorter text is one shingle."""

    def grams(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))

    return F.array_distinct(let(tokens(text), grams))


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.8) -> DataFrame:
    """Links ``key, duplicate_of, similarity`` of documents to the lowest earlier document that is alike. Complete.

    Exact copies (equal words) link to the lowest key of their group. Of the remaining distinct texts, two can reach the
    threshold only if they share one of their rarest shingles: with the shingles of a text ordered by document
    frequency, one of the first ``n - ceil(threshold * n) + 1``. Texts meet under those, and are compared exactly, as
    sets of shingle codes. First each meets the lowest text of the bucket. Two that are both alike to it need no
    comparison with each other, because neither can be the lowest partner of the other. So a group of alike texts,
    however large, takes one comparison per text and bucket. The number of jobs does not depend on the data.
    """
    # Never NULL, so the join on the hash adds no null check that would compute it again.
    hashed = df.select(key, F.coalesce(F.sha2(normalised(text), 256), F.lit("")).alias("_h"))
    groups = hashed.groupBy("_h").agg(F.min(key).alias("_first"))
    copies = (
        hashed.join(groups, "_h")
        .filter(F.col(key) != F.col("_first"))
        .select(key, F.col("_first").alias("duplicate_of"), F.lit(1.0).alias("similarity"))
    )
    scratch = scratch_path(df.sparkSession, "near-duplicates")
    distinct = df.join(groups.select(F.col("_first").alias(key)), key, "left_semi")
    codes = F.array_distinct(F.transform(shingles(text), lambda g: F.xxhash64(g)))
    sets = materialise(distinct.select(F.col(key).alias("k"), codes.alias("s")), f"{scratch}/sets")
    met = materialise(_rarest(sets, threshold), f"{scratch}/prefixes")
    leaders = met.groupBy("g").agg(F.min("k").alias("leader"), F.count("*").alias("c")).filter("c > 1").drop("c")
    led = materialise(met.join(leaders, "g"), f"{scratch}/led")
    first = materialise(_alike(led.filter("k > leader").select(F.col("leader").alias("a"), F.col("k").alias("b")), sets, threshold), f"{scratch}/first")
    known = first.select(F.col("a").alias("leader"), F.col("b").alias("k"), F.lit(True).alias("linked"))
    marked = materialise(led.filter("k > leader").join(known, ["leader", "k"], "left").select("g", "k", F.coalesce("linked", F.lit(False)).alias("linked")), f"{scratch}/marked")
    x, y = marked.filter("NOT linked").select("g", F.col("k").alias("x")), marked.select("g", F.col("k").alias("y"))
    rest = x.join(y, "g").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    links = first.unionByName(_alike(rest, sets, threshold))
    lowest = links.groupBy(F.col("b").alias(key)).agg(F.min(F.struct("a", "similarity")).alias("_l"))
    return copies.unionByName(lowest.select(key, F.col("_l.a").alias("duplicate_of"), F.col("_l.similarity").alias("similarity")))


def _rarest(sets: DataFrame, threshold: float) -> DataFrame:
    """``g, k``: the shingle codes under which a text can meet one that is alike, rarest first."""
    # Most codes stand in one text, so counting first saves no rows: one shuffle by code serves the counts and the join.
    rows = sets.select("k", F.size("s").alias("n"), F.explode("s").alias("g")).repartition("g")
    # Counting on the other columns keeps them in this branch as well, or the shuffle would not be shared.
    frequency = rows.groupBy("g").agg(F.count_if(F.col("k").isNotNull() & (F.col("n") > 0)).alias("f"))
    # Codes of one text only lead to nobody, but they stand first in the order and so count.
    ordered = rows.join(frequency, "g").groupBy("k", "n").agg(F.sort_array(F.collect_list(F.struct("f", "g"))).alias("o"))
    need = F.col("n") - F.ceil(F.round(F.lit(threshold) * F.col("n"), 9)) + 1
    return ordered.select("k", F.explode(F.slice("o", F.lit(1), need.cast("int"))).alias("x")).filter("x.f > 1").select(F.col("x.g").alias("g"), "k")


def _alike(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b, similarity`` of the distinct pairs that reach the threshold. Sets meet only if their sizes allow it."""
    s = sets.withColumn("n", F.size("s"))
    left = s.select(F.col("k").alias("a"), F.col("s").alias("sa"), F.col("n").alias("na"))
    right = s.select(F.col("k").alias("b"), F.col("s").alias("sb"), F.col("n").alias("nb"))
    sizes = s.select("k", "n")
    fit = (
        pairs.distinct()
        .join(sizes.select(F.col("k").alias("a"), F.col("n").alias("pa")), "a")
        .join(sizes.select(F.col("k").alias("b"), F.col("n").alias("pb")), "b")
        .filter(F.least("pa", "pb") >= F.lit(threshold) * F.greatest("pa", "pb") - 1e-9)
        .select("a", "b")
    )
    both = F.size(F.array_intersect("sa", "sb"))
    found = fit.join(left, "a").join(right, "b").select("a", "b", F.round(let(both, lambda c: c / (F.col("na") + F.col("nb") - c)), 6).alias("similarity"))
    return found.filter(F.col("similarity") >= threshold)


def compare_extractions(a: DataFrame, b: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Word overlap of two extractions of the same pages: keys, word counts, ``similarity``.

    A page that only one side has stays, with 0 words on the other.
    """
    none = F.array().cast("array<string>")
    left = a.select(*keys, tokens(text).alias("_a"))
    right = b.select(*keys, tokens(text).alias("_b"))
    both = left.join(right, keys, "full_outer").select(*keys, F.coalesce("_a", none).alias("_a"), F.coalesce("_b", none).alias("_b"))
    return both.select(
        *keys,
        F.size("_a").alias("words_a"),
        F.size("_b").alias("words_b"),
        F.round(jaccard(F.col("_a"), F.col("_b")), 6).alias("similarity"),
    )
