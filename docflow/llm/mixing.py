"""Mixing sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.common import free_name, stored, word_array

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
BUCKET_ROWS = 4096
SEED = 42


def n_words(text: str | Column) -> Column:
    return F.size(word_array(text)).cast("long")


def _hex_number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``_source, source_size, weight, target`` from ``_null, _source, source_size``, one row per source.

    The weights go round over the sources in code point order, NULL last. All targets add up to all sizes. A target
    stops at ``max_copies`` times its source's size and the excess is shared by weight among the others, until none is
    above: with the sources in the order of size by weight, the stopped ones come first, and one running sum finds
    where they end. The windows hold one short row per source.
    """
    place = F.row_number().over(Window.orderBy("_null", "_source")) - 1
    given = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")).cast("long")
    s = sizes.withColumn("weight", given)
    everything = Window.partitionBy(F.lit(0))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "_null", "_source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * max_copies
    s = (
        s.withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_weights", F.sum("weight").over(everything))
        .withColumn("_capped", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("_passed", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # A source is stopped if it is above its bound once all before it in that order are stopped.
    left, rest = F.col("_total") - F.col("_capped"), F.col("_weights") - F.col("_passed")
    s = s.withColumn("_stops", left * F.col("weight") >= cap * rest)
    held = F.coalesce(F.sum(F.when(F.col("_stops"), cap)).over(everything), F.lit(0))
    gone = F.coalesce(F.sum(F.when(F.col("_stops"), F.col("weight"))).over(everything), F.lit(0))
    shared = (F.col("_total") - held).cast("double") * F.col("weight") / (F.col("_weights") - gone)
    return s.select("_source", "source_size", "weight", F.when(F.col("_stops"), cap.cast("double")).otherwise(shared).alias("target"))


def systematic_copies(
    df: DataFrame,
    size: Column,
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """``df`` with a struct column ``mix``: ``size, source_size, target, copies``. Rows and columns stay as they are.

    Every document of a source expects ``target / source_size`` copies. The running sum of that, plus one random
    offset per source (a hash of seed and source), gives a copy for each whole number that it passes. Documents of a
    source run by hash bucket, in the bucket by size: neighbours are of like size, so the words taken come near the
    target. A source, however large, is spread over buckets of about ``BUCKET_ROWS`` rows (the number comes from the row
    count): their counts give where each bucket starts, and the rank in the bucket does the rest. One exchange
    moves the rows.

    NULL sources are a source of their own; NULL texts have size 0; a source without any word takes no copy. Repeated
    rows are separate rows. The same rows give the same copies at each run, except that rows alike in key, source and size
    may swap theirs.
    """
    names = {n: free_name(df, n) for n in ("_size", "_source", "_null", "_bucket", "_rank", "_plan", "mix")}
    s, src, null, bucket, rank = (F.col(names[n]) for n in ("_size", "_source", "_null", "_bucket", "_rank"))
    buckets = max(1, -(-df.count() // BUCKET_ROWS))
    dealt = _hex_number(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 8)
    rows = (
        df.withColumn(names["_size"], size)
        .withColumn(names["_null"], F.col(source).isNull())
        # A key that is never NULL: joins and windows then share one partitioning.
        .withColumn(names["_source"], F.concat(F.when(null, F.lit("n")).otherwise(F.lit("s")), F.coalesce(F.col(source), F.lit(""))))
        .withColumn(names["_bucket"], (dealt % buckets).cast("int"))
    )
    counts = stored(
        rows.groupBy(null.alias("_null"), src.alias("_source"), bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"), F.sum(s).alias("_words")),
        "mix-counts",
    )
    sources = counts.groupBy("_null", "_source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sources, weights, max_copies)
    # 20 bits: the offset and whole running sums are exact.
    offset = _hex_number(F.concat(F.lit(f"{seed}:"), F.col("_source")), 5) / F.lit(float(1 << 20))
    start = F.sum("_n").over(Window.partitionBy("_source").orderBy("_bucket")) - F.col("_n")
    plan = counts.join(targets, "_source").select(
        F.col("_source").alias(names["_source"]),
        F.col("_bucket").alias(names["_bucket"]),
        F.struct(start.alias("start"), offset.alias("offset"), "source_size", "target").alias(names["_plan"]),
    )
    inside = Window.partitionBy(names["_source"], names["_bucket"]).orderBy(s, F.col(key))
    ranked = rows.withColumn(names["_rank"], F.row_number().over(inside)).join(plan, [names["_source"], names["_bucket"]])
    p = F.col(names["_plan"])
    rate = F.coalesce(F.try_divide(p["target"], p["source_size"]), F.lit(0.0))
    upto = p["start"] + rank
    crossed = F.floor(upto * rate + p["offset"]) - F.floor((upto - 1) * rate + p["offset"])
    mix = F.struct(
        s.alias("size"),
        p["source_size"].alias("source_size"),
        p["target"].alias("target"),
        F.least(crossed, F.lit(max_copies)).cast("long").alias("copies"),
    )
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], mix.alias(names["mix"]))


def mixed_documents(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The mix itself: each row as many times as it has copies, with the columns of ``df``."""
    out = systematic_copies(df, n_words(text), source, key, **options)
    times = F.array_repeat(F.lit(1), F.col(f"`{out.columns[-1]}`.copies").cast("int"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return out.select(*columns, F.explode(times).alias(free_name(df, "_copy"))).select(*columns)
