"""Connected components in the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; the root is the least node of its component.

    Large-star and small-star steps: every node hands its larger neighbours to its least one, then its smaller ones. Each
    round is written to the shared folder; the rounds grow with the logarithm of the longest chain, and end when one changes
    nothing. Two sums per round reach the driver.
    """
    now = stored(_directed(edges), "components")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum((F.xxhash64("a", "b") / F.lit(2**32)).cast("long")).alias("h")).first()
        if (mark["n"], mark["h"]) == before:
            break
        before = (mark["n"], mark["h"])
        now = stored(_small_star(_large_star(now)), "components")
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionAll(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the lesser to the greater node."""
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _directed(both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    # a < b: the smaller neighbours of b are its a's.
    edges = stored(edges, "components")
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
    return _directed(moved.select(F.col("x").alias("a"), F.col("y").alias("b")).unionAll(least.select(F.col("m").alias("a"), "b")))
