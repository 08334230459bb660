"""Near copies by the similarity of their shingles: every pair at or above the threshold is linked, whatever it differs by."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.common import free_name, stored
from docflow.llm.graph import components

SHINGLE = 5
PERCENT = 80  # least Jaccard similarity of two near copies
ORDER_SAMPLE = 4_000  # texts whose shingles are counted for the order of prefixes; any order finds every pair
ORDER_SIZE = 1 << 18
SLOTS = 512
ODD = tuple(f"odd{k}" for k in range(SLOTS // 64))


def shingle_codes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit codes of the word shingles, rising. Words as for fingerprints; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    joined, starts, at = b" ".join(words), [0], 0
    for w in words:
        at += len(w) + 1
        starts.append(at)
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a : b - 1], 42) for a, b in zip(starts, starts[n:])), "<u8", len(words) - n + 1).view(np.int64))


def frequent_codes(rows: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes that stand in several texts of a bounded sample, rising, and how often."""
    every = max(1, rows.count() // ORDER_SAMPLE)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_codes(t, shingle))], names=["g"])

    some = rows.filter(F.pmod(F.xxhash64("text_hash", "_key"), F.lit(every)) == 0).select("text").mapInArrow(explode, "g bigint")
    top = some.groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter("c > 2").orderBy(F.desc("c"), "g").limit(ORDER_SIZE).collect()
    found = np.array(sorted((r["g"], r["c"]) for r in top), np.int64).reshape(-1, 2)
    return found[:, 0].copy(), found[:, 1].copy()


def node_of(codes: np.ndarray) -> int:
    h = xxhash.xxh64_intdigest(codes.tobytes(), 42)
    return h - (1 << 64) if h >> 63 else h


def counts_by_slot(codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """How many codes fall into each of ``SLOTS`` slots, at most 255, and which of these numbers are odd, as bits of longs. The
    sum of the differences of two texts' counts is at most the number of codes that only one of them has, and so is the
    number of differing bits."""
    found = np.bincount(codes.view(np.uint64) % np.uint64(SLOTS), minlength=SLOTS)
    return np.minimum(found, 255).astype(np.uint8).tobytes(), np.packbits(found & 1 == 1).view(np.int64)


def prefixes(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``_key, text_hash, node, n, slots, odd0.., gs, cold`` of each row: a hash of all its codes, their number, their counts by
    slot, which of these are odd, and the codes under which it meets every text that can be alike, the rarest of the sample first: ``cold`` of them stand in
    at most two texts of the sample.

    Two texts that reach the threshold share a code among the first ``n - ceil(threshold * n) + 1`` of each, in any order.
    """
    codes, counts = frequent_codes(rows, shingle)
    more = {"node": F.lit(0).cast("long"), "n": F.lit(0), "slots": F.lit(b""), **{c: F.lit(0).cast("long") for c in ODD}, "gs": F.array().cast("array<bigint>"), "cold": F.lit(0)}
    made = rows.drop("text").withColumns(more).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, nodes, sizes, slots, odd, cold = [], [], [], [], [], []
            for t in batch.column("text").to_pylist():
                s = shingle_codes(t, shingle)
                often = np.zeros(len(s), np.int64)
                if len(codes) and len(s):
                    at = np.minimum(np.searchsorted(codes, s), len(codes) - 1)
                    often = np.where(codes[at] == s, counts[at], 0)
                take = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                order = np.lexsort((s, often))[:take]
                found.append(s[order])
                nodes.append(node_of(s))
                sizes.append(len(s))
                count, bits = counts_by_slot(s)
                slots.append(count)
                odd.append(bits)
                cold.append(int((often[order] == 0).sum()))
            own = [batch.column(c) for c in ("_key", "text_hash")]
            made_ = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(slots, pa.binary()), *[pa.array([o[k] for o in odd], pa.int64()) for k in range(len(ODD))], lists_of(found), pa.array(cold, pa.int32())]
            yield pa.RecordBatch.from_arrays([*own, *made_], names=made.names)

    return rows.mapInArrow(run, made)


def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], pa.int64()))


def whole_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``node, n, s``: all codes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_codes(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, sets), pa.int64()), pa.array(map(len, sets), pa.int32()), lists_of(sets)], names=["node", "n", "s"])

    return texts.select("text").mapInArrow(run, "node bigint, n int, s array<bigint>")


def alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the pairs that reach the threshold."""
    left, right = (sets.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("s").alias(f"s{c}")) for c in "ab")
    met = pairs.join(left, "a").join(right, "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return met.select("a", "b", "na", "nb", both.alias("c")).filter(F.col("c") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b")


def possible(percent: int, na: str, pa_: str, nb: str, pb: str) -> Column:
    """Whether texts of ``na`` and ``nb`` codes whose first common code stands at ``pa`` and ``pb`` can be alike: by size, and by
    what is left of each from that code on. A pair that is alike passes in the bucket of its first common code."""
    size = F.least(na, nb) * 100 >= percent * F.greatest(na, nb)
    left = F.least(F.col(na) - F.col(pa_), F.col(nb) - F.col(pb))
    return size & (left * (100 + percent) >= percent * (F.col(na) + F.col(nb)))


def met_by_slots(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose counts by slot leave room for the threshold: the codes of one text only are at most
    (100 - percent) / (100 + percent) of both texts' codes together."""
    left, right = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("slots").alias(f"s{c}")) for c in "ab")
    met = pairs.distinct().join(left.hint("merge"), "a").join(right.hint("merge"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, SLOTS).astype(np.int16) for c in ("sa", "sb"))
                apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
                total = b.column("na").to_numpy().astype(np.int64) + b.column("nb").to_numpy()
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(apart * (100 + percent) <= total * (100 - percent)))

    return met.mapInArrow(run, "a bigint, b bigint")


def buckets(placed: DataFrame) -> DataFrame:
    """``g, node, n, p, leader, nl, pl``: the texts that share a code of their prefixes, with the code's place in each, and the
    smallest text of the bucket. Codes of one text lead to nobody and end here.

    Codes that the sample shows in several texts may be hot: their buckets are counted before the shuffle, and joined. All
    others are dealt by code once.
    """
    entries = placed.select("node", "n", "cold", F.posexplode("gs").alias("p", "g"))
    rare = entries.filter("p < cold").drop("cold").repartition("g").dropDuplicates(["g", "node"])
    w = Window.partitionBy("g").orderBy("n", "node")
    first = F.first(F.struct("node", "n", "p")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rare = rare.withColumns({"first": first, "next": F.lead("node").over(w)}).filter("next IS NOT NULL OR first.node <> node").drop("next")
    often = entries.filter("p >= cold").drop("cold").distinct()
    least = often.groupBy("g").agg(F.min(F.struct("n", "node", "p")).alias("x"), F.max(F.struct("n", "node")).alias("last")).filter("x.node <> last.node")
    often = often.join(least.select("g", F.struct("x.node", "x.n", "x.p").alias("first")), "g")
    both = rare.select("g", "node", "n", "p", "first").unionAll(often.select("g", "node", "n", "p", "first"))
    return both.select("g", "node", "n", "p", F.col("first.node").alias("leader"), F.col("first.n").alias("nl"), F.col("first.p").alias("pl"))


def links(rows: DataFrame, placed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``a, b``: pairs at or above the threshold that connect all such pairs.

    In a bucket, each text meets the smallest one first. Texts alike to it are connected already and aren't paired; the others
    meet all texts of the bucket that sizes, places of the code and odd slots allow. Counts by slot, a fraction of a set's size, refuse
    most pairs; whole sets are made of the texts that still meet another one only.
    """
    nodes = stored(placed.select("node", "n", "slots", *ODD, "text_hash").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "slots", *ODD, "text_hash")]), "copies-nodes")
    led = stored(buckets(placed).join(nodes.select("node", *ODD).hint("merge"), "node"), "copies-led")
    fits = possible(percent, "n", "p", "nl", "pl")
    near = stored(met_by_slots(led.filter(F.expr("node <> leader") & fits).select(F.col("leader").alias("a"), F.col("node").alias("b")), nodes, percent), "copies-near")

    def others(linked: DataFrame, at: DataFrame) -> DataFrame:
        """Pairs of the texts of ``at`` that ``linked`` (leader, node) doesn't hold with all texts of their buckets."""
        known = linked.select(F.col("a").alias("leader"), F.col("b").alias("node"))
        x = at.filter("node <> leader").join(known, ["leader", "node"], "left_anti").select("g", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("p").alias("px"), *[F.col(c).alias(f"x{c}") for c in ODD])
        y = at.filter("node <> leader").select("g", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("p").alias("py"), *[F.col(c).alias(f"y{c}") for c in ODD])
        bits = reduce(add, [F.bit_count(F.col(f"x{c}").bitwiseXOR(F.col(f"y{c}"))) for c in ODD])
        few = bits * (100 + percent) <= (F.col("nx") + F.col("ny")) * (100 - percent)
        met = x.join(y, "g").filter(F.expr("x <> y") & possible(percent, "nx", "px", "ny", "py") & few)
        return stored(met_by_slots(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), nodes, percent), "copies-rest")

    apart = others(near, led)
    # Leaders whose counts by slot allow a text, but whose sets don't: few, and their whole buckets have sets at hand.
    leaders = near.select(F.col("a").alias("leader")).distinct()
    again = stored(led.join(leaders, "leader", "left_semi"), "copies-again")
    wanted = near.select("a").unionAll(near.select("b")).unionAll(apart.select("a")).unionAll(apart.select("b")).unionAll(again.select("node")).distinct()
    hashes = nodes.join(wanted.withColumnRenamed("a", "node"), "node", "left_semi").select("text_hash").distinct()
    texts = rows.join(hashes.hint("merge"), "text_hash", "left_semi").select("text_hash", "text").dropDuplicates(["text_hash"])
    sets = stored(whole_sets(texts, shingle), "copies-sets")
    first = stored(alike(near, sets, percent), "copies-first")
    more = others(first, again).join(apart, ["a", "b"], "left_anti")
    return first.unionAll(alike(apart.unionAll(more), sets, percent))


def group_links(placed: DataFrame, linked: DataFrame) -> DataFrame:
    """``a, b``: every text of a group of ``linked`` (text_hash, root) with the group's least one."""
    named = stored(placed.select("text_hash", "node").distinct().join(linked, "text_hash").select("root", "node").distinct(), "copies-linked")
    return named.join(named.groupBy("root").agg(F.min("node").alias("a")), "root").select("a", F.col("node").alias("b"))


def copy_groups(
    df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT, linked: DataFrame | None = None
) -> DataFrame:
    """``_key, text_hash, root``: one row per row of ``df``; rows connected by near copies have one root. Texts without words
    are alike. ``linked`` (text_hash, root): groups that another method has found; both kinds of links connect."""
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text"))
    placed = stored(prefixes(rows, shingle, percent), "copies-prefixes")
    found = links(rows, placed, shingle, percent)
    roots = components(found if linked is None else found.unionAll(group_links(placed, linked)))
    named = placed.select("_key", "text_hash", "node").join(roots.withColumnRenamed("root", "_root"), "node", "left")
    return named.select("_key", "text_hash", F.coalesce("_root", "node").alias("root"))


def drop_near_copies(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One document of each group, the one with the smallest key (NULL last, then by text); columns as in ``df``.

    Of repeated rows one stays. Texts are shuffled once, by key and text hash.
    """
    mine, hashed = free_name(df, "_group_key"), free_name(df, "_group_text")

    def name(k: str):  # never NULL
        return F.concat(F.when(F.col(k).isNull(), "n").otherwise("k"), F.coalesce(F.col(k).cast("string"), F.lit("")))

    first = F.min(F.struct(F.col("_key").isNull().alias("n"), F.col("_key").alias("k"), F.col("text_hash").alias("t"), name("_key").alias("name")))
    chosen = copy_groups(df, text, key, **options).groupBy("root").agg(first.alias("f")).select(F.col("f.name").alias(mine), F.col("f.t").alias(hashed)).distinct()
    rows = df.withColumn(mine, name(f"`{key}`")).withColumn(hashed, F.xxhash64(F.col(f"`{text}`")))
    kept = rows.join(chosen, [mine, hashed], "left_semi").dropDuplicates([mine, hashed])
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
