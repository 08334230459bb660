"""SimHash near-duplicates: pigeonring candidates, exact Hamming check, connected groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import free_name, stored
from docflow.llm.graph import components

SHINGLE = 3
DISTANCE = 2
PAIR_BUCKET = 64
BITS = 64
FULL = (1 << BITS) - 1


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash, as a signed long. Words of the text in lower case (A-Z only); no word gives zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, starts, at = b" ".join(words), [0], 0
    for w in words:
        at += len(w) + 1
        starts.append(at)
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    codes = np.fromiter((digest(joined[a : b - 1], 42) for a, b in zip(starts, starts[n:])), dtype="<u8", count=len(words) - n + 1)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(codes), 1 << 14):
        part = codes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(codes), bitorder="little").tobytes(), "little", signed=True)


def fingerprint(text: str | Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return of(text)


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def ring_masks(distance: int) -> list[list[int]]:
    """Masks of the chains: ``[start][length - 1]`` covers ``length`` consecutive segments on the ring of segments."""
    m = 3 * distance + 1
    cuts = [BITS * k // m for k in range(m + 1)]
    parts = [((1 << cuts[k + 1]) - 1) ^ ((1 << cuts[k]) - 1) for k in range(m)]
    chains = []
    for start in range(m):
        mask, row = 0, []
        for length in range(m):
            mask |= parts[(start + length) % m]
            row.append(mask)
        chains.append(row)
    return chains


def within(x: Column, masks: list[int], distance: int) -> Column:
    """Every chain from one start stays within its share of the distance; the longest one is the whole Hamming check."""
    m, ok = len(masks), None
    for length, mask in enumerate(masks, 1):
        budget = length * distance // m
        fits = F.bit_count(x.bitwiseAND(F.lit(signed(mask)))) <= budget
        ok = fits if ok is None else ok & fits
    return ok


def close_pairs(codes: DataFrame, distance: int = DISTANCE, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that join all that lie within ``distance``.

    Pigeonring: of two codes within the distance, cut into a ring of 3 * distance + 1 segments, some start exists from
    which every chain of consecutive segments differs by at most its share of the distance. The first segments of such
    a chain have a share below one bit, so they are equal: they are the bucket. In a bucket, the longer chains prune the
    pairs, the longest is the Hamming check.

    Buckets above ``pair_bucket`` codes aren't paired. Their codes are linked through variants: two codes are within
    2 * r bits if and only if flips of at most r bits take both to one variant, and a variant has few codes around
    it. Its codes are linked to their least. For an odd distance, one side flips one bit more and the link is checked.
    """
    chains = ring_masks(distance)
    m = len(chains)
    equal = max(length for length in range(1, m + 1) if length * distance < m) if distance else m
    keys = [F.struct(F.lit(i).alias("slot"), F.col("fp").bitwiseAND(F.lit(signed(c[equal - 1]))).alias("key")) for i, c in enumerate(chains)]
    keyed = stored(codes.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.slot", "k.key", "fp"), "simhash-keys")
    sizes = stored(keyed.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-buckets")
    few = keyed.join(sizes.filter(F.col("n") <= pair_bucket).drop("n"), ["slot", "key"])
    left, right = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    x = F.col("a").bitwiseXOR(F.col("b"))
    ring = F.coalesce(*[F.when(F.col("slot") == i, within(x, masks, distance)) for i, masks in enumerate(chains)])
    pairs = left.join(right, ["slot", "key"]).filter((F.col("a") < F.col("b")) & ring).select("a", "b")
    many = keyed.join(sizes.filter(F.col("n") > pair_bucket).drop("n"), ["slot", "key"]).select("fp").distinct()
    return pairs.unionAll(variant_links(many, distance))


def variant_links(codes: DataFrame, distance: int) -> DataFrame:
    """``a, b``: links of codes within ``distance`` through common variants. Linear in the codes for a fixed distance."""
    flips, reach = [0], [0]
    for _ in range((distance + 1) // 2):
        reach = sorted({r ^ (1 << k) for r in reach for k in range(BITS)} | set(reach))
        flips = reach
    moved = codes.select("fp", F.explode(F.array(*[F.lit(signed(v)) for v in flips])).alias("flip"))
    around = moved.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    if distance % 2 == 0:
        # All codes around a variant are within the distance of each other; their number is at most that of the flips.
        groups = around.agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
        linked = groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    else:
        groups = around.agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
        linked = groups.select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b"))
    return linked.filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).distinct()


def fingerprint_groups(codes: DataFrame, fp: str, distance: int = DISTANCE, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """``fp, root``: each distinct fingerprint with the least one that it reaches over links."""
    distinct = stored(codes.select(F.col(fp).alias("fp")).distinct(), "simhash-codes")
    roots = components(close_pairs(distinct, distance, pair_bucket))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """``key, text_hash, fp, root, component_id``, one row per row of ``df``. A group has one root, its least fingerprint;
    ``component_id`` is its smallest key.

    Documents without words have fingerprint 0 and are linked like any other. A NULL key is never the smallest; a group
    of NULL keys only has component NULL. Only keys, hashes and fingerprints are shuffled, never texts.
    """
    codes = stored(df.select(F.col(key).alias("_key"), F.xxhash64(text).alias("text_hash"), fingerprint(F.col(text), shingle).alias("fp")), "simhash-fingerprints")
    groups = stored(fingerprint_groups(codes, "fp", distance, pair_bucket), "simhash-groups")
    least = stored(codes.groupBy("fp").agg(F.min("_key").alias("_min")), "simhash-least")
    smallest = least.join(groups, "fp").groupBy("root").agg(F.min("_min").alias("component_id"))
    named = stored(groups.join(smallest, "root").select("fp", "root", "component_id"), "simhash-components")
    return codes.join(named, "fp").select(F.col("_key").alias(key), "text_hash", "fp", "root", "component_id")


def drop_near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One document of each group, the one with the smallest key (NULL last, then by text); columns as in ``df``.

    Of repeated rows one stays. Texts are shuffled once, by key and text hash.
    """
    codes = simhash_groups(df, text, key, **options)
    mine, hashed = free_name(df, "_group_key"), free_name(df, "_group_text")
    # A key that is never NULL: the join and the choice among repeated rows then share one shuffle.
    named = F.concat(F.when(F.col(key).isNull(), "n").otherwise("k"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    first = F.min(F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("text_hash").alias("t"), named.alias("name")))
    chosen = codes.groupBy("root").agg(first.alias("f")).select(F.col("f.name").alias(mine), F.col("f.t").alias(hashed)).distinct()
    rows = df.withColumn(mine, named).withColumn(hashed, F.xxhash64(F.col(text)))
    kept = rows.join(chosen, [mine, hashed], "left_semi").dropDuplicates([mine, hashed])
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
