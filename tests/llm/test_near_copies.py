"""Near copies of the pipeline's stage against brute force over five-word shingles."""

from __future__ import annotations

import random
from itertools import combinations

import corpus_pipeline
from docflow.llm import near_copies, simhash


def five(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def slow_pairs(texts):
    sets = {i: five(t) for i, t in texts.items()}
    return {(i, j) for i, j in combinations(sorted(texts), 2) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}


def made_texts():
    r = random.Random(3)
    passage = [f"p{k}" for k in range(30)]
    texts = {}
    for g in range(40):
        base = [f"w{r.randrange(500)}" for _ in range(r.randrange(5, 150))] + (passage if g % 2 else [])
        for c in range(4):
            w = list(base)
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = f"e{r.randrange(500)}"
            texts[4 * g + c] = " ".join(w)
    return texts


def test_every_pair_of_near_copies_is_grouped(spark):
    texts = made_texts()
    want = slow_pairs(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    root = {r["_key"]: r["root"] for r in near_copies.copy_groups(df).collect()}
    assert len(want) > 30 and all(root[i] == root[j] for i, j in want)
    # And nothing else: the groups are the components of those pairs.
    up = {i: i for i in texts}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in want:
        up[max(top(i), top(j))] = min(top(i), top(j))
    assert all((root[i] == root[j]) == (top(i) == top(j)) for i, j in combinations(texts, 2))


def test_the_stage_drops_edited_copies(spark):
    texts = made_texts()
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    left = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()}
    assert 0 in left and not any(i in left and j in left for i, j in slow_pairs(texts))


def test_the_stage_groups_by_fingerprint_and_by_shingles(spark):
    """Texts of one fingerprint whose shingles differ, chained to a near copy whose fingerprint differs."""
    r = random.Random(8)
    often = "a b c " * 50
    tails = [" ".join(f"t{r.randrange(10**6)}" for _ in range(40)) for _ in range(2)]
    texts = {1: often + tails[0], 2: often + tails[1]}
    base = [f"w{k}" for k in range(60)]
    texts[3], texts[4] = " ".join(base), " ".join([*base[:58], "x", "y"])
    assert (simhash.fingerprint_of(texts[1]) ^ simhash.fingerprint_of(texts[2])).bit_count() <= 2
    assert bin((simhash.fingerprint_of(texts[3]) ^ simhash.fingerprint_of(texts[4])) & simhash.FULL).count("1") > 2
    assert slow_pairs(texts) == {(3, 4)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()} == {1, 3}
