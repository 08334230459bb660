"""Nearest vectors against brute force."""

from __future__ import annotations

import time

import numpy as np
from docflow.operators import search
from docflow.plans import queries

SF = "/root/testdata/sf0.01"


def slow_top(rows, asked, k):
    ids, m = np.array(list(rows)), np.array(list(rows.values()), float)
    m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    out = {}
    for q in asked:
        scores = np.round(m @ m[list(ids).index(q)], 6)
        out[q] = [int(ids[j]) for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


def test_all_true_neighbours_are_found(spark):
    rows = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got, want = found(queries.QUERIES["knn_buckets"](spark, SF)), slow_top(rows, [i for i in rows if i % 20 == 0], 5)
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) == 1


def test_odd_vectors(spark):
    rows = {1: [1.0, 0.0], 2: [0.0, 0.0], 3: [-1.0, 0.0], 4: [0.9, 0.1], 5: [0.0, 2.0]}
    df = spark.createDataFrame(list(rows.items()), "vec_id bigint, embedding array<double>")
    assert found(search.knn_buckets(df, df, "vec_id", "embedding", dim=2, k=3)) == slow_top(rows, rows, 3)


def test_many_copies_of_one_vector(spark):
    """All rows in one bucket, all of them queries: pairs of rows must not leave a task."""
    rows = [(i, [1.0, 0.5, -0.25]) for i in range(20_000)] + [(20_000 + i, [0.1 * i, 1.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    start = time.monotonic()
    got = found(search.knn_buckets(df, df.filter("vec_id % 4 = 0"), "vec_id", "embedding", dim=3, k=3))
    assert time.monotonic() - start < 90
    assert all(got[q] == [i for i in range(4) if i != q][:3] for q in range(0, 20_000, 4))
    filled = {i: v + [0.0] * (3 - len(v)) for i, v in rows}
    some = range(20_000, 20_050, 4)
    assert {q: got[q] for q in some} == slow_top(filled, some, 3)


def test_best_rows_of_many_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "GROUP_ROWS", 40)
    monkeypatch.setattr(search, "ASKED_ROWS", 10)
    monkeypatch.setattr(search, "BOUND_SAMPLE", 100)
    monkeypatch.setattr(search, "CHUNK_ROWS", 16)
    r = np.random.default_rng(5)
    rows = {int(i): [float(x) for x in r.normal(size=4)] for i in r.permutation(500)}
    df = spark.createDataFrame(list(rows.items()), "vec_id bigint, embedding array<float>")
    rounded = {i: np.array(v, np.float32).tolist() for i, v in rows.items()}
    assert found(search.knn_buckets(df, df.filter("vec_id % 7 = 0"), "vec_id", "embedding", dim=4)) == slow_top(rounded, [i for i in rows if i % 7 == 0], 5)
