"""Trust that small links of a large host and long chains must not lose."""

from __future__ import annotations

from decimal import Decimal

from docflow.llm import url_trust


def ranks_of(spark, edges, seeds, **options):
    e = spark.createDataFrame(edges, "src string, dst string, n bigint")
    s = spark.createDataFrame([(k, h, Decimal(v)) for k, h, v in seeds], "kind string, host string, seed decimal(38,0)")
    return {(r["kind"], r["host"]): int(r["rank"]) for r in url_trust.propagate(e, s, **options).collect()}


def test_a_hot_host_passes_rank_to_its_small_targets(spark):
    edges = [("hot", "big", 5 * 10**7), ("hot", "small", 1), ("one", "hot", 1), ("many", "hot", 3 * 10**7)]
    got = ranks_of(spark, edges, [("trust", "hot", url_trust.FINE), ("distrust", "hot", url_trust.FINE)], iterations=1)
    assert got["trust", "small"] == url_trust.FINE * 85 // (100 * (5 * 10**7 + 1))
    assert got["distrust", "one"] == url_trust.FINE * 85 // (100 * (3 * 10**7 + 1))


def test_a_chain_is_followed_to_its_end(spark):
    edges = [(f"h{i:02d}", f"h{i + 1:02d}", 1) for i in range(14)]
    got = ranks_of(spark, edges, [("trust", "h00", url_trust.FINE)])
    assert all(abs(got["trust", f"h{i:02d}"] - 0.15 * 0.85**i * url_trust.FINE) < url_trust.BOUND for i in range(15))


def test_the_far_end_is_judged(spark):
    rows = [(0, "http://bad.com/x", "")] + [(i, f"http://h{i}.net/", f'<a href="http://{"bad.com" if i == 1 else f"h{i - 1}.net"}/">') for i in range(1, 13)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    out = url_trust.judge_urls(pages, [("bad.com/", "block")])
    assert all(r["url_filter"]["verdict"] == "block" for r in out.collect())
