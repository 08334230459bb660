"""Pages of both extractions, and pages that only one has."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import similarity
from docflow.plans import queries


def test_every_page_is_compared_with_both_sides(spark):
    out = queries.QUERIES["compare_extractions"](spark, "/root/testdata/sf0.001")
    assert out.filter("page_id % 10 IN (3, 7)").agg(F.min(F.least("words_a", "words_b"))).first()[0] > 0


def test_one_sided_pages_stay(spark):
    a, b = (spark.createDataFrame(x, "page_id int, text string") for x in ([(1, "a b"), (2, "c d e")], [(1, "a b"), (3, "f")]))
    got = {tuple(r) for r in similarity.compare_extractions(a, b, ["page_id"]).collect()}
    assert got == {(1, 2, 2, 1.0), (2, 3, 0, 0.0), (3, 0, 1, 0.0)}
