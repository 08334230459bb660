from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.functions.elements import page_count
from docflow.functions.paths import doc_key
from docflow.operators import pages, parsing
from docflow.operators.flatten import parsed_elements


def ranges(spark, n, size=500):
    df = spark.createDataFrame([(n,)], "n int").select(pages.chunk_page_ranges("n", size).alias("r"))
    return df.first()["r"]


def test_known_ranges(spark):
    assert ranges(spark, 500) == ["1-500"]
    assert ranges(spark, 750) == ["1-500", "501-750"]
    assert ranges(spark, 1500) == ["1-500", "501-1000", "1001-1500"]
    assert ranges(spark, 1010) == ["1-500", "501-1000", "1001-1010"]
    assert ranges(spark, None) == ranges(spark, 0) == ranges(spark, -1) == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(counts=st.lists(st.integers(-2, 7000), min_size=1, max_size=8), size=st.integers(1, 600))
def test_ranges_cover_every_page_once(spark, counts, size):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "i int, page_count int")
    rows = pages.explode_page_ranges(df, size).collect()
    for i, n in enumerate(counts):
        covered = [p for r in sorted(rows, key=lambda r: r["chunk_idx"]) if r["i"] == i for p in range(r["first_page"], r["last_page"] + 1)]
        assert covered == list(range(1, n + 1))


def test_routes_are_exhaustive(spark):
    df = spark.createDataFrame([(None,), (-1,), (10,), (11,)], "page_count int")
    assert [r["route"] for r in pages.route_by_page_count(df, 10).collect()] == ["short", "short", "short", "long"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="abé \n.", max_size=300), min_size=1, max_size=6))
def test_split_and_merge_is_identity(spark, texts):
    df = spark.createDataFrame([(i, f"f/{i}.txt", t) for i, t in enumerate(texts)], "doc_id int, path string, text string")
    df = df.withColumn("page_count", page_count("text", 20))
    chunks = parsing.parse_text_chunks(parsing.text_chunks(df, 3, page_chars=20), page_chars=20)
    merged = parsing.merge_chunks(chunks, ["doc_id"])
    got = merged.select("doc_id", F.array_join(F.transform(parsed_elements(), lambda e: e["content"]), "").alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in got} == {i: t for i, t in enumerate(texts) if t}


def test_short_and_long_make_all_rows(spark):
    df = spark.createDataFrame([(1, "a", "x" * 10), (2, "b", "x" * 5000), (3, "c", None)], "doc_id int, path string, text string")
    df = df.withColumn("page_count", page_count("text"))
    got = {r["doc_id"]: r["chunk_count"] for r in parsing.parse_text_documents(df, 4, ["doc_id", "path"]).collect()}
    assert got == {1: 1, 2: 3, 3: 1}


def test_failed_chunks_are_counted_and_null_elements_do_not_null_the_document(spark):
    rows = [("a", 1, "y", None), ("a", 0, "x", None), ("a", 2, None, "boom"), ("b", 0, None, "boom")]
    df = spark.createDataFrame(rows, "path string, chunk_idx int, t string, err string").selectExpr(
        "path", "chunk_idx",
        """parse_json(case when err is not null then '{"error_status": "boom"}'
           when t = 'y' then '{"document": {"elements": null}, "error_status": null}'
           else '{"document": {"elements": [{"type": "text", "content": "x"}], "pages": []}, "error_status": null, "metadata": {"k": 1}}' end) as parsed""",
    )
    got = {r["path"]: r for r in parsing.merge_chunks(df, ["path"]).select("*", F.to_json("parsed").alias("j")).collect()}
    assert (got["a"]["chunk_count"], got["a"]["failed_chunks"]) == (2, 1)
    assert '"content":"x"' in got["a"]["j"] and '"error_status":null' in got["a"]["j"] and '"k":1' in got["a"]["j"]
    assert got["b"]["chunk_count"] == 0 and "all chunks failed" in got["b"]["j"]


def test_equal_names_in_two_folders_stay_apart(spark):
    df = spark.createDataFrame([("x/a.pdf",), ("y/a.pdf",)], "path string").select(doc_key("path").alias("k"))
    assert df.distinct().count() == 2


def test_unknown_and_stale_page_counts_lose_no_text(spark):
    rows = [(1, "a", "some text here", None), (2, "b", "x" * 5200, 3), (3, "c", "y" * 5300, 8), (4, "d", "z" * 700, 0), (5, "e", "w" * 5000, None)]
    df = spark.createDataFrame(rows, "doc_id int, path string, text string, page_count int")
    parsed = parsing.parse_text_documents(df, 4, ["doc_id", "path"])
    got = {r["doc_id"]: r["t"] for r in parsed.select("doc_id", F.array_join(F.transform(parsed_elements(), lambda e: e["content"]), "").alias("t")).collect()}
    assert got == {r[0]: r[2] for r in rows}
