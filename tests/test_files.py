from __future__ import annotations

import json
import os
import re
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from makers import docx, pdf, pptx, xlsx
from pyspark.sql import functions as F

from docflow.functions.pagecount import count_pages
from docflow.operators import bronze, parsing
from docflow.operators.flatten import flatten_elements, parsed_elements
from docflow.sources import files
from docflow.functions import elements as E
from docflow.sources.load_log import copy_into, read_loaded
from docflow.sources.spreadsheet import read_excel, unreadable_workbooks
from docflow.sinks.tables import batches
from docflow.streaming import flows


@pytest.fixture()
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "a.pdf").write_bytes(pdf(3))
    (root / "b.PDF").write_bytes(pdf(1010, packed=True))
    (root / "z.pdf").write_bytes(b"")
    (root / "broken.pdf").write_bytes(pdf(5)[:40])
    (root / "sub" / "c.docx").write_bytes(docx("Plan", ["first", "second"], [["Quarter", "Revenue"], ["Q1", "10 & 20"]]))
    (root / "sub" / "d.pptx").write_bytes(pptx([("One", "alpha"), ("Two", "beta"), ("Three", "gamma")]))
    (root / "e.txt").write_text("Title\nSome longer text that is certainly more than forty characters.")
    (root / "f.html").write_text("<html><title>T</title><body><h2>H</h2><p>a &amp; b</p><table><tr><td>1</td></tr></table></body></html>")
    (root / "g.txt").write_bytes(b"\xff\xfe\x00bad")
    return root


def test_page_counts():
    assert count_pages(pdf(0)) == 0
    assert count_pages(pdf(3)) == 3
    assert count_pages(pdf(1010)) == 1010
    assert count_pages(pdf(1010, packed=True)) == 1010
    assert count_pages(pdf(5)[:40]) is None
    assert count_pages(None) is None
    assert count_pages(pptx([("a", "b")] * 4)) == 4
    assert count_pages(docx("t", [])) == 1


def test_glob_recursion_and_case(spark, folder):
    names = lambda df: sorted(os.path.basename(r["path"]) for r in df.select("path").collect())
    assert names(files.read_files(spark, str(folder), glob="*.{pdf,pptx,docx}")) == ["a.pdf", "broken.pdf", "c.docx", "d.pptx"]
    every = files.read_files(spark, str(folder))
    assert {"a.pdf", "b.PDF", "broken.pdf"} <= set(names(files.with_extensions(every, "pdf")))
    assert "c.docx" not in names(files.read_files(spark, str(folder), recursive=False, glob="*.docx"))


def test_bronze_files(spark, folder):
    rows = {r["fileName"]: r for r in bronze.bronze_files(files.read_files(spark, str(folder))).drop("content").collect()}
    assert rows["a.pdf"]["page_count"] == 3 and rows["b.PDF"]["page_count"] == 1010 and rows["broken.pdf"]["page_count"] is None
    assert "z.pdf" not in rows


def test_parse_documents(spark, folder):
    parsed = parsing.parse_documents(files.read_files(spark, str(folder)))
    assert "content" not in parsed.columns
    status = {os.path.basename(r["path"]): r["e"] for r in parsed.select("path", parsing.error_status().alias("e")).collect()}
    assert status["a.pdf"].startswith("no parser") and status["g.txt"] == "not utf-8 text" and status["c.docx"] is None
    rows = flatten_elements(parsed.withColumn("e", parsed_elements()), "e", ("path",)).collect()
    by_file = lambda name: [(r["type"], r["content"], r["page_no"]) for r in sorted(rows, key=lambda r: r["pos"]) if r["path"].endswith(name)]
    assert by_file("c.docx") == [
        ("title", "Plan", 1), ("section_header", "Part one", 1), ("text", "first", 1), ("text", "second", 1),
        ("table", "<table><tr><td>Quarter</td><td>Revenue</td></tr><tr><td>Q1</td><td>10 &amp; 20</td></tr></table>", 1),
    ]
    assert [r[2] for r in by_file("d.pptx")] == [1, 1, 2, 2, 3, 3]
    assert by_file("f.html") == [
        ("title", "T", 1), ("section_header", "H", 1), ("text", "a & b", 1), ("table", "<table><tr><td>1</td></tr></table>", 1),
    ]
    assert by_file("e.txt")[0] == ("title", "Title", 1)


def test_user_parser_and_long_files(spark, folder):
    def by_page(content, page_range):
        first, last = (int(x) for x in page_range.split("-"))
        if first > 1000:
            raise ValueError("bad range")
        return {
            "elements": [{"type": "text", "content": str(p), "bbox": [{"page_id": p - 1}]} for p in range(first, last + 1)],
            "pages": [{"pageId": p - 1} for p in range(first, last + 1)],
        }

    long = bronze.bronze_files(files.read_files(spark, str(folder))).filter("page_count > 500")
    merged = parsing.parse_long_files(long, ["path", "page_count"], 500, parsers={"pdf": by_page}).withColumn("e", parsed_elements())
    row = merged.select("chunk_count", "failed_chunks", F.expr("transform(e, x -> int(x.content))").alias("c")).first()
    assert (row["chunk_count"], row["failed_chunks"]) == (2, 1) and row["c"] == list(range(1, 1001))


def test_parse_quarantine_split(spark, folder):
    parsed = parsing.parse_documents(files.read_files(spark, str(folder)))
    good, bad = parsing.split_parse_errors(parsed)
    assert good.count() + bad.count() == parsed.count() and bad.filter("parse_error is null").count() == 0


def test_excel(spark, tmp_path):
    (tmp_path / "one.xlsx").write_bytes(xlsx([["name", "n", "x"], ["a", 1, 1.5], ["b", 2, 2.0], ["c", None, 3.5]]))
    (tmp_path / "two.xlsx").write_bytes(xlsx([["name", "n", "x"], ["d", 4, 4.5]]))
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    df = read_excel(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "bigint", "double"]
    assert sorted((r["name"], r["n"], r["x"]) for r in df.collect()) == [("a", 1, 1.5), ("b", 2, 2.0), ("c", None, 3.5), ("d", 4, 4.5)]
    part = files.read_files(spark, str(tmp_path / "one.xlsx"), format="excel", data_address="Sheet1!A1:B3")
    assert part.columns == ["name", "n"] and part.count() == 2
    named = read_excel(spark, str(tmp_path), header_rows=1, schema="who string, n int, x double")
    assert named.columns == ["who", "n", "x"] and named.count() == 4


def test_csv_scan_and_copy_into(spark, tmp_path):
    src, table = tmp_path / "src", str(tmp_path / "table")
    src.mkdir()
    (src / "a 1.csv").write_text('id,name\n1,"x ""quoted"""\n2,y\n')
    assert files.read_files(spark, str(src), format="csv").schema["id"].dataType.simpleString() == "int"
    assert copy_into(spark, table, str(src), pattern="*.csv") == 1
    assert copy_into(spark, table, str(src), pattern="*.csv") == 0
    (src / "b[1].csv").write_text("id,name,extra\n3,z,9\n")
    with pytest.raises((ValueError, KeyError), match="new column"):
        copy_into(spark, table, str(src), pattern="*.csv")
    assert copy_into(spark, table, str(src), pattern="*.csv", merge_schema=True) == 1
    (src / "c.csv").write_text("id,name,extra\nnot,z,9\n")
    with pytest.raises((ValueError, KeyError), match="column id"):
        copy_into(spark, table, str(src), pattern="*.csv", merge_schema=True)
    rows = {r["id"]: (r["name"], r["extra"]) for r in read_loaded(spark, table).collect()}
    assert rows == {1: ('x "quoted"', None), 2: ("y", None), 3: ("z", 9)}


def test_file_metadata_struct(spark, folder):
    m = files.read_files(spark, str(folder)).select(files.file_metadata().alias("m"), F.col("_metadata.file_size").alias("s"), files.preview().alias("p"))
    row = m.filter("m.file_name = 'c.docx' and s > 100").first()
    assert row["m"]["mime_type"].endswith("wordprocessingml.document") and row["m"]["parent_path"].endswith("/sub")
    assert len(row["p"]) <= 100


def test_incremental_binary_stream(spark, folder, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        df = files.read_files(spark, str(folder), stream=True, glob="*.pdf").select("path", "length")
        flows.write_stream(df, cp, path=out).awaitTermination()
        return spark.read.parquet(out).count()

    first = run()
    (folder / "new.pdf").write_bytes(pdf(1))
    assert run() == first + 1
    assert run() == first + 1


def test_new_and_modified_files(spark, tmp_path):
    src, tracking = tmp_path / "src", str(tmp_path / "tracking")
    src.mkdir()
    (src / "a.txt").write_text("one")
    (src / "b.txt").write_text("two")
    seen: list[list[tuple[str, str]]] = []

    def work(df, run):
        seen.append(sorted((os.path.basename(r["path"]), bytes(r["content"]).decode()) for r in df.select("path", "content").collect()))

    assert flows.process_changed_files(spark, str(src), tracking, work) == 2
    assert flows.process_changed_files(spark, str(src), tracking, work) == 0
    time.sleep(0.05)
    (src / "a.txt").write_text("one again")
    os.utime(src / "a.txt", (time.time() + 10, time.time() + 10))
    (src / "c [1]{x}.txt").write_text("three")

    def fails(df, run):
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        flows.process_changed_files(spark, str(src), tracking, fails)
    assert flows.process_changed_files(spark, str(src), tracking, work) == 2
    assert seen == [[("a.txt", "one"), ("b.txt", "two")], [("a.txt", "one again"), ("c [1]{x}.txt", "three")]]
    assert batches(spark, tracking) == [0, 1]


def test_fixture_loader(load_fixture, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"x": 1}, {"x": 2}]))
    (tmp_path / "a.csv").write_text("x\n1\n")
    assert load_fixture(tmp_path / "a.json").count() == 2 and load_fixture(tmp_path / "a.csv").first()["x"] == "1"
    with pytest.raises((ValueError, KeyError)):
        load_fixture(tmp_path / "a.xml")


def test_images(spark, tmp_path):
    (tmp_path / "slide1.png").write_bytes(b"\x89PNG")
    (tmp_path / "note.txt").write_text("x")
    assert [os.path.basename(r["path"]) for r in files.read_images(spark, str(tmp_path)).collect()] == ["slide1.png"]


def test_csv_files_with_other_headers_and_a_crash_before_the_log(spark, tmp_path):
    src, table = tmp_path / "in", str(tmp_path / "table")
    src.mkdir()
    (src / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (src / "b.csv").write_text("name,id\nz,3\n")
    assert copy_into(spark, table, str(src)) == 2
    assert sorted((r["id"], r["name"]) for r in read_loaded(spark, table).collect()) == [(1, "x"), (2, "y"), (3, "z")]
    # The log of the load is lost, as if the job had died before writing it; meanwhile a file arrives.
    os.rename(table + "_load_log", str(tmp_path / "lost"))
    (src / "c.csv").write_text("id,name\n4,w\n")
    assert copy_into(spark, table, str(src)) == 3
    assert read_loaded(spark, table).count() == 4


def test_workbooks_by_their_own_header(spark, tmp_path):
    (tmp_path / "one.xlsx").write_bytes(xlsx([["name", "n"], ["a", 1]]))
    (tmp_path / "two.xlsx").write_bytes(xlsx([["n", "name"], [2, "b"]]))
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    assert sorted((r["name"], r["n"]) for r in read_excel(spark, str(tmp_path)).collect()) == [("a", 1), ("b", 2)]
    assert [os.path.basename(r["path"]) for r in unreadable_workbooks(spark, str(tmp_path)).collect()] == ["bad.xlsx"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parts=st.lists(st.sampled_from(["<p>", "</p>", "<br>", "<div>", "</div>", "<b>", "</b>", "<nav>", "</nav>", "<table>", "</table>", "<td>", "x1 ", "y2 ", "z3", "<h1>", "</h1>", "<footer>", "<a href=q>", "&amp;"]), max_size=14))
def test_all_visible_text_of_a_page_arrives(spark, parts):
    html = "".join(parts)
    got = spark.createDataFrame([(html,)], "h string").select(E.html_elements("h").alias("e")).first()["e"]
    joined = "".join(re.sub(r"<[^>]*>", "", e["content"]).replace("&amp;", "&") for e in got)
    visible = re.sub(r"<[^>]*>", "", html).replace("&amp;", "&")
    assert re.sub(r"\s", "", joined) == re.sub(r"\s", "", visible)


def test_html_text_after_breaks_and_outside_blocks(spark):
    html = "<p>line one<br>line two</p><div>loose text</div><blockquote>quoted</blockquote><p>last</p>tail"
    got = spark.createDataFrame([(html,)], "h string").select(E.html_elements("h").alias("e")).first()["e"]
    assert [e["content"] for e in got if e["content"]] == ["line one", "line two", "loose text", "quoted", "last", "tail"]


def test_changed_files_are_worked_through_in_groups(spark, tmp_path):
    src, tracking = tmp_path / "in", str(tmp_path / "tracking")
    src.mkdir()
    for i in range(9):
        (src / f"f{i}.txt").write_text(str(i))
    seen: list[tuple[int, list[str]]] = []

    def work(df, run):
        seen.append((run, sorted(os.path.basename(r["path"]) for r in df.collect())))
        if len(seen) == 2:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        flows.process_changed_files(spark, str(src), tracking, work, group_files=3)
    assert flows.process_changed_files(spark, str(src), tracking, work, group_files=3) == 9 - len(seen[0][1])
    assert seen[2][0] == seen[1][0] == 1
    assert sorted(f for run, fs in [seen[0], *seen[2:]] for f in fs) == [f"f{i}.txt" for i in range(9)]
    assert max(len(fs) for _, fs in seen) < 9
    assert flows.process_changed_files(spark, str(src), tracking, work) == 0


def test_page_count_follows_the_last_page_tree():
    page = b"%d 0 obj <</Type /Page>> endobj\n"
    first = b"%PDF-1.4\n1 0 obj <</Type /Catalog /Pages 2 0 R>> endobj\n2 0 obj <</Type /Pages /Count 2>> endobj\n" + page % 3 + page % 4
    saved = first + b"trailer <</Root 1 0 R>>\n%%EOF\n"
    again = saved + b"2 0 obj <</Type /Pages /Count 1>> endobj\n" + page % 3 + b"trailer <</Root 1 0 R>>\n%%EOF\n"
    assert count_pages(saved) == 2 and count_pages(again) == 1
    assert count_pages(b"%PDF-1.4\n" + page % 3 + b"%%EOF") == 1
