from __future__ import annotations

import os
import time

from makers import docx, pdf, pptx

from docflow.plans import medallion
from docflow.sinks.bulk import read_index

INDEX = "path string, title string, category string, file_type string, full_text string, key_topics array<string>"


def deck(n):
    return pptx([(f"Slide {i}", f"body {i}") for i in range(1, n + 1)])


def test_changed_files_end_to_end(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "root")
    (src / "x").mkdir(parents=True)
    (src / "a.docx").write_bytes(docx("Budget plan", ["Company: Acme", "The revenue and profit of the year. Margin is fine."]))
    (src / "x" / "a.docx").write_bytes(docx("Contract", ["This agreement binds each party."]))
    (src / "deck.pptx").write_bytes(deck(7))
    (src / "scan.pdf").write_bytes(pdf(2))
    (src / "empty.docx").write_bytes(b"")
    assert medallion.run_changed(spark, str(src), root, limit=3) == 4
    gold = {r["path"].split("/src/")[1]: r for r in medallion.read_gold(spark, root).collect()}
    assert set(gold) == {"a.docx", "x/a.docx", "deck.pptx"}
    assert gold["a.docx"]["category"] == "financial" and gold["a.docx"]["company"] == "Acme"
    assert gold["x/a.docx"]["category"] == "legal" and gold["a.docx"]["doc_key"] != gold["x/a.docx"]["doc_key"]
    assert [w for w in gold["deck.pptx"]["full_text"].split() if w.isdigit()] == [str(i) for i in range(1, 8) for _ in (0, 1)]
    metrics = {(r["stage"], r["rule"]): r for r in medallion.read_metrics(spark, root).collect()}
    assert metrics[("parsed", "no_error")]["failed"] == 1
    quarantined = spark.read.parquet(f"{root}/runs/*/02_quarantine").first()
    assert quarantined["fileName"] == "scan.pdf" and "no parser" in quarantined["parse_error"]

    assert medallion.run_changed(spark, str(src), root, limit=3) == 0
    (src / "a.docx").write_bytes(docx("New title", ["nothing special here"]))
    os.utime(src / "a.docx", (time.time() + 10, time.time() + 10))
    assert medallion.run_changed(spark, str(src), root, limit=3) == 1
    gold = {r["path"].split("/src/")[1]: r for r in medallion.read_gold(spark, root).collect()}
    assert len(gold) == 3 and gold["a.docx"]["title"].startswith("New title") and gold["a.docx"]["category"] == "other"
    index = {r["path"].split("/src/")[1]: r for r in read_index(spark, f"{root}/index", INDEX).collect()}
    assert len(index) == 3 and index["a.docx"]["category"] == "other" and index["deck.pptx"]["file_type"] == "pptx"
    medallion.rebuild_index(spark, root)
    assert {r["path"] for r in read_index(spark, f"{root}/index", INDEX).collect()} == {r["path"] for r in gold.values()}
    (src / "late.docx").write_bytes(docx("Late", ["one more file"]))
    assert medallion.run_changed(spark, str(src), root, limit=3) == 1
    assert read_index(spark, f"{root}/index", INDEX).count() == medallion.read_gold(spark, root).count() == 4
    metrics = {(r["run"], r["stage"], r["rule"]): (r["total"], r["failed"]) for r in medallion.read_metrics(spark, root).collect()}
    assert metrics[(0, "files", "valid_size")] == (4, 0)
    stages = {(r["run"], r["stage"]): r for r in medallion.read_stages(spark, root).collect()}
    assert stages[(0, "parsed")]["errors"] == 1 and all(r["ended_at"] >= r["started_at"] for r in stages.values())
    assert medallion.slowest_stages(spark, root, 3).count() == 3


def test_stream_end_to_end(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "root")
    src.mkdir()
    (src / "a.docx").write_bytes(docx("One", ["text"]))
    medallion.run_stream(spark, str(src), root).awaitTermination()
    (src / "b.pptx").write_bytes(deck(2))
    medallion.run_stream(spark, str(src), root).awaitTermination()
    medallion.run_stream(spark, str(src), root).awaitTermination()
    assert medallion.read_gold(spark, root).count() == 2
    assert read_index(spark, f"{root}/index", INDEX).count() == 2


def test_chain_with_a_summary_length_per_category(spark, tmp_path):
    rows = [(1, "The revenue of 2024 was 100. It grew."), (2, "Plain words here. And more words there."), (3, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    steps = medallion.run_chain(df, str(tmp_path), {"financial": ["revenue"]}, {"financial": "[0-9]+"}, "[A-Z][a-z]+", {"financial": 2})
    entities = {r["doc_id"]: r["entities"] for r in spark.read.parquet(str(tmp_path / "entities")).collect()}
    assert entities == {1: ["2024", "100"], 2: ["Plain", "And"], 3: None}
    summaries = {r["doc_id"]: (r["category"], r["summary_words"]) for r in steps["summaries"].collect()}
    assert summaries == {1: ("financial", 2), 2: ("other", 7)}


def test_declared_datasets(spark, tmp_path):
    df = spark.range(3)
    medallion.declare(df, "v_docs")
    medallion.declare(df, "m_docs", "materialized")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    medallion.declare(stream, "s_docs", "streaming", str(tmp_path / "cp")).awaitTermination()
    assert [spark.table(t).count() for t in ("v_docs", "m_docs", "s_docs")] == [3, 3, 3]
    assert spark.readStream.table("s_docs").isStreaming
