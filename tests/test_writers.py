"""Who wrote a batch: replays replace themselves, everything else is kept."""

from __future__ import annotations

import json

import pytest
from makers import docx
from pyspark.sql import functions as F

from docflow.plans import medallion
from docflow.sinks import bulk, tables
from docflow.streaming import flows

KV = "k int, ts int, v string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), KV)


def current(spark, root):
    return {r["k"]: r["v"] for r in tables.read_current(spark, root, ["k"], "ts", KV).collect()}


def test_an_equal_tag_of_another_writer_is_no_replay(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.write_changes(rows(spark, (1, 1, "a"), (2, 1, "b")), root, tag=0, writer="one") == 0
    assert tables.write_changes(rows(spark, (3, 1, "c")), root, tag=0, writer="two") == 1
    assert tables.write_changes(rows(spark, (4, 1, "d")), root, tag=0) == 2  # nobody's: always a batch of its own
    assert tables.write_changes(rows(spark, (5, 1, "e")), root, tag=0) == 3
    assert sorted(current(spark, root)) == [1, 2, 3, 4, 5]
    # A replay replaces its batch, also if others have written since.
    assert tables.write_changes(rows(spark, (1, 1, "again"), (2, 1, "b")), root, tag=0, writer="one") == 0
    assert current(spark, root)[1] == "again" and len(current(spark, root)) == 5
    assert tables.commits(spark, root)[:3] == [("batch", 0, "one", 0), ("batch", 1, "two", 0), ("batch", 2, None, 0)]


def test_a_writer_that_was_started_anew_is_fenced(spark, tmp_path):
    root = str(tmp_path / "t")
    first = tables.new_epoch(spark, root, "loader")
    tables.write_changes(rows(spark, (1, 1, "a")), root, tag=0, writer=first)
    second = tables.new_epoch(spark, root, "loader")
    assert (first, second) == ("loader@1", "loader@2")
    tables.write_changes(rows(spark, (2, 1, "b")), root, tag=0, writer=second)
    with pytest.raises(tables.StaleWriter):
        tables.write_changes(rows(spark, (3, 1, "c")), root, tag=1, writer=first)
    with pytest.raises(ValueError):
        tables.write_changes(rows(spark, (3, 1, "c")), root, tag=1, writer="a/b")
    tables.write_changes(rows(spark, (3, 1, "c")), root, tag=0, writer="other@1")
    assert current(spark, root) == {1: "a", 2: "b", 3: "c"}


def test_writers_that_took_one_number_both_count(spark, tmp_path):
    root = str(tmp_path / "t")
    # As after a race: both saw the empty table.
    rows(spark, (1, 1, "a"), (9, 1, "x")).write.parquet(f"{root}/batch={0:020d}-by=one-of=0")
    rows(spark, (2, 1, "b"), (9, 2, "y")).write.parquet(f"{root}/batch={0:020d}-by=two-of=0")
    assert current(spark, root) == {1: "a", 2: "b", 9: "y"}
    tables.compact(spark, root, ["k"], "ts", KV)
    tables.write_changes(rows(spark, (3, 1, "c")), root, tag=1, writer="one")
    assert current(spark, root) == {1: "a", 2: "b", 3: "c", 9: "y"}


def indexed(spark, *paths):
    df = spark.createDataFrame([(p, 1) for p in paths], "path string, n bigint")
    return bulk.index_documents(df, "docs", bulk.document_id("path"), {"path": "keyword", "n": "long"})


def ids(spark, root):
    return sorted(r["path"] for r in bulk.read_index(spark, root, "path string, n bigint").collect())


def test_index_batches_of_two_writers(spark, tmp_path):
    root = str(tmp_path / "i")
    bulk.publish(indexed(spark, "a", "b"), root, batch=0)
    bulk.publish(indexed(spark, "c"), root, batch=0)
    bulk.publish(indexed(spark, "d"), root, batch=0, writer="one")
    bulk.publish(indexed(spark, "e"), root, batch=0, writer="two")
    bulk.publish(indexed(spark, "d"), root, batch=0, writer="one")
    assert ids(spark, root) == ["a", "b", "c", "d", "e"]
    bulk.bulk_lines(indexed(spark, "e", "f")).write.text(f"{root}/batch={3:020d}-by=racer-of=7")
    assert ids(spark, root) == ["a", "b", "c", "d", "e", "f"]


def test_a_stream_that_starts_again_from_a_new_checkpoint(spark, tmp_path):
    root, index = str(tmp_path / "t"), str(tmp_path / "i")
    rows(spark, (1, 1, "a"), (2, 1, "b")).write.parquet(str(tmp_path / "s1"))
    # The source keeps only new files.
    rows(spark, (3, 1, "c")).write.parquet(str(tmp_path / "s2"))

    def run(start):
        stream = flows.stream_table(spark, str(tmp_path / f"s{start}"), lambda df: df, KV)
        flows.foreach_batch(stream, flows.upsert_batches(root, ["k"], "ts"), str(tmp_path / f"cp{start}")).awaitTermination()
        publish = bulk.batch_publisher(index, "docs", bulk.document_id(F.col("v")), {"v": "keyword"})
        flows.foreach_batch(stream, publish, str(tmp_path / f"cpi{start}")).awaitTermination()

    run(1)
    started = flows.checkpoint_writer(spark, str(tmp_path / "cp1"))
    assert tables.commits(spark, root) == [("batch", 0, started, 0)]
    run(2)  # exactly one batch was written before
    assert current(spark, root) == {1: "a", 2: "b", 3: "c"}
    assert sorted(r["v"] for r in bulk.read_index(spark, index, "v string").collect()) == ["a", "b", "c"]
    assert [c[3] for c in tables.commits(spark, root)] == [0, 0] and len({c[2] for c in tables.commits(spark, root)}) == 2


def test_a_stream_repeats_a_batch_that_broke_off(spark, tmp_path):
    src, root = str(tmp_path / "s"), str(tmp_path / "t")
    rows(spark, (1, 1, "a")).write.parquet(src)
    seen = []
    write = flows.upsert_batches(root, ["k"], "ts")

    def broken(df, batch, writer):
        write(df, batch, writer)
        seen.append(writer)
        if len(seen) == 1:
            raise RuntimeError("lost after the write, before the stream's commit")

    stream = flows.stream_table(spark, src, lambda df: df, KV)
    with pytest.raises(Exception, match="lost after the write"):
        flows.foreach_batch(stream, broken, str(tmp_path / "cp")).awaitTermination()
    flows.foreach_batch(stream, broken, str(tmp_path / "cp")).awaitTermination()
    assert len(seen) == 2 and len(set(seen)) == 1
    assert tables.commits(spark, root) == [("batch", 0, seen[0], 0)] and current(spark, root) == {1: "a"}


def test_stream_and_changed_run_on_one_root(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "root")
    inbox.mkdir()
    (inbox / "one.docx").write_bytes(docx("One", ["The one report and its text."]))
    medallion.run_changed(spark, str(inbox), root)
    (inbox / "two.docx").write_bytes(docx("Two", ["The two report and its text."]))
    medallion.run_stream(spark, str(inbox), root, max_files_per_trigger=10).awaitTermination()
    (inbox / "three.docx").write_bytes(docx("Three", ["The three report and its text."]))
    medallion.run_changed(spark, str(inbox), root)
    names = sorted(r["path"].rsplit("/", 1)[-1] for r in medallion.read_gold(spark, root).collect())
    assert names == ["one.docx", "three.docx", "two.docx"]
    found = {(r["run"], r["writer"]) for r in medallion.read_metrics(spark, root).select("run", "writer").distinct().collect()}
    writers = {w for _, w in found}
    assert len(found) == 3 and "run" in writers and len(writers) == 2 and {n for n, w in found if w == "run"} == {0, 1}
    lines = spark.read.text([f"{root}/index"], recursiveFileLookup=True).filter("value LIKE '%_id%'")
    assert {json.loads(r["value"])["index"]["_id"] for r in lines.collect() if r["value"].startswith('{"index"')} == {r["doc_key"] for r in medallion.read_gold(spark, root).collect()}
