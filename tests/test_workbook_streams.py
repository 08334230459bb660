"""Workbooks as a stream, and headers with equal cells."""

from __future__ import annotations

import pytest
from makers import xlsx

from docflow.sources.files import read_files
from docflow.sources.rescue import CORRUPT
from docflow.sources.spreadsheet import read_excel
from docflow.streaming import flows


def test_two_equal_header_cells_are_named_apart(spark, tmp_path):
    (tmp_path / "one.xlsx").write_bytes(xlsx([["a", "a", "b"], ["x", "y", 1]]))
    (tmp_path / "two.xlsx").write_bytes(xlsx([["b", "a"], [2, "z"]]))
    got = read_excel(spark, str(tmp_path))
    assert sorted((r["a"], r["a#2"], r["b"]) for r in got.collect()) == [("x", "y", 1), ("z", None, 2)]


def test_workbooks_stream_by_name(spark, tmp_path):
    src, seen = tmp_path / "in", []
    src.mkdir()
    (src / "one.xlsx").write_bytes(xlsx([["name", "n", "name"], ["a", 1, "again"], ["b", "two", "more"]]))
    (src / "bad.xlsx").write_bytes(b"no zip")

    def run():
        stream = read_files(spark, str(src), format="excel", schema="name string, n bigint", stream=True, max_files_per_trigger=1)
        assert stream.isStreaming
        flows.foreach_batch(stream, lambda df, batch: seen.extend(df.collect()), str(tmp_path / "cp")).awaitTermination()
        return {(r["name"], r["n"], tuple(sorted(r["_rescued_data"].items())) if r["_rescued_data"] else None) for r in seen}

    first = run()
    assert {x for x in first if x[0]} == {("a", 1, (("name#2", "again"),)), ("b", None, (("n", "two"), ("name#2", "more")))}
    assert [x[2][0][0] for x in first if not x[0]] == [CORRUPT] and len(seen) == 3
    # Only new files, by their own header; a file that was read is not read again.
    (src / "two.xlsx").write_bytes(xlsx([["n", "extra", "name"], [3, "e", "c"]]))
    assert run() - first == {("c", 3, (("extra", "e"),))} and len(seen) == 4
    with pytest.raises(ValueError, match="schema"):
        read_files(spark, str(src), format="excel", stream=True)
