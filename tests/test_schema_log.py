"""CSV by name, and schemas that grow."""

from __future__ import annotations

import pytest
from pyspark.sql.types import StructType

from docflow.sources import schema_log
from docflow.sources.rescue import CORRUPT, read_csv_rescued, read_json_rescued
from docflow.streaming import flows

AB = StructType().add("a", "string").add("b", "integer")


def got(df):
    return sorted((r["a"], r["b"], r["_rescued_data"]) for r in df.collect())


def fill(folder):
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\nA1,1\n\n\"A,\"\"2\",2\n\"A\n3\",3\n")
    (folder / "2.csv").write_text("\ufeffb,extra,A\n4,x,A4\n5,,A5\n")
    (folder / "3.csv").write_text("a\nA6\n")
    (folder / "4.csv").write_text("a,b,b\nA7,seven,9\nA8,8\nA9,9,9,9\n")
    (folder / "5.csv").write_text("")
    (folder / "6.csv").write_text("b,a\n")


WANT = sorted(
    [
        ("A1", 1, None),
        ('A,"2', 2, None),
        ("A\n3", 3, None),
        ("A4", 4, {"extra": "x"}),
        ("A5", 5, None),
        ("A6", None, None),
        ("A7", None, {"b": "seven", "b#2": "9"}),
        ("A8", 8, {CORRUPT: "A8,8"}),
        ("A9", 9, {"b#2": "9", CORRUPT: "A9,9,9,9"}),
    ],
    key=str,
)


def test_csv_lands_by_name_in_batch_and_stream(spark, tmp_path):
    fill(tmp_path / "in")
    assert sorted(((r["a"], r["b"], r["_rescued_data"]) for r in read_csv_rescued(spark, str(tmp_path / "in"), AB).collect()), key=str) == WANT
    seen = []
    stream = read_csv_rescued(spark, str(tmp_path / "in"), AB, stream=True, max_files_per_trigger=2)
    flows.foreach_batch(stream, lambda df, batch: seen.extend(df.collect()), str(tmp_path / "cp")).awaitTermination()
    assert sorted(((r["a"], r["b"], r["_rescued_data"]) for r in seen), key=str) == WANT
    assert {r["_source_file"].rsplit("/", 1)[-1] for r in seen} == {"1.csv", "2.csv", "3.csv", "4.csv"}


def test_long_files_keep_their_header_over_many_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, header in enumerate(("a,b", "b,a")):
        lines = [f"x{i},{i}" if k == 0 else f"{i},x{i}" for i in range(30_000)]
        (tmp_path / "in" / f"{k}.csv").write_text("\n".join([header, *lines]) + "\n")
    df = read_csv_rescued(spark, str(tmp_path / "in"), AB)
    assert df.filter("a = concat('x', b) AND _rescued_data IS NULL").count() == df.count() == 60_000


def test_a_stray_quote_takes_no_line_along(spark, tmp_path):
    (tmp_path / "in").mkdir()
    many = "".join(f"y{i},{i}\n" for i in range(3000))
    (tmp_path / "in" / "1.csv").write_text('a,b\n5" pipe,1\nA2,2\n' + many)
    (tmp_path / "in" / "2.csv").write_text('a,b\nA3,3\n6" pipe,4\nA5,5\n')
    rows = {r["b"]: r["a"] for r in read_csv_rescued(spark, str(tmp_path / "in"), AB).filter("a NOT LIKE 'y%'").collect()}
    assert rows == {1: '5" pipe', 2: "A2", 3: "A3", 4: '6" pipe', 5: "A5"}
    assert read_csv_rescued(spark, str(tmp_path / "in"), AB).count() == 3005


@pytest.mark.parametrize("mode", schema_log.MODES)
def test_new_columns_in_a_stream(spark, tmp_path, mode):
    src, log, rows = tmp_path / "in", str(tmp_path / "log"), []
    src.mkdir()
    (src / "1.csv").write_text("a,b\nA1,1\n")

    def run():
        write = schema_log.evolving(lambda df, batch, writer: rows.extend(r.asDict() for r in df.collect()), log, AB, mode)
        stream = read_csv_rescued(spark, str(src), AB, stream=True)
        flows.foreach_batch(stream, write, str(tmp_path / "cp")).awaitTermination()

    run()
    (src / "2.csv").write_text("c,b,a\nC2,2,A2\n")
    if mode == "stop":
        with pytest.raises(Exception, match="new columns"):
            run()
        assert [r["a"] for r in rows] == ["A1"]
    run()
    last = {k: rows[-1].get(k, "no column") for k in ("a", "b", "c", "_rescued_data")}
    if mode == "rescue":
        assert last == {"a": "A2", "b": 2, "c": "no column", "_rescued_data": {"c": "C2"}}
        assert [s.names for s in schema_log.versions(spark, log).values()] == [["a", "b"]]
    else:
        assert last == {"a": "A2", "b": 2, "c": "C2", "_rescued_data": None}
        assert [schema_log.versions(spark, log)[v].names for v in (0, 1)] == [["a", "b"], ["a", "b", "c"]]
    assert len(rows) == 2


def test_json_grows_by_the_same_log(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"a": "x", "b": 1, "d": 2}\n')
    schema_log.current_schema(spark, str(tmp_path / "log"), AB)
    batch = read_json_rescued(spark, str(tmp_path / "in"), AB)
    assert schema_log.unknown_columns(batch) == ["d"]
    grown = schema_log.add_columns(spark, str(tmp_path / "log"), StructType().add("d", "integer").fields)
    row = schema_log.with_columns(batch, grown).first()
    assert (row["a"], row["b"], row["d"], row["_rescued_data"]) == ("x", 1, 2, None)
    assert schema_log.current_schema(spark, str(tmp_path / "log"), AB) == grown
