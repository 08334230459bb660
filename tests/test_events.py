from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docflow.functions.text import column_checksum
from docflow.operators import bronze
from docflow.streaming import flows


def event(ts, tid, **extra):
    return json.dumps({"event_ts": ts, "transaction_id": tid, "region": " eu ", "amount": "1.5", **extra})


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_bronze_stream_equals_batch_and_dedupes_across_runs(spark, tmp_path):
    src, out, cp = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "cp")
    one = [event("2024-01-01 10:00:00", "t1"), event("2024-01-01 10:00:00", "t1"), event("bad", "t2"), event("2024-01-01 11:00:00", None)]
    two = [event("2024-01-01 10:00:00", "t1"), event("2024-01-02 10:00:00", "t3", amount="n/a", colour="red")]
    drop(src, "a.json", *one)

    def run():
        stream = flows.stream_bronze_events(spark, str(src), max_files_per_trigger=1)
        flows.write_stream(stream, cp, path=out).awaitTermination()
        return spark.read.parquet(out)

    assert run().count() == 1
    drop(src, "b.json", *two)
    got = {r["transaction_id"]: r for r in run().collect()}
    assert set(got) == {"t1", "t3"}
    assert got["t1"]["region"] == "EU" and got["t1"]["amount"] == 1.5 and got["t1"]["_source_file"].endswith("a.json")
    assert got["t3"]["amount"] is None and got["t3"]["_rescued_data"] == {"colour": "red"}
    batch = bronze.bronze_events(spark.read.schema(bronze.event_schema()).json(str(src)))
    assert {(r["transaction_id"], r["_raw_checksum"]) for r in batch.collect()} == {(k, v["_raw_checksum"]) for k, v in got.items()}


def test_watermark_bounds_the_state(spark, tmp_path):
    src, out, cp = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "cp")
    drop(src, "a.json", event("2024-01-01 10:00:00", "t1"), event("2024-01-01 10:00:00", "t1"))
    stream = flows.stream_bronze_events(spark, str(src), watermark="1 hour")
    flows.write_stream(stream, cp, path=out).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_csv_stream_and_corrupt_files(spark, tmp_path):
    src, out, cp = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "cp")
    header = ",".join(bronze.EVENT_COLUMNS)
    drop(src, "a.csv", header, "2024-01-01 10:00:00,t1,c,m,eu,2,EUR,ok,web")
    flows.write_stream(flows.stream_bronze_events(spark, str(src), format="csv"), cp, path=out).awaitTermination()
    assert spark.read.parquet(out).first()["amount"] == 2.0
    good = tmp_path / "pq"
    spark.range(3).write.parquet(str(good))
    (good / "part-bad.parquet").write_bytes(b"PAR1 not really PAR1")
    assert spark.read.option("ignoreCorruptFiles", True).schema("id long").parquet(str(good)).count() == 3


def test_checksum_null_handling(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    cols = ["x", "y", "z"]
    assert df.select(column_checksum(cols).alias("c")).distinct().count() == 1
    assert df.select(column_checksum(cols, "~").alias("c")).distinct().count() == 2


def test_keep_first_is_repeatable(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (2, 1, "q")], "k int, t int, v string")
    assert {r["k"]: r["v"] for r in bronze.keep_first(df, ["k"], ["t"]).collect()} == {1: "z", 2: "q"}


def test_rows_per_source(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "_source_file string")
    assert [(r[0], r[1]) for r in bronze.rows_per_source(df, n=2).collect()] == [("c", 2), ("a", 1)]


def test_ingest_columns(spark):
    raw = spark.createDataFrame([("2024-01-01 10:00:00", "t")], "event_ts string, transaction_id string").selectExpr(
        "event_ts", "transaction_id", "'x' as region", "'1' as amount"
    )
    out = bronze.condition_events(raw, F.lit("f.json"))
    assert out.first()["_source_file"] == "f.json" and out.first()["_ingest_date"] is not None


def test_lines_that_do_not_fit_are_rescued(spark, tmp_path):
    from docflow.sources.rescue import CORRUPT, read_csv_rescued, read_json_rescued

    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "x.json").write_text('{"a":"1","c":"2"}\n{"a":\n{"a":"3","b":"4"}\n')
    rows = read_json_rescued(spark, str(tmp_path / "j"), schema).collect()
    assert [(r["a"], r["_rescued_data"]) for r in rows] == [("1", {"c": "2"}), (None, {CORRUPT: '{"a":'}), ("3", None)]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.csv").write_text("a,b\n1,2\n3,4,5\n")
    rows = read_csv_rescued(spark, str(tmp_path / "c"), schema).collect()
    assert [(r["a"], r["b"], r["_rescued_data"]) for r in rows] == [("1", "2", None), ("3", "4", {CORRUPT: "3,4,5"})]
