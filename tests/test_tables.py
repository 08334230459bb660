from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.operators import changes
from docflow.sinks import bulk, tables
from docflow.streaming import flows


def test_overwrite_append_and_replace(spark):
    one = spark.createDataFrame([(1, "a")], "id int, name string")
    tables.save_table(one, "t1")
    tables.save_table(one.select("name", "id"), "t1", "append")
    assert spark.table("t1").count() == 2 and spark.table("t1").columns == ["id", "name"]
    tables.save_table(one.withColumn("more", F.lit(1)), "t1")
    assert spark.table("t1").columns == ["id", "name", "more"]
    tables.create_or_replace_as(spark, "t2", "SELECT id + 1 AS id FROM t1")
    tables.create_or_replace_as(spark, "t2", "SELECT 'x' AS other")
    assert spark.table("t2").first()["other"] == "x"


def test_union_with_empty_relation(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert df.unionByName(df.filter("false")).count() == 1


rows = st.dictionaries(st.integers(0, 6), st.tuples(st.integers(0, 9), st.text("ab", max_size=2)), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, source=rows)
def test_upsert_matches_a_dictionary_and_is_idempotent(spark, target, source):
    def frame(d):
        return spark.createDataFrame([(k, *v) for k, v in d.items()], "k int, ts int, v string")

    want = {**target, **{k: v for k, v in source.items() if k not in target or v[0] > target[k][0]}}
    once = changes.merge_upsert(frame(target), frame(source), ["k"], "ts").drop("action")
    twice = changes.merge_upsert(once, frame(source), ["k"], "ts").drop("action")
    assert {r["k"]: (r["ts"], r["v"]) for r in once.collect()} == want
    assert {r["k"]: (r["ts"], r["v"]) for r in twice.collect()} == want


def test_change_feed(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k int, v string")
    got = {r["k"]: r["change"] for r in changes.change_feed(before, after, ["k"]).collect()}
    assert got == {1: "delete", 2: "update", 4: "insert"}


def test_changed_and_as_of(spark):
    log = spark.createDataFrame([("a", 1, 10), ("a", 5, 11), ("b", 3, 12)], "path string, ts int, v int")
    assert {r["path"]: r["v"] for r in changes.as_of(log, ["path"], "ts", F.lit(4)).collect()} == {"a": 10, "b": 12}
    now = spark.createDataFrame([("a", 5), ("b", 3), ("c", 1)], "path string, modificationTime int")
    seen = spark.createDataFrame([("a", 4), ("b", 3)], "path string, last_processed int")
    assert {r["path"]: r["change"] for r in changes.changed_documents(now, seen).collect()} == {"a": "updated", "c": "new"}


def test_keyed_table_batches_and_compaction(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k int, ts int, v string"
    current = lambda **kw: {r["k"]: r["v"] for r in tables.read_current(spark, root, ["k"], "ts", schema, **kw).collect()}
    assert current() == {} and tables.last_batch(spark, root) == -1
    tables.write_changes(spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], schema), root, 0)
    tables.write_changes(spark.createDataFrame([(1, 6, "a2"), (2, 5, "tie"), (3, 1, "c")], schema), root, 1)
    assert current() == {1: "a2", 2: "b", 3: "c"} and current(upto=0) == {1: "a", 2: "b"}
    tables.compact(spark, root, ["k"], "ts", schema)
    assert tables.batches(spark, root) == [] and current() == {1: "a2", 2: "b", 3: "c"}
    tables.write_changes(spark.createDataFrame([(3, 0, "late"), (4, 1, "d")], schema), root, 2)
    assert current() == {1: "a2", 2: "b", 3: "c", 4: "d"}
    # A batch whose job did not commit does not exist for readers.
    (tmp_path / "t" / "batch=00000000000000000002" / "_SUCCESS").unlink()
    assert current() == {1: "a2", 2: "b", 3: "c"}


def docs(spark, *rows):
    df = spark.createDataFrame(list(rows), "path string, category string, key_topics array<string>, n bigint")
    mapping = {"path": "keyword", "category": "keyword", "key_topics": "keyword", "n": "long"}
    return bulk.index_documents(df, "docs", bulk.document_id("path"), mapping)


SCHEMA = "path string, category string, key_topics array<string>, n bigint"


def test_publish_upserts_and_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "index")
    first = docs(spark, ('a"\n{"index":{', "x", ["p", "q"], 1), ("b", None, None, 2))
    for batch in (0, 0, 1):
        bulk.publish(first, root, batch)
    got = {r["path"]: r for r in bulk.read_index(spark, root, SCHEMA).collect()}
    assert set(got) == {'a"\n{"index":{', "b"} and got['a"\n{"index":{']["key_topics"] == ["p", "q"]
    bulk.publish(docs(spark, ("b", "new", None, 3)), root)
    got = {r["path"]: r["category"] for r in bulk.read_index(spark, root, SCHEMA).collect()}
    assert got["b"] == "new" and len(got) == 2
    bulk.publish(docs(spark, ("c", "only", None, 4)), root, mode="overwrite")
    assert [r["path"] for r in bulk.read_index(spark, root, SCHEMA).collect()] == ["c"]


def test_round_trip_ten_rows_then_one_more(spark, tmp_path):
    root = str(tmp_path / "people")
    people = spark.createDataFrame([(f"p{i}", None if i == 4 else 20 + i) for i in range(10)], "name string, age bigint")
    index = lambda df: bulk.index_documents(df, "people", bulk.document_id("name"), {"name": "keyword", "age": "long"})
    bulk.publish(index(people), root)
    assert bulk.read_index(spark, root, "name string, age bigint").filter("age is null").count() == 1
    bulk.publish(index(spark.createDataFrame([("p10", 30)], "name string, age bigint")), root)
    back = bulk.read_index(spark, root, "name string, age bigint")
    assert back.count() == 11
    tables.save_table(back, "people_back")
    assert spark.table("people_back").count() == 11


def test_document_without_id_is_refused(spark, tmp_path):
    bad = docs(spark, (None, "x", None, 1))
    with pytest.raises(Exception, match="document without id"):
        bulk.publish(bad, str(tmp_path / "i"))


def test_send_bulk_counts(spark):
    def connect():
        def send(index, pairs):
            return sum(1 for _, source in pairs if '"n":3' in source)

        return send

    sent = bulk.send_bulk(docs(spark, *[(f"d{i}", "c", None, i) for i in range(7)]), connect, size=2).collect()
    assert [(r["index"], r["ok"], r["errors"]) for r in sent] == [("docs", 6, 1)]


def test_json_or_text(spark):
    df = spark.createDataFrame([('["a"]',), ("plain text",), (None,)], "s string").select(F.to_json(bulk.json_or_text("s")).alias("j"))
    assert [r["j"] for r in df.collect()][:2] == ['["a"]', '"plain text"']


def test_stream_to_index_and_upserted_table(spark, tmp_path):
    src, index, gold = str(tmp_path / "silver"), str(tmp_path / "index"), str(tmp_path / "gold")
    schema = "path string, category string, v bigint"

    def add(*rows):
        spark.createDataFrame(list(rows), schema).write.mode("append").parquet(src)

    def run():
        stream = flows.stream_table(spark, src, lambda df: df, schema)
        publish = bulk.batch_publisher(index, "docs", bulk.document_id("path"), {"path": "keyword", "category": "keyword"})
        flows.foreach_batch(stream, publish, str(tmp_path / "cp1")).awaitTermination()
        upsert = flows.upsert_batches(gold, ["path"], "v")
        flows.foreach_batch(stream, upsert, str(tmp_path / "cp2")).awaitTermination()

    add(("a", "x", 1), ("b", "x", 1))
    run()
    add(("a", "y", 2), ("b", "old", 0), ("c", "z", 1))
    run()
    run()
    state = lambda: {r["path"]: r["category"] for r in tables.read_current(spark, gold, ["path"], "v", schema).collect()}
    got = state()
    assert got == {"a": "y", "b": "x", "c": "z"}
    assert bulk.read_index(spark, index, "path string, category string").count() == 3
    # A replayed batch replaces itself.
    replay = flows.upsert_batches(gold, ["path"], "v")
    replay(spark.createDataFrame([("a", "y", 2), ("b", "old", 0), ("c", "z", 1)], schema), 1)
    assert state() == got


def test_append_flows(spark, tmp_path):
    sources = {}
    for kind, columns in {"site": "id int, url string", "mail": "id int, sender string"}.items():
        path = str(tmp_path / kind)
        spark.createDataFrame([(1, kind)], columns).write.parquet(path)
        sources[kind] = flows.stream_table(spark, path, lambda df: df, columns)
    for q in flows.append_flows(sources, str(tmp_path / "all"), str(tmp_path / "cps")):
        q.awaitTermination()
    both = spark.read.option("mergeSchema", True).parquet(str(tmp_path / "all"))
    assert {r["source_kind"]: (r["url"], r["sender"]) for r in both.collect()} == {"site": ("site", None), "mail": (None, "mail")}
    assert flows.active_queries(spark) == []


def test_append_with_a_new_column(spark):
    one = spark.createDataFrame([(1,)], "id int")
    tables.save_table(one, "grow")
    more = spark.createDataFrame([("x", 2)], "extra string, id int")
    with pytest.raises(ValueError, match="extra"):
        tables.save_table(more, "grow", "append")
    tables.save_table(more, "grow", "append", merge_schema=True)
    assert sorted(map(tuple, spark.table("grow").collect())) == [(1, None), (2, "x")]
    tables.save_table(one, "grow", "append")
    assert spark.table("grow").count() == 3


def test_stream_that_starts_again_after_compaction(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k int, ts int, v string"
    write = flows.upsert_batches(root, ["k"], "ts")
    write(spark.createDataFrame([(1, 5, "a")], schema), 0)
    write(spark.createDataFrame([(2, 5, "b")], schema), 1)
    tables.compact(spark, root, ["k"], "ts", schema)
    write(spark.createDataFrame([(1, 9, "new"), (2, 1, "old")], schema), 0)
    assert {r["k"]: r["v"] for r in tables.read_current(spark, root, ["k"], "ts", schema).collect()} == {1: "new", 2: "b"}


def test_change_below_a_millisecond(spark):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00.123456"), (2, "2024-01-01 00:00:00.5")], "k int, t string")
    before = rows.select("k", F.col("t").cast("timestamp").alias("t"))
    after = before.withColumn("t", F.when(F.col("k") == 1, F.lit("2024-01-01 00:00:00.123999").cast("timestamp")).otherwise(F.col("t")))
    assert [tuple(r) for r in changes.change_feed(before, after, ["k"]).collect()] == [(1, "update")]


def test_derived_table_sees_all_rows_of_a_touched_key(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "doc string, pos int, part string")
    join = lambda df: df.groupBy("doc").agg(F.max("pos").alias("v"), F.concat_ws("", F.sort_array(F.collect_list("part"))).alias("text"))
    write = flows.upsert_batches(str(tmp_path / "d"), ["doc"], "v", join, rows=rows, by=["doc"])
    write(rows.filter("pos = 2"), 0)
    got = tables.read_current(spark, str(tmp_path / "d"), ["doc"], "v", "doc string, v int, text string").collect()
    assert [tuple(r) for r in got] == [("a", 2, "xy")]


def test_overwritten_index_hides_older_batches_at_once(spark, tmp_path):
    root = str(tmp_path / "i")
    bulk.publish(docs(spark, ("a", "x", None, 1), ("b", "x", None, 1)), root, 0)
    bulk.publish(docs(spark, ("a", "y", None, 2)), root, mode="overwrite")
    # As after a crash before the old batch is removed.
    bulk.bulk_lines(docs(spark, ("b", "x", None, 1))).write.text(f"{root}/batch={0:020d}-of=0")
    bulk.publish(docs(spark, ("c", "z", None, 3)), root, 1)
    got = {r["path"]: r["category"] for r in bulk.read_index(spark, root, SCHEMA).collect()}
    assert got == {"a": "y", "c": "z"}


def test_stream_with_a_new_column(spark, tmp_path):
    src, cp = str(tmp_path / "src"), str(tmp_path / "cp")
    stream = lambda schema: flows.stream_table(spark, src, lambda df: df, schema)
    spark.createDataFrame([(1,)], "id int").write.parquet(src)
    flows.write_stream(stream("id int"), cp, table="grown").awaitTermination()
    spark.createDataFrame([(2, "x")], "id int, extra string").write.mode("append").parquet(src)
    with pytest.raises(ValueError, match="extra"):
        flows.write_stream(stream("id int, extra string"), cp, table="grown")
    flows.write_stream(stream("id int, extra string"), cp, table="grown", merge_schema=True).awaitTermination()
    assert sorted(map(tuple, spark.table("grown").collect())) == [(1, None), (2, "x")]


def test_routes_without_a_strategy_are_refused(spark):
    from docflow.operators import routing

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, route string")
    work = {"a": lambda d: d.withColumn("x", F.lit(1)), "b": lambda d: d.withColumn("y", F.lit(2))}
    assert sorted(map(tuple, routing.process_by_route(df, work).select("id", "x", "y").collect())) == [(1, 1, None), (2, None, 2)]
    with pytest.raises(Exception, match="no strategy for route b"):
        routing.process_by_route(df, {"a": work["a"]}).collect()
