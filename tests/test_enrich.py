from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflow.functions import text as T
from docflow.functions.sql import register_functions
from docflow.operators import enrich, model, quality, search, similarity


def test_model_errors_stay_in_the_row_and_equal_prompts_are_called_once(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def connect():
        def call(prompt):
            import uuid

            (log / uuid.uuid4().hex).write_text(prompt)
            if prompt == "bad":
                raise ValueError("no")
            return '{"n": %d}' % len(prompt) if prompt != "odd" else "not json"

        return call

    rows = [(i, "same") for i in range(50)] + [(50, "bad"), (51, None), (52, "odd")]
    out = model.model_enrich(spark.createDataFrame(rows, "id int, p string"), "p", connect, schema="n int")
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == 53 and got[7]["result"]["n"] == 4 and got[7]["error_message"] is None
    assert got[50]["error_message"] == "ValueError: no" and "no prompt" in got[51]["error_message"]
    assert got[52]["result"] is None and got[52]["error_message"]
    assert sorted(p.read_text() for p in log.iterdir()) == ["bad", "odd", "same"]


def test_model_can_fail_the_job_and_truncates(spark):
    def connect():
        def call(prompt):
            if prompt == "bad":
                raise ValueError("stop here")
            return prompt

        return call

    df = spark.createDataFrame([("abcdef",)], "p string")
    assert model.model_enrich(df, "p", connect, max_chars=3).first()["result"] == "abc"
    assert model.model_enrich(df, "p", connect, dedupe=False).first()["result"] == "abcdef"
    with pytest.raises(Exception, match="stop here"):
        model.model_enrich(spark.createDataFrame([("bad",)], "p string"), "p", connect, fail_on_error=True).collect()


def test_model_over_files(spark):
    def connect():
        def call(prompt, content):
            if not bytes(content).startswith(b"\x89PNG"):
                raise ValueError("no image")
            return f"{prompt}: {len(content)} bytes"

        return call

    df = spark.createDataFrame([("a.png", b"\x89PNG12"), ("b.png", b"x")], "path string, content binary")
    got = {r["path"]: r for r in model.model_enrich(df, F.lit("describe"), connect, files_col="content").collect()}
    assert got["a.png"]["result"] == "describe: 6 bytes" and got["b.png"]["error_message"] == "ValueError: no image"
    assert got["a.png"].asDict().keys() == {"path", "result", "error_message"}


def test_prompt_template(spark):
    df = spark.createDataFrame([("hello", "fr")], "t string, l string")
    assert df.select(model.prompt("Translate to {lang}: {text}", lang="l", text="t").alias("p")).first()["p"] == "Translate to fr: hello"


def test_translation_skips_rows_in_the_target_language(spark):
    def connect():
        return lambda p: "-> " + p.rsplit(": ", 1)[1]

    df = spark.createDataFrame([("bonjour", "fr"), ("hello", "en"), ("hm", None)], "t string, l string")
    got = {r["t"]: r["result"] for r in model.translate(df, "t", "l", "en", connect).collect()}
    assert got == {"bonjour": "-> bonjour", "hello": "hello", "hm": "-> hm"}


def test_default_classifier_and_response(spark):
    rows = [("The revenue and profit margin",), ("nothing",), (None,), ("agreement: party to the contract",)]
    df = spark.createDataFrame(rows, "t string")
    assert [r["l"] for r in df.select(enrich.classify("t")["label"].alias("l")).collect()] == ["financial", "other", None, "legal"]
    made = df.select(enrich.classification_response(F.lit("x"), F.when(F.col("t").isNull(), "no text")).alias("r"))
    label, error = enrich.response_label("r")
    assert [(r[0], r[1]) for r in made.select(label, error).collect()][1:3] == [("x", None), (None, "no text")]
    odd = spark.createDataFrame([("oops",)], "r string")
    assert odd.select(*enrich.response_label("r")).first()[1] == "malformed response"


def test_extract_and_topics(spark):
    text = "Annual plan\nCompany: Acme Ltd\nAuthor: A. Writer\nDate 2024-05-06\nKeywords: one, two,three"
    df = spark.createDataFrame([(text,), ("",)], "t string").select(enrich.extract("t").alias("e"))
    rows = [r["e"] for r in df.collect()]
    assert rows[0]["company"]["value"] == "Acme Ltd" and rows[0]["company"]["offset"] == text.index("Acme") + 1
    assert rows[0]["date"]["value"] == "2024-05-06" and rows[0]["product"] is None and rows[1]["title"] is None
    topics = spark.createDataFrame([("a, b,c",), (None,)], "t string").select(enrich.topic_list("t").alias("x"))
    assert [r["x"] for r in topics.collect()] == [["a", "b", "c"], None]


def test_sql_functions(spark):
    names = register_functions(spark)
    assert "extract_document" in names
    row = spark.sql(
        "SELECT classify_document('revenue and profit') AS c, extract_document('T\nKeywords: x, y').key_topics AS k, "
        "summarize_document('One two three. Four.', max_words => 2) AS s, chunk_page_ranges(750) AS r, pig_latin('pig eat') AS p"
    ).first()
    assert (row["c"], row["k"], row["s"], row["r"], row["p"]) == ("financial", ["x", "y"], "One two", ["1-500", "501-750"], "igpay eatway")


def test_summary_keeps_a_long_only_sentence_within_the_limit(spark):
    df = spark.createDataFrame([(1, "word " * 20), (2, "a b. a a a. c.")], "doc_id int, text string")
    got = {r["doc_id"]: r for r in enrich.summarize(df, max_words=5).collect()}
    assert len(got[1]["summary"].split()) == 5 and got[2]["summary"] == "a b. a a a."


def test_train_and_embed(spark):
    rows = [("good fine nice", 1.0), ("bad awful poor", 0.0)] * 5
    df = spark.createDataFrame(rows, "text string, label double")
    fitted = model.train_label_model(df)
    assert fitted.transform(spark.createDataFrame([("fine nice",)], "text string")).first()["prediction"] == 1.0
    with_id = spark.createDataFrame([(1, "a b a"), (2, "c"), (3, None)], "doc_id int, text string")
    got = {r["doc_id"]: r["embedding"] for r in model.embed_text(with_id, features=16).collect()}
    assert [len(v) for v in got.values()] == [16] * 3 and sum(x > 0 for x in got[1]) == 2 and not any(got[3])
    labels = model.label_by_words(with_id, spark.createDataFrame([("a b", 1), ("c d", 0), ("c", 0)], "text string, quality int"), label="quality")
    assert {r["doc_id"]: r["quality"] for r in labels.collect()} == {1: 1, 2: 0, 3: 0}


def test_knn_matches_brute_force_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(3)
    data, asked = rng.normal(size=(200, 6)), rng.normal(size=(11, 6))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>").repartition(5)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "q bigint, v array<double>")
    got = {}
    for r in search.knn_cosine(corpus, queries, "q", "v", k=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    sims = (asked / np.linalg.norm(asked, axis=1, keepdims=True)) @ (data / np.linalg.norm(data, axis=1, keepdims=True)).T
    for q in range(11):
        assert [v for _, v in sorted(got[q])] == list(np.argsort(-sims[q])[:4])


def brute_jaccard(a: str, b: str) -> float:
    grams = lambda s: {" ".join(w[i : i + 3]) for w in [s.split()] for i in range(max(len(w) - 2, 1))}
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y)


def test_near_duplicates_of_a_hot_group(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    texts = {}
    for i in range(60):
        texts[i] = " ".join(base)
    for i in range(60, 90):
        near = list(base)
        near[rng.randrange(120)] = word()
        texts[i] = " ".join(near)
    for i in range(90, 180):
        texts[i] = " ".join(word() for _ in range(80))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in similarity.near_duplicates(df).collect()}
    assert set(got) == set(range(1, 90))
    assert all(got[i]["duplicate_of"] == 0 and got[i]["similarity"] == 1.0 for i in range(1, 60))
    for i in range(60, 90):
        assert got[i]["similarity"] == pytest.approx(brute_jaccard(texts[i], texts[got[i]["duplicate_of"]]), abs=1e-6)
    pairs = [(a, b) for a, b in itertools.combinations(range(90, 180), 2) if brute_jaccard(texts[a], texts[b]) >= 0.8]
    assert pairs == []


def lowest_alike(texts: dict[int, str], threshold: float) -> dict[int, int]:
    def grams(t):
        w = t.split()
        return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))}

    sets, links = {k: grams(t) for k, t in texts.items()}, {}
    for b in sorted(texts):
        for a in sorted(texts):
            if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[b] = a
                break
    return links


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shared, texts = [word() for _ in range(60)], {}
    for family in range(6):
        own = [word() for _ in range(25)]
        for i in range(9):
            tail = list(own)
            for _ in range(i % 4):
                tail[rng.randrange(25)] = word()
            texts[i * 6 + family] = " ".join(shared + tail)
    texts |= {100: "", 101: "a", 102: "a b", 103: texts[7], 104: " ".join(texts[8].split()[::-1])}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for threshold in (0.8, 0.9):
        want = lowest_alike(texts, threshold) | {103: 7}  # an exact copy links to its own kind
        got = {r["doc_id"]: r["duplicate_of"] for r in similarity.near_duplicates(df, threshold=threshold).collect()}
        assert got == want and len(set(want.values())) > 1


def test_near_duplicates_take_the_same_jobs_whatever_the_data(spark, monkeypatch):
    stored = []
    real = similarity.materialise
    monkeypatch.setattr(similarity, "materialise", lambda df, path: (stored.append(path), real(df, path))[1])

    def links(texts):
        stored.clear()
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        return similarity.near_duplicates(df).count(), len(stored)

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    block = " ".join(word() for _ in range(100))
    unlike = [block + " " + " ".join(word() for _ in range(25)) for _ in range(400)]
    assert links(unlike) == (0, 5)
    base = [word() for _ in range(150)]
    alike = [" ".join([*base[:-2], word(), word()]) for _ in range(1500)]
    assert links(alike) == (1499, 5)


def test_text_similarity(spark):
    df = spark.createDataFrame([("a b c", "B c d"), ("", "")], "x string, y string").select(T.text_similarity("x", "y").alias("s"))
    assert [r["s"] for r in df.collect()] == [0.5, None]


def test_bm25_with_filter(spark):
    df = spark.createDataFrame([(1, "cat cat dog", "en"), (2, "dog", "en"), (3, "cat", "fr"), (4, "the", "en")], "doc_id int, text string, lang string")
    hits = search.search_bm25(df, {"q": ["cat", "dog"]}, where=F.col("lang") == "en").orderBy("rank").collect()
    assert [r["doc_id"] for r in hits] == [1, 2] and hits[0]["score"] > hits[1]["score"]


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (200, "c")], "n int, s string")
    rules = {"small": "n < 100", "named": "s IS NOT NULL"}
    kept, seen = quality.expect(df, rules, "stage1")
    assert kept.count() == 3
    assert seen.get == {"total": 3, "small": 2, "named": 0}
    assert quality.expect_or_drop(df, rules).count() == 1
    with pytest.raises(Exception, match="expectation failed: small"):
        quality.expect_or_fail(df, rules).collect()
    good, bad = quality.quarantine(df, rules)
    assert good.count() == 1 and [r["failed_rules"] for r in bad.collect()] == [["small"], ["small"]]


def test_one_key_with_a_third_of_the_rows(spark):
    """Results stay whole when one key, text or word holds a third of all rows."""
    from docflow.operators import changes

    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "hot words here again").otherwise(F.concat(F.lit("text hot "), F.translate(F.hex("id"), "0123456789", "ghijklmnop"))).alias("text"),
    )
    newest = changes.latest_version(df, ["user_id"], ["doc_id"])
    assert newest.count() == 1 + n - n // 3
    assert newest.filter("user_id = 0").first()["doc_id"] == 2997
    assert changes.dedup_documents(df, T.normalised("text")).agg(F.sum("copies"), F.max("copies")).first()[0:2] == (n, n // 3)
    topics = enrich.key_topics(df, n=2)
    assert topics.select("doc_id").distinct().count() == n
    stats = {r["term"]: r for r in search.inverted_index(search.postings(df, stop_words=[])).filter("term IN ('hot', 'again')").collect()}
    assert stats["hot"]["df"] == n and stats["again"]["df"] == n // 3
    assert enrich.summarize(df).count() == n

    def connect():
        return lambda p: p[:3]

    assert model.model_enrich(df.select("doc_id", "text"), "text", connect).filter("result = 'hot'").count() == n // 3
    links = similarity.near_duplicates(df.filter("doc_id % 3 = 0"))
    assert links.count() == n // 3 - 1 and links.select("duplicate_of").distinct().count() == 1


def test_rare_terms_alone_are_joined_by_term(spark, monkeypatch):
    """Frequent terms beyond a document's best stay in their partition, whatever the length of the list; results do not change."""
    r = random.Random(4)
    words = ["".join(r.choices("abcdefghij", k=4)) for _ in range(300)]
    rows = [(i, " ".join(r.choices(words, weights=[1 / (k + 1) for k in range(300)], k=120)) + f" only{'abcdefghij'[i % 10] * 3}") for i in range(60)]
    df = spark.createDataFrame([*rows, (7, "abcd more"), (99, ""), (98, None), (None, "abcd")], "doc_id bigint, text string")
    got = {}
    for most in (0, 20, 1 << 16):
        monkeypatch.setattr(enrich, "FREQUENT", most)
        got[most] = sorted(enrich.key_topics(df).collect())
    assert got[0] == got[20] == got[1 << 16] and len(got[0]) == 300
    counts = {i: Counter(t.split()) for i, t in rows}
    counts[7].update(["abcd", "more"])
    freq = Counter(t for c in counts.values() for t in c)
    for i, c in counts.items():
        want = sorted(((-round(n * math.log(65 / (1 + freq[t])), 6), t) for t, n in c.items()))[:5]
        assert sorted(r["score"] for r in got[20] if r["doc_id"] == i) == pytest.approx(sorted(-s for s, _ in want), abs=2e-6)


def test_model_calls_hold_a_slice_of_a_batch():
    batch = pa.RecordBatch.from_pydict({"_hash": [str(i) for i in range(1000)], "_prompt": ["x" * i if i % 3 else None for i in range(1000)]})
    out = list(model._call_model(lambda: lambda p: str(len(p)), ["_prompt"], False)(iter([batch])))
    assert max(b.num_rows for b in out) <= model.ROWS_AT_ONCE < 1000 and out[0].schema.names == ["_hash", "result", "error_message"]
    got = pa.Table.from_batches(out).to_pylist()
    assert [r["_hash"] for r in got] == [str(i) for i in range(1000)]
    assert [r["result"] for r in got] == [str(i) if i % 3 else None for i in range(1000)]
    assert {r["error_message"] for r in got} == {None, "ValueError: no prompt"}


def test_labels_do_not_depend_on_the_length_of_the_frequent_list(spark, monkeypatch):
    r = random.Random(6)
    words = ["".join(r.choices("abcdefghij", k=3)) for _ in range(200)]
    docs = spark.createDataFrame([(i, " ".join(r.choices(words, k=30))) for i in range(80)] + [(80, None), (81, "zzzz")], "doc_id bigint, text string")
    labelled = docs.selectExpr("text", "cast(doc_id % 3 as int) as quality").limit(50)
    got = {}
    for most in (0, 15, 1 << 16):
        monkeypatch.setattr(model, "FREQUENT", most)
        got[most] = {x["doc_id"]: x["quality"] for x in model.label_by_words(docs, labelled, label="quality").collect()}
    assert got[0] == got[15] == got[1 << 16] and len(got[0]) == 82 and set(got[0].values()) == {0, 1, 2}


def test_shingles_are_dealt_by_code_once(spark):
    sets = spark.range(50).selectExpr("if(id < 0, null, id) as k", "array(id, id % 7, 100L) as s")
    found = similarity._rarest(sets, 0.8)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("REPARTITION_BY_COL") >= 1 and "ReusedExchange" in plan
