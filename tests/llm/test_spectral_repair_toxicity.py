"""Whitening, conversation repair and toxicity against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import conversations, toxicity, whitening
from docflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# ---- whitening ----------------------------------------------------------------------------------


@pytest.mark.parametrize("v", [np.zeros((4, 4)), np.eye(5) * 3, np.diag([1.0, 1, 2, 2, 1e-9, 0]), np.ones((6, 6)), np.diag([5.0, 5, 5, 1, 1]) + 1e-13, np.array([[2.0]])])
def test_components_of_repeated_and_missing_eigenvalues(v):
    e, q = whitening.components(v)
    scale = max(1.0, np.abs(v).max())
    assert np.abs(q.T @ q - np.eye(len(v))).max() < 1e-13 and np.abs(q @ np.diag(e) @ q.T - v).max() < 1e-13 * scale
    assert (np.diff(e) <= 1e-13 * scale).all()


def test_components_of_random_matrices():
    r = np.random.default_rng(1)
    for n in (2, 3, 7, 33, 64):
        a = r.standard_normal((n, n)) * np.geomspace(1, 1e-5, n)
        v = a.T @ a
        e, q = whitening.components(v)
        assert np.abs(e - np.linalg.eigvalsh(v)[::-1]).max() < 1e-13 * e[0]
        assert np.abs(q.T @ v @ q - np.diag(e)).max() < 1e-13 * e[0]


def slow_whitening(vectors, count):
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = np.cov((x - s / n).T, bias=True).reshape(x.shape[1], -1)
    e, u = np.linalg.eigh(c)
    e, u = e[::-1][:count], u[:, ::-1][:, :count]
    exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return np.abs((x - s / n) @ u / np.sqrt(e)), exact, e / np.trace(c)


def test_query_against_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    want, exact, shares = slow_whitening([r["embedding"] for r in rows], 32)
    got = QUERIES["op11_whitening"](spark, SF).orderBy("vec_id", "component").collect()
    assert [r["component"] for r in got[:32]] == list(range(1, 33)) and len(got) == 32 * len(rows)
    assert np.abs(np.abs(np.array([r["whitened"] for r in got])).reshape(-1, 32) - want).max() < 1e-6
    assert [r["deviation"] for r in got[::32]] == exact and {r["n"] for r in got} == {len(rows)}
    assert np.abs(np.array([r["explained"] for r in got[:32]]) - shares).max() < 1e-12 and got[0]["identity_error"] < 1e-10


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [[0.5, -1.25, 3.0], [0.5, -1.25, 3.0], [2.0, 0.0, -0.015625], [1e6, 5.0, 0.0], [-3.0, 0.1, 7.5]]
    odd = [None, [], [1.0, None, 2.0], [1.0, nan, 2.0], [inf, 0.0, 0.0], [1.0, 2.0]]
    data = [(i % 4 or None, v, 7) for i, v in enumerate(good + odd)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, whitening int")
    model = whitening.fit(df)
    out = whitening.whitened(df, model)
    assert out.columns == ["vec_id", "embedding", "whitening", "_whitening"] and out.count() == 5
    want, exact, _ = slow_whitening(good, 32)
    got = {tuple(r["embedding"]): r["_whitening"] for r in out.collect()}
    keys = [tuple(np.float32(x).item() for x in v) for v in good]
    assert [int(got[k]["deviation"]) for k in keys] == exact
    assert max(np.abs(np.abs(got[k]["values"]) - w).max() for k, w in zip(keys, want)) < 1e-6
    assert whitening.component_rows(df, model).count() == 15


def test_no_vectors_one_vector_and_equal_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    none = spark.createDataFrame([], schema)
    assert whitening.component_rows(none, whitening.fit(none)).count() == 0
    for rows in ([(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        df = spark.createDataFrame(rows, schema)
        got = whitening.component_rows(df, whitening.fit(df)).collect()
        assert len(got) == 2 * len(rows) and {(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in got} == {(0.0, 0.0, 0, 0.0)}


# ---- conversation repair ------------------------------------------------------------------------


def cheapest(codes):
    """Least (cost, audit) by search over nodes; what is given for each edit."""
    heap, done = [(0, "", 0, 0, "")], set()
    while heap:
        cost, audit, i, state, given = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(codes) and state in conversations.ENDS:
            return cost, audit, given
        to = conversations.AFTER[state]
        heapq.heappush(heap, (cost + 5, audit + "I", i, to, given + "?sua"[to]))
        if i < len(codes):
            for k, (c, to) in conversations.arcs(codes[i], state).items():
                heapq.heappush(heap, (cost + c, audit + k, i + 1, to, given + ("-" if k == "D" else "?sua"[to])))


def test_ranked_paths_against_search():
    r = random.Random(3)
    last = conversations.end_costs()
    for _ in range(600):
        codes = bytes(r.choice([0, 1, 2, 3, 2, 3, 6, 7, 10, 5]) for _ in range(r.randint(0, 12)))
        cost, audit, given = cheapest(codes)
        assert conversations.costs_to_go(codes, last)[0][0] == cost
        assert conversations.ranked_paths(codes, last, True)[0][:2] == (audit, given)
        # The same in two pieces that meet through costs and states.
        k = r.randint(0, len(codes))
        a, b = codes[:k], codes[k:]
        middle = conversations.costs_to_go(b, last)[0]
        assert [min(m + c for m, c in zip(line, middle)) for line in conversations.transfer(a)] == conversations.costs_to_go(a, middle)[0]
        x = conversations.ranked_paths(a, middle, False)[0]
        y = conversations.ranked_paths(b, last, True)[x[2]]
        assert (x[0] + y[0], x[1] + y[1]) == (audit, given)


def slow_repair(rows):
    blank = " \t\n\x0b\x0c\r"
    grouped, out = {}, {}
    for conv, *rest in rows:
        grouped.setdefault(conv, []).append(rest)
    for conv, mine in grouped.items():
        seq = []
        for turn, role, text in sorted(mine, key=lambda x: (x[0] is not None, x[0] or 0)):
            hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if hit == 1 else "".join(c for c in text if c not in ".!?") if hit == 2 else text
            seq += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
        faults, seen = [], set()
        for _, role, text in seq:
            t = text.rstrip(blank)
            faults.append("blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else "")
            seen.add((role, text))
        codes = bytes(max(0, "?sua".find(role[:1] or "?")) | (8 if f in ("blank", "duplicate") else 4 if f else 0) for (_, role, _), f in zip(seq, faults))
        cost, audit, given = cheapest(codes)
        lines, at = [], 0
        for edit, g in zip(audit, given):
            full = {"u": "user", "a": "assistant"}.get(g)
            if edit == "I":
                lines.append(f"{full}:")
                continue
            if edit != "D":
                lines.append(f"{seq[at][1] if edit == 'K' else full}:{seq[at][2]}")
            at += 1
        turns = {t for t, _, _ in seq if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(seq, seq[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest)
    return out


CONV = "conv_id bigint, turn bigint, role string, text string"


def test_repair_against_brute_force(spark):
    r = random.Random(5)
    rows = []
    for conv in [*range(60), None]:
        for turn in [*range(r.randrange(0, 9)), *([None] if r.random() < 0.2 else [])]:
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = r.choice(["Yes.", "No!", "open end", "", " \t\n", None, "Why? ", f"t{r.random()}.", "é ü?\n"])
            rows.append((conv, None if turn is None else 3 * turn, role, text))
    # One conversation that lies over all partitions.
    rows += [(1000, i, ("user", "assistant")[i % 2 if i % 7 else 0], f"turn {i}" + "." * (i % 5 > 0)) for i in range(900)]
    df = spark.createDataFrame(rows, CONV).withColumns({c: F.lit(1) for c in ("ck", "part", "at", "code", "copies", "hit")}).repartition(3)
    got = {x[0]: tuple(x[1:]) for x in conversations.repaired(df)[0].collect()}
    assert got == slow_repair(rows)
    spread = conversations.placed(conversations.judged(conversations.damaged(conversations.read(df, conversations.COLUMNS)))).filter("ck = 'k1000'")
    assert spread.select("part").distinct().count() > 1


def test_repeated_rows_and_dropped_conversations(spark):
    rows = [(1, 7, "user", "Hi.")] * 5 + [(2, t, "user", "x.") for t in range(200) if zlib.crc32(f"2:{t}".encode()) % 20 == 0][:2]
    got = {x[0]: tuple(x[1:]) for x in conversations.repaired(spark.createDataFrame(rows, CONV))[0].collect()}
    assert got == slow_repair(rows) and got[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    report, turns = conversations.repaired(spark.createDataFrame([], CONV))
    assert report.count() == turns.count() == 0


def test_undamaged_conversations_stay_as_they_are(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello. " * 20_000)]
    report, turns = conversations.repaired(spark.createDataFrame(rows, CONV), damage=False)
    assert tuple(report.first())[:-1] == (1, 0, 0, 0, 0, 0, 0, "KKK")
    assert [(t["role"], t["text"]) for t in turns.orderBy("part", "at", "sub").collect()] == [(r, t) for _, _, r, t in rows]


# ---- toxicity -----------------------------------------------------------------------------------


def corpus(n, seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice(["th", "er", "an", "on", "re", "st", "nd"]) for _ in range(r.randrange(1, 5))) for _ in range(400)]
    bad = ["idiot", "moron", "disgusting", "worthless"]
    rows = []
    for i in range(n):
        toxic = int(i % 4 == 0)
        words = [r.choice(vocabulary) for _ in range(r.randrange(60, 400))]
        for _ in range(r.randrange(3, 9) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxic_texts_are_found_on_held_out_rows(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held"), "toxicity.*").collect()}
    held = [(got[i]["predicted"], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in got if got[i]["held"]} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(p == y for p, y in held) >= 0.95 * len(held) and any(y for _, y in held)
    # Nothing is learned from held-out labels, and the order of rows tells nothing.
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs.repartition(3), turned)
    assert (again.toxic, again.ordinary, again.cuts) == (model.toxic, model.ordinary, model.cuts) and (again.weights == model.weights).all()


def test_odd_texts_and_missing_labels(spark):
    rows = corpus(120)
    model = toxicity.learn([t for _, t, _ in rows], np.array([y for _, _, y in rows]))
    odd = [(None, None, 1), (1, "", 1), (1, "", 1), (2, " \n ", 1), (3, "x" * 300_000, 1), (4, "idiot " * 40, 1), (5, "퟿ é \U0001f600 " * 50, 1)]
    df = spark.createDataFrame(odd, "doc_id bigint, text string, toxicity int")
    got = [(r["doc_id"], r["_toxicity"]["score"], r["_toxicity"]["predicted"]) for r in toxicity.scored(df, model).collect()]
    assert len(got) == len(odd) and all(0 <= s <= 1 and p == int(s >= 0.5) for _, s, p in got)
    assert {p for k, _, p in got if k == 4} == {1} and {p for k, _, p in got if k in (None, 1)} == {0}
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    plain = toxicity.fit(df, none)
    assert {r["_toxicity"]["score"] for r in toxicity.scored(df, plain).collect()} == {0.0}
    assert toxicity.scored(df.limit(0), model).count() == 0
    one = spark.createDataFrame([(4, 1), (4, 1), (4, 0)], "doc_id bigint, toxic int")
    assert toxicity.fit(df, one).share == 1.0


def test_windows_hold_the_whole_text():
    r = random.Random(2)
    for n in (0, 1, 47, 48, 49, 500, 5000):
        data = bytes(r.choice(b"ab  c") for _ in range(n))
        cut = b"".join(w[1:-1] for w in toxicity.windows(data))
        assert sorted(cut.replace(b" ", b"")) == sorted(data.replace(b" ", b"")) and all(len(w) <= 8 * toxicity.WINDOW + 2 for w in toxicity.windows(data))
