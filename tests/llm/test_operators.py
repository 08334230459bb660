"""Every operator against brute force, and on NULLs, empty and long texts, ties, repeated rows, empty tables, odd columns."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from docflow.llm import bpe, cotraining, graph, line_dedup, mixing, packing, pii, pivot_topk, rule_ledger, simhash, url_trust

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators themselves would use.
CLASH = ["mix", "_size", "_bucket", "measures", "failed", "pii", "bpe", "_ids", "line_dedup", "_text_hash", "quality", "url_filter", "host", "fp", "_key", "at", "n", "doc", "slot"]

LONG = "lorem ipsum dolor " * 9000
ODD = [
    (1, "The same words stand here again and again today.\nSecond line of the text.", "en", "a", 10),
    (1, "The same words stand here again and again today.\nSecond line of the text.", "en", "a", 10),
    (2, "The same words stand here again and again today.\nAnother ending of this text.", "en", "b", 10),
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (None, "a text without a key but with eleven words in all of it", "de", "b", 3),
    (5, " \n\t\n ", "en", None, 4),
    (6, LONG, "en", "a", len(LONG)),
    (7, "x" * 30_000, "en", "c", 30_000),
    (7, "mail a.b@c.de or +1 (017) 555-7713 and 10.0.0.1, a\u00a0b é \U0001f600", "fr", "c", 3),
    (8, "one two three four five six seven eight nine ten\n\none two three four five six seven eight nine ten", "en", "c", 3),
]


def clash(df):
    return df.withColumns({c: F.lit(7) for c in CLASH})


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(t):
    return (t or "").encode().split()


# ---- URL filter ---------------------------------------------------------------------------------


def test_url_places(spark):
    urls = ["http://A.Example.ORG/En/1?q#f", "x://h#f", "no scheme", None, "http://", "a://b://c/d", "://h/p", "http://ü.org/ß?x"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [tuple(r) for r in df.select(url_trust.host_of(F.col("u")), url_trust.path_of(F.col("u"))).collect()]
    assert got == [("a.example.org", "/En/1"), ("h", ""), ("", ""), ("", ""), ("", ""), ("b:", "//c/d"), ("h", "/p"), ("ü.org", "/ß")]


def test_trust_and_distrust_flow(spark):
    rules = [("good.org/", "allow"), ("bad.com/", "block")]

    def page(i, url, *links):
        return i, url, "".join(f'<p><a class=x href="{x}">y</a>' for x in links)

    pages = [
        page(1, "http://good.org/a", "https://friend.net/x", "/own"),
        page(2, "http://friend.net/", "//pal.net/"),
        page(3, "http://farm.net/1", "http://bad.com/x", "http://bad.com/y", "http://good.org/"),
        page(4, "http://ring.net/", "http://farm.net/"),
        page(5, "http://bad.com/z", "http://farm.net/"),
        page(6, "http://pal.net/"),
        page(7, "http://lone.net/"),
        page(8, None),
    ]
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    got = {r["page_id"]: r["url_filter"] for r in url_trust.judge_urls(df, rules, iterations=5).collect()}
    assert {i for i, r in got.items() if r["verdict"] == "block"} == {3, 4, 5}

    edges = Counter()
    for _, url, html in pages:
        src = (url or "").partition("://")[2].partition("/")[0]
        for x in html.split('href="')[1:]:
            dst = x.partition('"')[0].partition("//")[2].partition("/")[0]
            if src and dst and src != dst:
                edges[src, dst] += 1

    def rank(edges, seed):
        out, now = Counter(), dict(seed)
        for (s, _), n in edges.items():
            out[s] += n
        for _ in range(5):
            new = Counter({h: v * 15 // 100 for h, v in seed.items()})
            for (s, d), n in edges.items():
                new[d] += (now.get(s, 0) * (n * 10**6 // out[s]) // 10**6) * 85 // 100
            now = new
        return now

    trust, distrust = rank(edges, {"good.org": 10**12}), rank({(d, s): n for (s, d), n in edges.items()}, {"bad.com": 10**12})
    for i, url, _ in pages[:7]:
        host = url.partition("://")[2].partition("/")[0]
        assert (got[i]["trust"], got[i]["distrust"]) == (trust.get(host, 0), distrust.get(host, 0))


def test_url_filter_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "http://x.com/de/1", None)] * 2 + [(None, None, "")], "page_id int, url string, html string")
    df = clash(df)
    out = url_trust.judge_urls(df)
    assert out.columns == df.columns + ["_url_filter"]
    assert sorted(r["_url_filter"]["verdict"] for r in out.collect()) == ["allow", "block", "block"]
    assert url_trust.judge_urls(df.limit(0)).count() == 0


# ---- SimHash ------------------------------------------------------------------------------------


def slow_fingerprint(t, n=3):
    w = words((t or "").encode().lower().decode())
    if not w:
        return 0
    codes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    code = sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))
    return code - (1 << 64) if code >> 63 else code


def slow_groups(codes, distance):
    codes = sorted(set(codes))
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if ((a ^ b) & simhash.FULL).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("pair_bucket", [1, 64])
def test_all_close_codes_are_joined(spark, distance, pair_bucket):
    r = random.Random(distance)
    codes = [0, -1]
    for _ in range(25):
        c = r.getrandbits(64)
        for _ in range(8):
            codes.append(simhash.signed(c))
            for _ in range(r.randint(1, 3)):
                c ^= 1 << r.randrange(64)
    df = spark.createDataFrame([(c,) for c in codes], "x bigint")
    got = {r["fp"]: r["root"] for r in simhash.fingerprint_groups(df, "x", distance, pair_bucket).collect()}
    assert got == slow_groups(codes, distance)


def test_a_crowded_bucket_is_linked_without_pairs(spark):
    base = 0x0123456789ABCDEF
    codes = [base] + [base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    df = spark.createDataFrame([(simhash.signed(c),) for c in codes], "x bigint")
    groups = simhash.fingerprint_groups(df, "x").collect()
    assert len(groups) == len(codes) and len({r["root"] for r in groups}) == 1


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(1).sample(range(n), n)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (5, 5)], "a long, b long")
    roots = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    assert roots == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}
    assert graph.components(edges.limit(0)).count() == 0


def test_simhash_of_documents(spark, docs, odd, empty):
    for df in (docs, clash(odd)):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        codes = [slow_fingerprint(t) for _, t in rows]
        roots = slow_groups(codes, 2)
        least = defaultdict(list)
        for (i, _), c in zip(rows, codes):
            least[roots[c]].append(math.inf if i is None else i)
        want = Counter((i, c, None if (m := min(least[roots[c]])) == math.inf else m) for (i, _), c in zip(rows, codes))
        assert Counter((r["doc_id"], r["fp"], r["component_id"]) for r in simhash.simhash_groups(df).collect()) == want
    assert simhash.simhash_groups(empty).count() == 0


def test_one_of_each_group_stays(odd, empty):
    kept = simhash.drop_near_duplicates(clash(odd))
    assert kept.columns == odd.columns + CLASH
    # The repeated row and the other texts without words (4, 5) go.
    want = sorted({(i is None, i or 0, t or "") for i, t, *_ in ODD if i not in (4, 5)})
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == want
    assert simhash.drop_near_duplicates(empty).count() == 0


# ---- mixing -------------------------------------------------------------------------------------


def slow_targets(sizes):
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in stopped]
        left, rest = total - sum(3 * sizes[s] for s in stopped), sum(weight[s] for s in free)
        target = {s: 3.0 * sizes[s] for s in stopped} | {s: left * weight[s] / rest for s in free}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        stopped |= above


def test_targets_and_copies(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["a", "a", "a", "a", "b", "c", "ü", None, "z"]), r.choice([1, 2, 3, 500, 0])) for i in range(3000)] + [(9000, "tiny", 1), (9001, "none", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    df = clash(df)
    out = mixing.systematic_copies(df, F.col("size")).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    target = slow_targets(dict(sizes))
    taken, expect = Counter(), Counter()
    for x in out:
        mix = x["_mix"]
        assert mix["source_size"] == sizes[x["source"]] and math.isclose(mix["target"], target[x["source"]], rel_tol=1e-12, abs_tol=1e-9)
        rate = target[x["source"]] / sizes[x["source"]] if sizes[x["source"]] else 0
        assert math.floor(rate) <= mix["copies"] <= math.ceil(rate) <= 3
        taken[x["source"]] += mix["copies"] * mix["size"]
        expect[x["source"]] += 1
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 500 + 0.05 * target[s]
    assert sorted(map(str, out)) == sorted(map(str, mixing.systematic_copies(df, F.col("size")).collect()))


def test_mix_of_odd_documents(odd, empty):
    mixed = mixing.mixed_documents(clash(odd))
    assert mixed.columns == odd.columns + CLASH
    assert {r["source"] for r in mixed.collect()} <= {"a", "b", "c", None, ""}
    assert mixing.mixed_documents(empty).count() == 0


# ---- rules --------------------------------------------------------------------------------------


def slow_measures(t):
    t = t or ""
    w = t.encode().split()
    windows = defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i : i + 5])].append(i)
    held = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in t.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(held))


def test_measures_and_bits(spark, docs, odd, empty):
    r = random.Random(4)
    made = spark.createDataFrame([(i, "".join(r.choice(["a ", "b\n", "a b c ", "\n", "$%", "d\t"]) for _ in range(r.randint(0, 60)))) for i in range(300)], "doc_id bigint, text string")
    for df in (docs, odd, made):
        for x in rule_ledger.ledger(df).select("text", "measures.*", "failed").collect():
            m = slow_measures(x["text"])
            assert tuple(x[c] for c in rule_ledger.MEASURES) == m
            n, chars, symbols, lines, dup, rep = m
            assert x["failed"] == (n < 10) + 2 * (100 * rep > 20 * n) + 4 * (10 * symbols > 3 * n) + 8 * (lines >= 4 and 2 * dup > lines) + 16 * (chars < 2 * n or chars > 20 * n)
    out = rule_ledger.ledger(clash(odd))
    assert out.columns == odd.columns + CLASH + ["_measures", "_failed"]
    assert rule_ledger.kept_documents(clash(odd)).columns == odd.columns + CLASH
    assert rule_ledger.kept_documents(empty).count() == 0


def test_policies_and_ablation(docs):
    entries = rule_ledger.ledger(docs).cache()
    failed = [r["failed"] for r in entries.select("failed").collect()]
    for policy, names in rule_ledger.POLICIES.items():
        mask = rule_ledger.policy_mask(policy)
        assert entries.filter(rule_ledger.passes("failed", policy)).count() == sum(not f & mask for f in failed)
        got = {r["rule"]: (r["failed"], r["only"], r["kept_without"]) for r in rule_ledger.ablation(entries, policy).collect()}
        for name in names:
            bit = rule_ledger.policy_mask([name])
            assert got[name] == (sum(bool(f & bit) for f in failed), sum(f & mask == bit for f in failed), sum(not f & (mask & ~bit) for f in failed))


# ---- line dedup ---------------------------------------------------------------------------------


def dedup(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r["doc_id"]: (r["text"], r["line_dedup"]["removed_words"]) for r in line_dedup.remove_repeated_lines(df, **options).collect()}


def test_common_blocks_go_from_the_later_document(spark):
    a, b, c = "one two three four five six", "seven eight nine ten eleven", "short line"
    got = dedup(spark, [(1, f"{a}\n\n{c}\n{b}\nown"), (2, f"first\n{a}\n\n{c}\n{b}\nlast"), (3, f"{c}\nx y z"), (4, f"{b}\nq\n{a}"), (5, None), (6, f"{a}\r\n{b}")])
    assert got[1] == (f"{a}\n\n{c}\n{b}\nown", 0)
    assert got[2] == ("first\nlast", 13)
    assert got[3] == (f"{c}\nx y z", 0)
    assert got[4] == ("q", 11)
    assert got[5] == (None, 0)
    assert got[6] == (f"{a}\r", 5)


def slow_line_dedup(rows):
    """``key, text, source, lines gone`` of each row: a line goes if it stands in a run of lines with five words or more that any
    earlier document has as well; blank lines go between two lines that go. All runs, no partners and no alignment."""
    by_key, seen, cut = sorted({(i is None, i or 0, t or "") for i, t, _ in rows}), set(), {}
    for d in by_key:
        listed = [(k, x) for k, x in enumerate(d[2].split("\n")) if words(x)]
        gone, own = set(), set()
        for x in range(len(listed)):
            run, n = (), 0
            for y in range(x, len(listed)):
                run, n = (*run, listed[y][1]), n + len(words(listed[y][1]))
                if n >= 5:
                    own.add(run)
                    if run in seen:
                        gone |= set(range(x, y + 1))
        seen |= own
        between = {k for r in gone if r + 1 in gone for k in range(listed[r][0], listed[r + 1][0])}
        places = between | {listed[r][0] for r in gone}
        cut[d] = "\n".join(x for k, x in enumerate(d[2].split("\n")) if k not in places), len(gone)
    return [(i, t if not cut[i is None, i or 0, t or ""][1] else cut[i is None, i or 0, t][0], s, cut[i is None, i or 0, t or ""][1]) for i, t, s in rows]


def test_line_dedup_equals_brute_force(spark, docs, odd):
    r = random.Random(5)
    made = [(i, "\n".join(r.choice(["a", "b c", "d e f", "", "g h i j", "k l m n o p"]) for _ in range(r.randrange(0, 9)))) for i in range(120)]
    frames = [spark.createDataFrame(made, "doc_id bigint, text string"), docs, odd]
    for df in frames:
        rows = [(r["doc_id"], r["text"], None) for r in df.select("doc_id", "text").collect()]
        got = line_dedup.remove_repeated_lines(df.select("doc_id", "text")).collect()
        want = slow_line_dedup(rows)
        assert Counter((r["doc_id"], r["text"], r["line_dedup"]["removed_lines"]) for r in got) == Counter((i, t, n) for i, t, _, n in want)


def test_a_block_goes_whole_though_its_lines_have_other_first_documents(spark):
    got = dedup(spark, [(1, "short one"), (2, "short one\nx y\nz w"), (3, "short one\nx y\nz w\nown text"), (4, "x y\nshort one")])
    assert got == {1: ("short one", 0), 2: ("short one\nx y\nz w", 0), 3: ("own text", 6), 4: ("x y\nshort one", 0)}


def test_blocks_name_their_partner(spark):
    a, b = [f"a{i} one two three four" for i in range(3)], [f"b{i} five six seven" for i in range(2)]
    df = spark.createDataFrame([(1, "\n".join([*a, "own", *b])), (2, "\n".join([*b, "", "mine", *a, *a[:1]]))], "doc_id bigint, text string")
    blocks = line_dedup.line_blocks(df).select("doc", "rank", "lines", "partner", "partner_rank").collect()
    assert sorted(map(tuple, blocks)) == [(2, 0, 2, 1, 4), (2, 3, 3, 1, 0), (2, 6, 1, 1, 0)]
    assert dedup(spark, df.collect())[2] == ("\nmine", 28)


def test_no_long_line_is_lost_and_none_is_left_twice(docs, odd, empty):
    for df in (docs, clash(odd)):
        before, after = df.select("doc_id", "text").collect(), line_dedup.remove_repeated_lines(df)
        rows = after.select("doc_id", "text").collect()
        assert len(rows) == len(before)

        def long_lines(rows):
            return {(r["doc_id"], r["text"], x) for r in rows for x in set((r["text"] or "").split("\n")) if len(words(x)) >= 5}

        assert {x for _, _, x in long_lines(before)} == {x for _, _, x in long_lines(rows)}
        assert max(Counter(x for _, _, x in long_lines(rows)).values()) == 1
    kept = line_dedup.line_deduped(clash(odd))
    assert kept.columns == odd.columns + CLASH
    assert line_dedup.line_deduped(empty).count() == 0
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 7, 8, None}


def test_full_copies_are_emptied(spark):
    text = "one two three four five\nsix seven"
    df = spark.createDataFrame([(i, text) for i in range(40)] + [(50, "")], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in line_dedup.line_deduped(df).collect()) == [0, 50]


# ---- BPE ----------------------------------------------------------------------------------------


def test_digests_equal_the_library(docs, odd, empty):
    tokenizer = bpe.load(bpe.default_path())
    for df in (docs, clash(odd)):
        want = Counter()
        for r in df.select("doc_id", "text").collect():
            ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
            back = tokenizer.decode(ids, skip_special_tokens=False)
            want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
        assert Counter(tuple(r) for r in bpe.digests(df).collect()) == want
    assert bpe.digests(empty).count() == 0
    assert bpe.encode_documents(clash(odd)).columns == odd.columns + CLASH + ["_bpe"]


# ---- top-k --------------------------------------------------------------------------------------


def slow_top(rows, every, top):
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for k, (i, v) in enumerate(good):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for n, (j, w) in enumerate(good) if n != k)[:top]
            for rank, (s, j) in enumerate(best, 1):
                out[i, rank, j, -s] += 1
    return out


@pytest.mark.parametrize("kind", ["spread", "ties", "few"])
def test_top_k_equals_brute_force(spark, kind):
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 1) * (1 + i % 5) for _ in range(6)]) for i in range(700)]
    if kind == "ties":
        rows = [(i, [float(i % 3), 1.0]) for i in range(900)] + [(5, [1.0, 1.0])] * 3
    if kind == "few":
        rows = [(0, [1.0]), (10, None), (20, [float("nan")]), (30, [None, 1.0]), (None, [1.0]), (40, [2.0, 3.0]), (50, []), (50, []), (60, [float("inf")])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3).withColumns({"v": F.lit(1), "score": F.lit(2)})
    got = Counter(tuple(x) for x in pivot_topk.exact_top_k(df, every=10).collect())
    assert got == slow_top(rows, 10, 10)
    assert pivot_topk.exact_top_k(df.limit(0)).count() == 0


def test_bounds_save_visits(spark):
    """In a clustered table most cells are passed over, and the result is still exact."""
    r = random.Random(8)
    centres = [[r.gauss(0, 4) for _ in range(8)] for _ in range(12)]
    rows = [(i, [c + r.gauss(0, 0.05) for c in centres[i % 12]]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert Counter(tuple(x) for x in pivot_topk.exact_top_k(df, every=300).collect()) == slow_top(rows, 300, 10)


# ---- PII ----------------------------------------------------------------------------------------


def test_pii_columns_and_redaction(odd, empty):
    found = pii.find_pii(clash(odd))
    assert found.columns == odd.columns + CLASH + ["_pii"]
    one = found.filter("lang = 'fr'").select("text", pii.span_list(F.col("_pii")).alias("s"), pii.redacted("text", "_pii").alias("r")).first()
    assert one["s"] == "email:5:13,ip:39:47,phone:17:34"
    assert one["r"] == "mail [EMAIL] or [PHONE] and [IP], a\u00a0b é \U0001f600"
    assert found.filter("text IS NULL").select(F.size("_pii")).first()[0] == 0
    assert pii.find_pii(empty).count() == 0


# ---- packing ------------------------------------------------------------------------------------


def test_packing_is_lossless(spark, docs, odd, empty, tmp_path):
    for df in (docs, clash(odd)):
        rows = packing.packed(df, seq_len=256, buffer_tokens=20_000).cache()
        for r in rows.collect():
            assert r["n_tokens"] <= 256 and len(r["ids"]) == 2 * r["n_tokens"]
            assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] and r["position_resets"] == r["cu_seqlens"][:-1]
        parts = defaultdict(list)
        for s in packing.segments(rows).collect():
            parts[s["doc_id"], s["doc_row"]].append((s["part"], s["ids"]))
        encoding = packing.load(packing.default_path())
        back = Counter((i, packing.text_of(b"".join(x for _, x in sorted(p)), encoding=encoding)) for (i, _), p in parts.items())
        assert back == Counter((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect())
    packing.write_packed(packing.packed(docs, seq_len=256), str(tmp_path / "m"), rows_per_matrix=16, seq_len=256)
    matrices = spark.read.parquet(str(tmp_path / "m"))
    assert all(len(r["ids"]) == r["n_rows"] * 256 * 2 and len(r["cu_seqlens"]) == r["n_rows"] for r in matrices.collect())
    assert packing.packed(empty).count() == 0


# ---- co-training --------------------------------------------------------------------------------


def test_cotraining_beats_its_views_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    train, test = labels.filter("doc_id % 3 <> 0"), labels.filter("doc_id % 3 = 0")
    model = cotraining.fit(docs.join(test.select("doc_id"), "doc_id", "left_anti"), train, max_labelled=1200)
    assert sum(a + b for a, b in model.rounds) > 0
    got = cotraining.scored(docs.join(test, "doc_id"), model).selectExpr("quality", "_quality.kept", "_quality.score").toPandas()
    good, bad = got[got["quality"] == 1], got[got["quality"] == 0]
    assert good["kept"].mean() > 0.98 and (~bad["kept"]).mean() > 0.9


def test_cotraining_without_labels_and_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id bigint, quality int")
    model = cotraining.fit(odd, labels)
    out = cotraining.scored(clash(odd), model)
    assert out.columns == odd.columns + CLASH + ["_quality"]
    assert all(r["_quality"]["score"] == 0.5 and r["_quality"]["kept"] for r in out.collect())
    assert cotraining.scored(empty, cotraining.fit(empty, labels.limit(0))).count() == 0


def slow_features(text):
    w = words(text)
    found = Counter(b for x in w for b in cotraining.word_features(x))
    same = sum(x == y for x, y in zip(w, w[1:]))
    found += Counter({cotraining.SAME: same, cotraining.OTHER: len(w) - same})
    return np.array(list(found), int), np.array(list(found.values()), float)


class SlowPool:
    """Rounds over unlabelled rows one by one, each with its state, as ``cotrain`` asks for them."""

    def __init__(self, texts, metas):
        self.rows = [(t, (m, np.ones(len(m)))) for t, m in zip(texts, metas)]
        self.given = [[None, None] for _ in self.rows]
        self.size = len(self.rows)

    def open_rows(self, at):
        for i, row in enumerate(self.rows):
            for v in (0, 1):
                where, counts = row[v]
                z = sum(at.weights[v][w] * c for w, c in zip(where, counts)) / max(1.0, sum(counts)) * at.lines[v][0] + at.lines[v][1]
                if self.given[i][1 - v] is None and 1 / (1 + math.exp(-abs(z))) >= 0.95:
                    yield i, v, int(z > 0), min(1023, int((abs(z) - math.log(19)) * 32))

    def confident(self, rounds):
        out = np.zeros((2, 2, 1024), int)
        for _, v, y, b in self.open_rows(rounds[-1]):
            out[v][y][b] += 1
        return out

    def taught(self, rounds):
        out = np.zeros((2, 2, cotraining.BUCKETS), int)
        new = [(i, v, y) for i, v, y, b in self.open_rows(rounds[-1]) if b >= rounds[-1].cuts[v][y]]
        for i, v, y in new:
            self.given[i][1 - v] = y
            where, counts = self.rows[i][1 - v]
            for w, c in zip(where, counts):
                out[1 - v][y][w] += round(c * (1 << 20) / math.sqrt(max(1.0, sum(counts))))
        return out


def test_cotraining_rounds_equal_brute_force(spark, docs, odd, monkeypatch):
    sf = "/root/testdata/sf0.01"
    some = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 600").select(odd.columns)
    some = some.unionAll(odd.selectExpr("doc_id + 100000 as doc_id", *odd.columns[1:])).unionAll(odd.filter("doc_id IS NULL"))
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("doc_id < 300")
    got = cotraining.fit(some, labels)
    known = {r["doc_id"] for r in labels.collect()}
    rest = [r for r in some.collect() if r["doc_id"] not in known]
    texts = [slow_features(r["text"]) for r in rest]
    metas = [np.array(cotraining.meta_features(r["text"], [r["lang"], r["source"]]), int) for r in rest]
    monkeypatch.setattr(cotraining, "Pool", lambda rows: SlowPool(texts, metas))
    want = cotraining.fit(some, labels)
    assert got.rounds == want.rounds and sum(map(sum, got.rounds)) > 50
    for name in ("text", "meta", "text_line", "meta_line", "union"):
        assert np.allclose(getattr(got, name), getattr(want, name), rtol=1e-6, atol=1e-6), name


def test_counts_are_packed_without_loss():
    for counts in ([1, 255, 3], [1, 256, 70_000], []):
        where, meta = np.arange(len(counts), dtype=np.uint16), [5, 9]
        row = cotraining.packed(where, np.array(counts, np.float32), meta)
        assert len(row[1]) == len(counts) * (1 if max(counts, default=0) < 256 else 4)
        assert [x.tolist() for x in cotraining.unpacked(*row)] == [where.tolist(), counts, meta]


def test_features_meet_labels_by_one_plan_at_any_size(spark, docs, monkeypatch):
    """A few labels are not broadcast, so disk grows with the rows and doesn't jump."""
    frames = []
    monkeypatch.setattr(cotraining, "Pool", lambda rows: frames.append(rows) or SlowPool([], []))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    cotraining.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), labels)
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_cuts_take_the_most_confident_and_copies_together():
    bins = np.zeros(cotraining.BINS, int)
    assert cotraining.cut_of(bins, 5) == cotraining.BINS
    bins[[3, 10, 20]] = 4, 2, 3
    assert [cotraining.cut_of(bins, n) for n in (0, 1, 3, 4, 5, 8, 9)] == [cotraining.BINS, 20, 11, 11, 4, 4, 0]


def test_cotraining_views_teach_each_other():
    r = np.random.default_rng(1)
    n = 600
    y = r.integers(0, 2, n)
    flip = lambda p: np.where(r.random(n) < p, 1 - y, y)
    texts = [(np.array([10 + v]), np.array([1.0])) for v in flip(0.1)]
    metas = [(np.array([20 + v, 40 + u]), np.ones(2)) for v, u in zip(flip(0.05), flip(0.3))]
    pool = SlowPool(texts[60:], [m for m, _ in metas[60:]])
    model = cotraining.cotrain(texts[:60], metas[:60], y[:60], np.arange(60) % 5 == 0, lambda: pool)
    raw = [np.array([cotraining.raw_score(w, x) for x in rows]) for w, rows in ((model.text, texts), (model.meta, metas))]
    assert ((model.logits(*raw)[2] > 0) == y)[60:].mean() > 0.92


# ---- pipeline -----------------------------------------------------------------------------------


def test_pipeline_equals_its_stages_in_plain_python(spark, docs, odd, empty, tmp_path):
    tokenizer = bpe.load(bpe.default_path())
    for k, df in enumerate((docs, odd, empty)):
        path = str(tmp_path / f"t{k}")
        df.write.parquet(f"{path}/documents.parquet")
        got = Counter(tuple(r) for r in corpus_pipeline.run(spark, path).collect())

        rows = []
        for r in df.select("doc_id", "text", "source").collect():
            n, chars, symbols, lines, dup, rep = slow_measures(r["text"])
            if n >= 10 and 100 * rep <= 20 * n and 10 * symbols <= 3 * n and not (lines >= 4 and 2 * dup > lines) and 2 * n <= chars <= 20 * n:
                rows.append((r["doc_id"], r["text"], r["source"]))
        rows = [(i, t, s) for i, t, s, gone in slow_line_dedup(rows) if not gone or words(t)]
        root = slow_near_copies([t or "" for _, t, _ in rows])
        best = {}
        for i, t, s in rows:
            key, group = (i is None, i or 0, F_HASH(spark, t)), root[t or ""]
            if group not in best or key < best[group][0]:
                best[group] = (key, (i, t, s))
        kept = [x for _, x in best.values()]
        frame = spark.createDataFrame(kept, "doc_id bigint, text string, source string")
        copies = {(r["doc_id"], r["text"]): r["mix"]["copies"] for r in mixing.systematic_copies(frame, mixing.n_words("text")).collect()}
        want = Counter()
        for i, t, _ in kept:
            ids = tokenizer.encode(t, add_special_tokens=False).ids
            row = (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())
            if copies[i, t]:
                want[row] += copies[i, t]
        assert got == want


def F_HASH(spark, t):
    return spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] if t is not None else 42


def slow_near_copies(texts):
    """Group of each distinct text: five-word shingles at least 80 % alike, through others as well."""
    sets = {}
    for t in dict.fromkeys(texts):
        w = words(t.lower())
        sets[t] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    having, root = defaultdict(list), {t: t for t in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for t, mine in sets.items():
        for other, n in Counter(o for x in mine for o in having[x]).items():
            if 5 * n >= 4 * (len(mine) + len(sets[other]) - n):
                root[find(t)] = find(other)
        for x in mine:
            having[x].append(t)
    empty = [t for t in sets if not sets[t]]
    for t in empty:
        root[find(t)] = find(empty[0])
    return {t: find(t) for t in sets}


def test_stages_keep_the_columns_they_are_given(spark, odd, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clash(odd), "")
        assert out.columns == odd.columns + CLASH, name
        assert 0 < out.count() <= 3 * odd.count()
        assert stage(spark, clash(empty), "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, clash(odd), "").count() == odd.count()
