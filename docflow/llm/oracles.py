"""DuckDB SQL for the queries of this package that SQL can express. Written on its own: constants are stated again."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '')"


def _rank_rounds(rounds: int) -> str:
    """The rounds of the two page ranks, in whole numbers."""
    steps = []
    for i in range(1, rounds + 1):
        steps.append(
            f"""r{i} AS (SELECT kind, host, sum(rank)::BIGINT rank FROM (
                SELECT kind, host, seed * 15 // 100 rank FROM seeds
                UNION ALL SELECT w.kind, w.dst, (r.rank * w.share // 1000000) * 85 // 100 FROM r{i - 1} r JOIN ways w ON w.kind = r.kind AND w.src = r.host)
            GROUP BY kind, host)"""
        )
    return ",\n".join(steps)


ORACLES["op1_url_trust"] = rf"""
WITH places AS (
    SELECT page_id, coalesce(html, '') html,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) path
    FROM pages),
ruled AS (
    SELECT page_id, html, host, path, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
    END AS rule FROM places),
said AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS says FROM ruled),
counted AS (SELECT host, CASE says WHEN 'allow' THEN 'trust' ELSE 'distrust' END kind, count(*) n
    FROM said WHERE says IS NOT NULL AND host <> '' GROUP BY ALL),
seeds AS (SELECT kind, host, (n * 1000000 // t * 1000000 + (n * 1000000 % t) * 1000000 // t)::BIGINT seed
    FROM (SELECT *, sum(n) OVER (PARTITION BY kind)::BIGINT t FROM counted)),
links AS (SELECT host src, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?((?:https?:)?//[^"''\s>]+)', 1)) link FROM places),
linked AS (SELECT src, translate(regexp_extract(link, '//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') dst FROM links),
edges AS (SELECT src, dst, count(*) n FROM linked WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
both_ways AS (SELECT 'trust' kind, src, dst, n FROM edges UNION ALL SELECT 'distrust', dst, src, n FROM edges),
ways AS (SELECT kind, src, dst, (n * 1000000 // sum(n) OVER (PARTITION BY kind, src))::BIGINT share FROM both_ways),
r0 AS (SELECT kind, host, seed rank FROM seeds),
{_rank_rounds(8)},
judged AS (SELECT host, coalesce(sum(rank) FILTER (kind = 'distrust'), 0) > 2 * coalesce(sum(rank) FILTER (kind = 'trust'), 0) bad FROM r8 GROUP BY host)
SELECT page_id, said.host, path, rule, coalesce(says, CASE WHEN bad THEN 'block' ELSE 'allow' END) verdict
FROM said LEFT JOIN judged ON judged.host = said.host
"""

ORACLES["op5_systematic_mix"] = rf"""
WITH sized AS (SELECT doc_id, source, len({WORDS})::BIGINT size FROM documents),
places AS (SELECT source, source_size, [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT weight
    FROM (SELECT source, sum(size)::BIGINT source_size FROM sized GROUP BY source)),
running AS (SELECT *, sum(source_size) OVER () total, sum(weight) OVER () weights,
        coalesce(sum(3 * source_size) OVER w, 0) capped, coalesce(sum(weight) OVER w, 0) passed
    FROM places WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stops AS (SELECT *, (total - capped) * weight >= 3 * source_size * (weights - passed) stop FROM running),
targets AS (SELECT source, source_size, CASE WHEN stop THEN (3 * source_size)::DOUBLE
        ELSE (total - coalesce(sum(3 * source_size) FILTER (stop) OVER (), 0))::DOUBLE * weight / (weights - coalesce(sum(weight) FILTER (stop) OVER (), 0)) END target
    FROM stops),
dealt AS (SELECT *, ('0x' || left(md5('42:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT % greatest(1, ceil(count(*) OVER () / 4096.0))::BIGINT bucket FROM sized),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY bucket, size, doc_id) place FROM dealt),
planned AS (SELECT n.*, source_size, target, coalesce(target / nullif(source_size, 0), 0) rate,
        ('0x' || left(md5('42:' || CASE WHEN n.source IS NULL THEN 'n' ELSE 's' || n.source END), 5))::BIGINT / 1048576.0::DOUBLE shift
    FROM numbered n JOIN targets t ON n.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    (least(floor(place * rate + shift) - floor((place - 1) * rate + shift), 3)::BIGINT * size)::BIGINT taken
FROM planned
"""

ORACLES["op6_rule_ledger"] = rf"""
WITH texts AS (SELECT row_number() OVER () r, doc_id, coalesce(text, '') text, {WORDS} w FROM documents),
lines AS (SELECT r, len(l) n_lines, len(l) - len(list_distinct(l)) n_dup_lines
    FROM (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) l FROM texts)),
windows AS (SELECT r, unnest(range(1, len(w) - 3)) i, w FROM texts),
named AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') g FROM windows),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) c FROM named) WHERE c > 1),
covered AS (SELECT r, sum(least(5, coalesce(i - before, 5))) n FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) before FROM repeated) GROUP BY r),
measured AS (SELECT doc_id, len(w)::BIGINT n_words, length(regexp_replace(text, '[ \t-\r]+', '', 'g'))::BIGINT word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT n_symbols, n_lines, n_dup_lines::BIGINT n_dup_lines, coalesce(n, 0)::BIGINT n_repeat_words
    FROM texts JOIN lines USING (r) LEFT JOIN covered USING (r)),
bits AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
        + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END)::BIGINT failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 base_failed, failed = 0 kept, failed FROM bits
"""

ORACLES["op9_pivot_topk"] = """
WITH vectors AS (SELECT row_number() OVER () r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.r, q.vec_id query_id, c.vec_id, list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT score
    FROM vectors q JOIN vectors c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
