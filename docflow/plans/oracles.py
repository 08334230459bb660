"""The same results in DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

from docflow.functions.paths import MEDIA_TYPES
from docflow.functions.lexicon import STOP_WORDS
from docflow.operators.enrich import CONTACT_RULES, FIELD_RULES
from docflow.plans import fixtures as X

ORACLES: dict[str, str] = {}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(terms: list[str]) -> str:
    return ", ".join(lit(t) for t in terms)


def tok(x: str) -> str:
    return rf"list_filter(string_split_regex(lower({x}), '[^\p{{L}}]+'), lambda t: t <> '')"


def share(x: str) -> str:
    return rf"(CASE WHEN length({x}) > 0 THEN length(regexp_replace({x}, '[^\p{{L}}]', '', 'g')) / length({x}) ELSE 0 END)"


def last(x: str) -> str:
    return f"regexp_extract({x}, '([^/]+)$', 1)"


DOCS = """docs AS (
  SELECT doc_id, source || '/' || lang || '/' || doc_id || '.' || (['pdf', 'pptx', 'docx'])[doc_id % 3 + 1] AS path,
         text, lang, source, n_chars, CAST(ceil(length(text) / 500) AS INTEGER) AS page_count
  FROM documents)"""

LINES = f"""lines AS (
  SELECT doc_id, pos, content, round({share("content")}, 4) AS confidence,
         CASE WHEN pos = 0 AND length(content) <= 80 THEN 'title'
              WHEN length(content) <= 40 THEN 'section_header' ELSE 'text' END AS type
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS content,
               CAST(unnest(range(len(string_split(text, chr(10))))) AS INTEGER) AS pos
        FROM documents)
  WHERE trim(content, ' ') <> '')"""

PAGED = """paged AS (
  SELECT doc_id, page_no, substr(text, (page_no - 1) * 500 + 1, 500) AS content
  FROM (SELECT doc_id, text, CAST(unnest(range(1, page_count + 1)) AS INTEGER) AS page_no FROM docs)
  WHERE trim(substr(text, (page_no - 1) * 500 + 1, 500), ' ') <> '')"""


def _label_list(tokens: str) -> str:
    entries = ", ".join(
        f"{{'rank': -len(list_filter({tokens}, lambda t: t IN ({words(terms)}))), 'label': {lit(label)}}}"
        for label, terms in X.LEXICON.items()
    )
    return f"list_sort([{entries}])[1]"


LABELLED = f"""labelled AS (
  SELECT doc_id, CASE WHEN best.rank < 0 THEN best.label ELSE 'other' END AS label,
         CAST(CASE WHEN best.rank < 0 THEN -best.rank ELSE 0 END AS INTEGER) AS score
  FROM (SELECT doc_id, {_label_list("tokens")} AS best FROM (SELECT doc_id, {tok("text")} AS tokens FROM documents)))"""

PIECES = f"""placed AS (
  SELECT doc_id, pos, content,
         CAST(floor(coalesce(sum(length(content)) OVER earlier, 0) / 1000) AS BIGINT) AS chunk_no,
         first_value(CASE WHEN type = 'title' THEN content END IGNORE NULLS) OVER upto AS title,
         last_value(CASE WHEN type = 'section_header' THEN content END IGNORE NULLS) OVER upto AS section
  FROM lines
  WINDOW upto AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         earlier AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pieces AS (
  SELECT doc_id, chunk_no, string_agg(content, chr(10) ORDER BY pos) AS chunk_to_retrieve,
         concat_ws(chr(10), first(title ORDER BY pos), first(section ORDER BY pos), string_agg(content, chr(10) ORDER BY pos)) AS chunk_to_embed
  FROM placed GROUP BY doc_id, chunk_no)"""

SUMMARY = rf"""sents AS (
  SELECT doc_id, unnest(s) AS sentence, unnest(range(len(s))) AS pos
  FROM (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?\n]+[.!?]*'), lambda x: trim(x, ' ')), lambda x: x <> '') AS s
        FROM documents)),
weighted AS (
  SELECT doc_id, pos, term, count(*) OVER (PARTITION BY doc_id, term) AS tf
  FROM (SELECT doc_id, pos, unnest({tok("sentence")}) AS term FROM sents)),
ranked AS (
  SELECT doc_id, pos, n_words, sum(n_words) OVER (PARTITION BY doc_id ORDER BY score DESC, pos ROWS UNBOUNDED PRECEDING) AS running,
         row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS place
  FROM (SELECT doc_id, pos, sum(tf) / count(*) AS score, count(*) AS n_words FROM weighted GROUP BY doc_id, pos)),
summaries AS (
  SELECT doc_id, CASE WHEN n > 300 THEN array_to_string(string_split(s, ' ')[1:300], ' ') ELSE s END AS summary, sentences_kept,
         CAST(least(n, 300) AS BIGINT) AS summary_words
  FROM (SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS s, count(*) AS sentences_kept, sum(n_words) AS n
        FROM ranked JOIN sents USING (doc_id, pos) WHERE running <= 300 OR place = 1 GROUP BY doc_id))"""

TOPICS = f"""tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({tok("text")}) AS term FROM documents) GROUP BY doc_id, term),
topics AS (
  SELECT doc_id, term, score, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS INTEGER) AS rank
  FROM (SELECT doc_id, tf.term, round(tf * ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)), 6) AS score
        FROM tf JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term) AS d ON tf.term = d.term))"""


def field(text: str, rule: tuple[str, int, float]) -> str:
    return f"nullif(regexp_extract({text}, {lit(rule[0])}, {rule[1]}), '')"


def pig(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: CASE WHEN regexp_matches(w, '^[aeiou]') THEN w || 'way' "
        r"WHEN regexp_matches(w, '^[a-z]') THEN regexp_replace(w, '(?s)^([^aeiou]+)(.*)$', '\2\1ay') ELSE w END), ' ')"
    )


def hits(text: str, category: str) -> str:
    whens = " ".join(f"WHEN {lit(c)} THEN regexp_extract_all({text}, {lit(p)})" for c, p in X.CATEGORY_PATTERNS.items())
    return f"CASE {category} {whens} ELSE regexp_extract_all({text}, {lit(X.CATEGORY_DEFAULT)}) END"


# HTML, stated on its own: blocks begin at a block tag; tables, navigation and footers are whole.
_TAGS = (
    "html|head|body|title|h1|h2|h3|h4|h5|h6|p|br|hr|div|section|article|aside|main|header|nav|footer|address|blockquote|pre|figure|figcaption|"
    "ul|ol|li|dl|dt|dd|table|caption|thead|tbody|tfoot|tr|td|th|form|fieldset|legend|option|details|summary"
)
_KIND = """CASE WHEN tag IN ('title', 'h1') THEN 'title' WHEN tag IN ('h2', 'h3', 'h4', 'h5', 'h6') THEN 'section_header'
  WHEN tag = 'table' THEN 'table' WHEN tag IN ('caption', 'figcaption') THEN 'caption' WHEN tag = 'nav' THEN 'page_header'
  WHEN tag = 'footer' THEN 'page_footer' ELSE 'text' END"""
_BARE = r"trim(regexp_replace(regexp_replace(block, '(?s)<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g'), ' ')"
_PLAIN = _BARE
for _name, _value in [("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("apos", "''"), ("nbsp", " "), ("copy", "©"), ("middot", "·"), ("amp", "&")]:
    _PLAIN = f"replace({_PLAIN}, '&{_name};', '{_value}')"
HTML = rf"""cleaned AS (
  SELECT page_id, regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g') AS h FROM pages),
wholes AS (SELECT page_id, regexp_replace(h, '(?is)(<table\b.*?</table>|<nav\b.*?</nav>|<footer\b.*?</footer>)|(</?(?:{_TAGS})\b[^>]*>)', chr(2) || '\1\2', 'g') AS h FROM cleaned),
parts AS (SELECT page_id, string_split(regexp_replace(h, '(?is)(\x02<(?:table|nav|footer)\b[^\x02]*?</(?:table|nav|footer)>)', '\1' || chr(2), 'g'), chr(2)) AS b FROM wholes),
blocks AS (SELECT page_id, unnest(b) AS block, CAST(unnest(range(len(b))) AS INTEGER) AS pos FROM parts),
web AS (
  SELECT page_id, pos, type, content
  FROM (SELECT page_id, pos, {_KIND} AS type, CASE WHEN tag = 'table' THEN block ELSE {_PLAIN} END AS content
        FROM (SELECT *, lower(regexp_extract(block, '^<([A-Za-z0-9]+)', 1)) AS tag FROM blocks))
  WHERE trim(content, ' ') <> '')"""


def latest(where: str, keys: str = "user_id", columns: str = "*") -> str:
    return (
        f"SELECT {columns} FROM events WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC, event_id DESC) = 1"
    )


# ---- sources and paths

ORACLES["file_name"] = f"SELECT page_id, {last('url')} AS by_pattern, string_split(url, '/')[-1] AS by_split FROM pages"

_MIME = "CASE extension " + " ".join(f"WHEN {lit(e)} THEN {lit(m)}" for e, m in MEDIA_TYPES.items()) + " ELSE 'application/octet-stream' END"
ORACLES["file_metadata"] = f"""WITH {DOCS}
SELECT path, n_chars AS length, file_name, extension, {_MIME} AS mime_type, parent_path, preview
FROM (SELECT path, n_chars, {last("path")} AS file_name, lower(regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1)) AS extension,
             source || '/' || lang AS parent_path, left(text, 100) AS preview FROM docs)
WHERE n_chars > 1000 AND parent_path <> 'src3/en' AND {_MIME} <> 'application/octet-stream'"""

ORACLES["rescued_fields"] = """SELECT event_id, k AS rescued_key, json_extract_string(props, '$."' || k || '"') AS rescued_value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) WHERE k NOT IN ('channel', 'region')"""

ORACLES["multi_source_union"] = """
SELECT 'documents' AS source_kind, doc_id AS key, CAST(length(text) AS BIGINT) AS n_chars, lang, NULL AS url, NULL AS role FROM documents
UNION ALL SELECT 'pages', page_id, length(html), NULL, url, NULL FROM pages
UNION ALL SELECT 'conversations', conv_id, length(text), NULL, NULL, role FROM conversations"""

ORACLES["new_files_only"] = """SELECT page_id, url AS path FROM pages
WHERE url NOT IN (SELECT url FROM pages WHERE url LIKE 'http://%')"""

# ---- bronze

ORACLES["bronze_events"] = """WITH conditioned AS (
  SELECT try_cast(CASE WHEN value < 1 THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS event_ts,
         CAST(event_id AS VARCHAR) AS transaction_id, upper(event_type) AS region,
         CASE WHEN event_type <> 'error' THEN value END AS amount
  FROM events)
SELECT event_ts, transaction_id, region, amount,
       sha256(concat_ws('||', CAST(event_ts AS VARCHAR), transaction_id, region, CAST(amount AS VARCHAR))) AS _raw_checksum
FROM conditioned WHERE event_ts IS NOT NULL AND transaction_id IS NOT NULL"""

_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ORACLES["row_checksum"] = f"""SELECT event_id,
  sha256(concat_ws('||', {", ".join(f"CAST({c} AS VARCHAR)" for c in _COLS)})) AS checksum,
  sha256(concat_ws('||', {", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _COLS)})) AS checksum_nulls_kept
FROM events"""

ORACLES["rows_per_source"] = "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 20"
ORACLES["events_since"] = "SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20'"
ORACLES["recent_events"] = "SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 20"

# ---- pages and routing

ORACLES["route_by_page_count"] = f"""WITH {DOCS}
SELECT doc_id, page_count, CASE WHEN page_count > 10 THEN 'long' ELSE 'short' END AS route FROM docs"""

ORACLES["route_by_file_type"] = f"""WITH {DOCS}
SELECT ext, CASE ext WHEN 'pdf' THEN 'full_parse' WHEN 'pptx' THEN 'slide_images' WHEN 'docx' THEN 'text_only' ELSE 'other' END AS route,
       count(*) AS n
FROM (SELECT regexp_extract(path, '[a-z]+$') AS ext FROM docs) GROUP BY ext"""

ORACLES["parse_by_file_type"] = f"""WITH {DOCS}, typed AS (SELECT *, regexp_extract(path, '[a-z]+$') AS ext FROM docs)
SELECT doc_id, CASE ext WHEN 'pdf' THEN 'full_parse' WHEN 'pptx' THEN 'slide_images' ELSE 'text_only' END AS route,
       CAST(CASE ext WHEN 'pdf' THEN page_count WHEN 'pptx' THEN len(string_split(text, chr(10))) ELSE 1 END AS INTEGER) AS elements,
       CAST(CASE ext WHEN 'pptx' THEN length(replace(text, chr(10), '')) ELSE length(text) END AS INTEGER) AS chars FROM typed"""

ORACLES["page_chunks"] = f"""WITH {DOCS}, firsts AS (
  SELECT doc_id, page_count, CAST(unnest(range(CAST(ceil(page_count / 10) AS BIGINT))) AS INTEGER) AS chunk_idx FROM docs)
SELECT doc_id, chunk_idx, (chunk_idx * 10 + 1) || '-' || least(chunk_idx * 10 + 10, page_count) AS page_range FROM firsts"""

ORACLES["page_stats"] = f"""WITH {DOCS}
SELECT lang, count(*) AS documents, max(page_count) AS max_pages, CAST(sum(page_count) AS BIGINT) AS total_pages FROM docs GROUP BY lang"""

# ---- parsing

ORACLES["parse_pages_html"] = f"WITH {HTML} SELECT * FROM web"
ORACLES["flatten_elements"] = f"WITH {LINES} SELECT doc_id, pos, type, content, confidence FROM lines"
ORACLES["page_elements"] = f"WITH {DOCS}, {PAGED} SELECT * FROM paged"
ORACLES["element_counts"] = f"""WITH {DOCS}
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS elements, page_count AS pages FROM docs"""
ORACLES["merge_chunks"] = f"""WITH {DOCS}
SELECT doc_id, CAST(ceil(page_count / 10) AS BIGINT) AS chunk_count, page_count AS elements, md5(text) AS text_md5
FROM docs WHERE page_count > 0"""
ORACLES["parsed_documents"] = f"""WITH {DOCS}, counted AS (
  SELECT doc_id, text, page_count AS pages,
         CAST(CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN ceil(page_count / 2) ELSE page_count END AS INTEGER) AS given FROM docs)
SELECT doc_id, CAST(CASE WHEN given > 10 THEN ceil(given / 10) ELSE 1 END AS BIGINT) AS chunk_count,
       coalesce(given, pages) AS elements, md5(text) AS text_md5 FROM counted"""
ORACLES["parse_quarantine"] = f"""WITH {DOCS}, judged AS (
  SELECT doc_id, path, CASE WHEN text IS NULL OR trim(text, ' ') = '' THEN 'empty'
                            WHEN {share("text")} < 0.6 THEN 'unreadable' END AS reason FROM docs
  UNION ALL SELECT doc_id, 'lost/' || path, 'empty' FROM docs)
SELECT doc_id, path, CASE WHEN reason IS NULL THEN 'ok' ELSE 'quarantined' END AS status, reason FROM judged"""
ORACLES["confidence_stats"] = f"""WITH {LINES}
SELECT type, count(*) AS n, round(avg(confidence), 6) AS mean_confidence, min(confidence) AS min_confidence,
       round(count(*) FILTER (confidence < 0.8) / count(*), 6) AS low_share FROM lines GROUP BY type"""
ORACLES["html_table_cells"] = """WITH numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS row_no FROM lineitem)
SELECT l_orderkey, row_no, 0 AS col_no, CAST(l_linenumber AS VARCHAR) AS cell FROM numbered
UNION ALL SELECT l_orderkey, row_no, 1, CAST(l_partkey AS VARCHAR) FROM numbered
UNION ALL SELECT l_orderkey, row_no, 2, CAST(l_suppkey AS VARCHAR) FROM numbered"""

# ---- text

ORACLES["full_text"] = f"""WITH {LINES}, joined AS (
  SELECT doc_id, string_agg(content, chr(10) || chr(10) ORDER BY pos) AS full_text FROM lines GROUP BY doc_id)
SELECT doc_id, coalesce(full_text, '') AS full_text, CAST(length(coalesce(full_text, '')) AS INTEGER) AS full_text_len
FROM documents LEFT JOIN joined USING (doc_id)"""
ORACLES["prep_search_chunks"] = f"WITH {LINES}, {PIECES} SELECT * FROM pieces"
ORACLES["document_text"] = f"""WITH {LINES}, {PIECES}
SELECT doc_id, string_agg(chunk_to_retrieve, ' ' ORDER BY chunk_no) AS text,
       string_agg(chunk_to_embed, ' ' ORDER BY chunk_no) AS text_with_context FROM pieces GROUP BY doc_id"""
ORACLES["nested_pages"] = f"""WITH {DOCS}, {PAGED}
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_pages,
       CAST(to_json(list({{'page': page_no, 'text': content}} ORDER BY page_no)) AS VARCHAR) AS pages FROM paged GROUP BY doc_id"""
ORACLES["truncate_text"] = "SELECT doc_id, left(text, 4000) AS prompt_text, length(text) > 4000 AS truncated FROM documents"
ORACLES["pig_latin"] = f"SELECT doc_id, {pig('text')} AS pig_latin FROM documents"

# ---- enrichment

ORACLES["classify_documents"] = f"WITH {LABELLED} SELECT doc_id, label, score FROM labelled"
ORACLES["classification_result"] = f"""WITH {LABELLED}, judged AS (
  SELECT doc_id, label, {share("text")} < 0.6 AS bad FROM documents JOIN labelled USING (doc_id))
SELECT doc_id,
  CASE WHEN bad THEN '{{"response":null,"error_message":"unreadable"}}' ELSE '{{"response":["' || label || '"],"error_message":null}}' END AS response,
  CASE WHEN NOT bad THEN label END AS label, CASE WHEN bad THEN 'unreadable' END AS error_message FROM judged"""
ORACLES["sql_functions"] = f"""WITH {DOCS}, {LABELLED}
SELECT doc_id, {last("path")} AS file_name, label AS category, {field("text", FIELD_RULES["title"])} AS title,
       {field("text", FIELD_RULES["author"])} AS author, CAST(ceil(page_count / 10) AS INTEGER) AS n_ranges
FROM docs JOIN labelled USING (doc_id)"""
ORACLES["extract_fields"] = "\nUNION ALL ".join(
    f"""SELECT doc_id, {lit(name)} AS field, v AS value, CAST(CASE WHEN v IS NOT NULL THEN instr(text, v) ELSE 0 END AS INTEGER) AS "offset",
  CAST(CASE WHEN v IS NOT NULL THEN {rule[2]} END AS DOUBLE) AS confidence
FROM (SELECT doc_id, text, {field("text", rule)} AS v FROM documents)"""
    for name, rule in CONTACT_RULES.items()
)
ORACLES["category_aware_extract"] = f"""WITH {LABELLED}
SELECT doc_id, label AS category, CAST(len(h) AS INTEGER) AS n_hits, h[1] AS first_hit
FROM (SELECT doc_id, label, {hits("text", "label")} AS h FROM documents JOIN labelled USING (doc_id))"""
ORACLES["summarize_documents"] = f"WITH {SUMMARY} SELECT * FROM summaries"
ORACLES["key_topics"] = f"WITH {TOPICS} SELECT doc_id, term, score, rank FROM topics WHERE rank <= 5"
ORACLES["sentiment"] = f"""WITH scored AS (
  SELECT conv_id, turn, CAST(len(list_filter(tokens, lambda t: t IN ({words(X.POSITIVE)})))
                           - len(list_filter(tokens, lambda t: t IN ({words(X.NEGATIVE)}))) AS INTEGER) AS score
  FROM (SELECT conv_id, turn, {tok("text")} AS tokens FROM conversations))
SELECT *, CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment FROM scored"""
ORACLES["enrichment_chain"] = f"""WITH {LABELLED}, {SUMMARY}
SELECT doc_id, label AS category, CAST(len({hits("text", "label")}) AS INTEGER) AS n_entities, coalesce(summary_words, 0) AS summary_words
FROM documents JOIN labelled USING (doc_id) LEFT JOIN summaries USING (doc_id)"""
_FIELDS = ", ".join(f"{field('text', FIELD_RULES[n])} AS {n}" for n in ("title", "company", "product", "author", "date"))
ORACLES["enriched_documents"] = f"""WITH {DOCS}, {LABELLED}, {SUMMARY}, {TOPICS},
top AS (SELECT doc_id, string_agg(term, ',' ORDER BY rank) AS key_topics FROM topics WHERE rank <= 5 GROUP BY doc_id)
SELECT doc_id, sha256(path) AS doc_key, label AS category, CAST(NULL AS VARCHAR) AS error_message, {_FIELDS}, key_topics, summary,
       {pig("summary")} AS summary_pig_latin
FROM docs JOIN labelled USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN summaries USING (doc_id)"""
ORACLES["model_enrich"] = """SELECT doc_id,
  CASE WHEN NOT contains(text, 'token') THEN length(text) || ':' || array_to_string(string_split(text, ' ')[1:5], ' ') END AS result,
  CASE WHEN contains(text, 'token') THEN 'ValueError: refused' END AS error_message FROM documents"""

# ---- similarity and search


ORACLES["near_duplicates"] = r"""WITH tokenised AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda t: t <> '') AS w FROM documents),
hashed AS (SELECT doc_id, w, min(doc_id) OVER (PARTITION BY array_to_string(w, ' ')) AS rep FROM tokenised),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM hashed WHERE doc_id = rep)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
alike AS (SELECT x, y, round(c / (p.n + q.n - c), 6) AS sim FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y)
SELECT doc_id, rep AS duplicate_of, CAST(1.0 AS DOUBLE) AS similarity FROM hashed WHERE doc_id <> rep
UNION ALL SELECT y, min(x), arg_min(sim, x) FROM alike WHERE sim >= 0.8 GROUP BY y"""

ORACLES["compare_extractions"] = rf"""WITH {HTML},
a AS (SELECT page_id, {tok("string_agg(content, ' ' ORDER BY pos)")} AS w FROM web GROUP BY page_id),
articles AS (SELECT page_id, regexp_extract(html, '(?is)<article\b.*</article>') AS block FROM pages),
b AS (SELECT page_id, {tok(_PLAIN)} AS w FROM articles),
sides AS (SELECT page_id, coalesce(a.w, []) AS u, coalesce(b.w, []) AS v FROM a FULL JOIN b USING (page_id))
SELECT page_id, CAST(len(u) AS INTEGER) AS words_a, CAST(len(v) AS INTEGER) AS words_b,
       round(CASE WHEN len(list_distinct(u || v)) > 0 THEN len(list_intersect(list_distinct(u), list_distinct(v))) / len(list_distinct(u || v)) END, 6) AS similarity
FROM sides"""

_POSTS = f"""posts AS (
  SELECT term, doc_id, count(*) AS tf
  FROM (SELECT doc_id, unnest({tok("text")}) AS term FROM documents) WHERE term NOT IN ({words(STOP_WORDS)}) GROUP BY term, doc_id)"""
ORACLES["inverted_index"] = f"WITH {_POSTS} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf FROM posts GROUP BY term"

ORACLES["english_index"] = f"""WITH one AS (
  SELECT doc_id, regexp_replace(regexp_replace(term, '(ss|i)es$', '\\1'), '([^s])s$', '\\1') AS t
  FROM (SELECT doc_id, unnest({tok("text")}) AS term FROM documents WHERE lang = 'en') WHERE term NOT IN ({words(STOP_WORDS)})),
two AS (SELECT doc_id, t, regexp_extract(t, '^(.*[aeiouy].*)(ed|ing)$', 1) AS b FROM one),
three AS (
  SELECT doc_id, CASE WHEN suffix(t, 'eed') THEN regexp_replace(t, '([aeiouy][^aeiouy].*)eed$', '\\1ee') WHEN b = '' THEN t
                      WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e'
                      WHEN length(b) > 1 AND b[-1] = b[-2] AND NOT regexp_matches(b, '[aeiouylsz]$') THEN b[:-2] ELSE b END AS t FROM two),
posts AS (SELECT regexp_replace(t, '([aeiouy].*)y$', '\\1i') AS term, doc_id, count(*) AS tf FROM three GROUP BY ALL)
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf FROM posts GROUP BY term"""

_QUERIES = " UNION ALL ".join(f"SELECT {lit(q)} AS query, unnest([{words(ts)}]) AS term" for q, ts in X.QUERIES.items())
ORACLES["search_bm25"] = f"""WITH en AS (SELECT * FROM documents WHERE lang = 'en'),
posts AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({tok("text")}) AS term FROM en)
  WHERE term NOT IN ({words(STOP_WORDS)}) GROUP BY doc_id, term),
lens AS (SELECT doc_id, coalesce(sum(tf), 0) AS len FROM en LEFT JOIN posts USING (doc_id) GROUP BY doc_id),
totals AS (SELECT count(*) AS n, avg(len) AS avg_len FROM lens),
stats AS (SELECT term, count(*) AS df FROM posts GROUP BY term),
queries AS ({_QUERIES}),
scored AS (
  SELECT query, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len / avg_len))), 6) AS score
  FROM queries JOIN posts USING (term) JOIN stats USING (term) JOIN lens USING (doc_id), totals GROUP BY query, doc_id)
SELECT query, doc_id, score, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored
QUALIFY rank <= 10"""

ORACLES["search_postings"] = ORACLES["search_bm25"]

ORACLES["page_index"] = f"""WITH {DOCS}, {PAGED}
SELECT doc_id, page_no, term, count(*) AS tf FROM (SELECT doc_id, page_no, unnest({tok("content")}) AS term FROM paged)
WHERE term IN ({words(X.PAGE_TERMS)}) GROUP BY doc_id, page_no, term"""

ORACLES["knn_cosine"] = """WITH flat AS (
  SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM embeddings),
centroids AS (
  SELECT label, list(x ORDER BY pos) AS c FROM (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM flat GROUP BY label, pos) GROUP BY label),
scored AS (
  SELECT q.label AS query_id, vec_id, round(list_cosine_similarity(c, list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS score
  FROM centroids q, embeddings e)
SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM scored QUALIFY rank <= 5"""

# Every query against every other row.
ORACLES["knn_buckets"] = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS e FROM embeddings),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, round(list_cosine_similarity(q.e, c.e), 6) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM scored QUALIFY rank <= 5"""

ORACLES["text_embeddings"] = f"""WITH tf AS (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 64 AS INTEGER) AS place, count(*) AS tf
  FROM (SELECT doc_id, unnest({tok("text")}) AS term FROM documents) GROUP BY ALL),
df AS (SELECT place, count(*) AS f FROM tf GROUP BY place)
SELECT doc_id, place, round(tf * ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + f)), 6) AS weight FROM tf JOIN df USING (place) WHERE weight <> 0"""

ORACLES["trained_labels"] = f"""WITH terms AS (SELECT doc_id, unnest({tok("text")}) AS term FROM documents),
counts AS (SELECT quality, term, count(*) AS c FROM terms JOIN labels USING (doc_id) GROUP BY ALL),
vocabulary AS (SELECT count(DISTINCT term) AS v FROM counts),
classes AS (SELECT quality, docs, coalesce(n, 0) AS n, docs / sum(docs) OVER () AS prior
  FROM (SELECT quality, count(*) AS docs FROM labels JOIN documents USING (doc_id) GROUP BY quality) LEFT JOIN (SELECT quality, sum(c) AS n FROM counts GROUP BY quality) USING (quality)),
known AS (SELECT DISTINCT term FROM counts),
told AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM known) GROUP BY ALL),
summed AS (
  SELECT doc_id, k.quality, sum(tf * ln((coalesce(c, 0) + 1.0::DOUBLE) / (n + v))) AS s
  FROM told CROSS JOIN classes k CROSS JOIN vocabulary LEFT JOIN counts x ON x.term = told.term AND x.quality = k.quality GROUP BY doc_id, k.quality),
scored AS (SELECT d.doc_id, k.quality, round(coalesce(s, 0) + ln(prior), 6) AS s FROM documents d CROSS JOIN classes k LEFT JOIN summed t ON t.doc_id = d.doc_id AND t.quality = k.quality)
SELECT doc_id, quality FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, quality) = 1"""

_INDEX = f"""index_rows AS (
  SELECT 'documents' AS _index, md5(path) AS _id, path, regexp_extract(path, '[a-z]+$') AS file_type, label AS category,
         {field("text", FIELD_RULES["title"])} AS title, text AS full_text, n_chars
  FROM docs JOIN labelled USING (doc_id))"""
ORACLES["index_documents"] = f"WITH {DOCS}, {LABELLED}, {_INDEX} SELECT * FROM index_rows"
_REVISED = "CASE WHEN category = 'technical' THEN 'revised' ELSE category END AS category"
ORACLES["index_scan"] = f"WITH {DOCS}, {LABELLED}, {_INDEX} SELECT _id, path, file_type, {_REVISED}, full_text, n_chars FROM index_rows"
ORACLES["match_all"] = f"WITH {DOCS}, {LABELLED}, {_INDEX} SELECT _id, path, {_REVISED} FROM index_rows ORDER BY _id LIMIT 1000"

# ---- quality

ORACLES["expect_or_drop"] = "SELECT doc_id, lang, n_chars FROM documents WHERE text IS NOT NULL AND n_chars > 0 AND n_chars < 5000"
ORACLES["drop_counts"] = " UNION ALL ".join(
    f"SELECT {lit(r)} AS rule, count(*) AS total, count(*) FILTER (NOT coalesce({c}, false)) AS failed, "
    f"count(*) FILTER (NOT coalesce({' AND '.join(X.RULES.values())}, false)) AS dropped FROM documents"
    for r, c in X.RULES.items()
)
ORACLES["quarantine"] = "SELECT doc_id, concat_ws(',', {}) AS failed_rules FROM documents".format(
    ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN {lit(r)} END" for r, c in X.RULES.items())
)


def _metrics(rules: dict[str, str], source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"SELECT {lead}{lit(r)} AS rule, count(*) AS total, count(*) FILTER ({c}) AS passed, count(*) - count(*) FILTER ({c}) AS failed, "
        f"round(count(*) FILTER ({c}) / count(*), 6) AS pass_rate FROM {source}{group}"
        for r, c in rules.items()
    )


ORACLES["expectation_metrics"] = _metrics(X.RULES, "documents")
_DAILY = _metrics(X.EVENT_RULES, "(SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events)", "day")
ORACLES["quality_trend"] = f"""SELECT day, rule, pass_rate, lag(pass_rate) OVER (PARTITION BY rule ORDER BY day) AS previous_rate,
  round(avg(pass_rate) OVER (PARTITION BY rule ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS mean_rate FROM ({_DAILY})"""
ORACLES["quality_alerts"] = f"SELECT day, rule, total, failed, pass_rate FROM ({_DAILY}) WHERE pass_rate < 0.8"
ORACLES["stage_metrics"] = f"WITH {DOCS} " + " UNION ALL ".join(
    f"SELECT {lit(name)} AS stage, count(*) FILTER ({before}) AS rows_in, count(*) FILTER ({after}) AS rows_out, "
    f"CAST(coalesce(sum(n_chars) FILTER ({after}), 0) AS BIGINT) AS chars_out FROM docs"
    for name, before, after in X.STAGES
)

# ---- changes

ORACLES["latest_version"] = latest("true")
ORACLES["as_of_snapshot"] = latest("ts <= TIMESTAMP '2024-01-16'")
ORACLES["changed_documents"] = """WITH current AS (SELECT user_id, max(ts) AS "modificationTime" FROM events GROUP BY user_id),
tracking AS (SELECT user_id, max(ts) AS seen FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT user_id, "modificationTime", CASE WHEN seen IS NULL THEN 'new' ELSE 'updated' END AS change
FROM current LEFT JOIN tracking USING (user_id) WHERE seen IS NULL OR "modificationTime" > seen"""
_FIVE = "user_id, ts, event_id, event_type, value"
ORACLES["merge_upsert"] = f"""WITH t AS ({latest("event_type IN ('click', 'view')", columns=_FIVE)}),
s AS ({latest("event_type NOT IN ('click', 'view')", columns=_FIVE)}),
m AS (
  SELECT s.* EXCLUDE (user_id), s.user_id AS user_id, CASE WHEN t.user_id IS NULL THEN 'insert' ELSE 'update' END AS action
  FROM s LEFT JOIN t ON s.user_id = t.user_id WHERE t.user_id IS NULL OR s.ts > t.ts
  UNION ALL BY NAME
  SELECT t.*, 'keep' AS action FROM t LEFT JOIN s ON s.user_id = t.user_id WHERE s.user_id IS NULL OR NOT s.ts > t.ts)
SELECT user_id, ts, event_id, event_type, value, action FROM m"""
_PAIR = "user_id, event_type"
ORACLES["change_feed"] = f"""WITH b AS ({latest("ts < TIMESTAMP '2024-01-16'", _PAIR, "user_id, event_type, ts, event_id, value")}),
a AS ({latest("ts >= TIMESTAMP '2024-01-12'", _PAIR, "user_id, event_type, ts, event_id, value")})
SELECT user_id, event_type, CASE WHEN b.ts IS NULL THEN 'insert' WHEN a.ts IS NULL THEN 'delete' ELSE 'update' END AS change, 'days' AS feed
FROM b FULL JOIN a USING (user_id, event_type)
WHERE b.ts IS NULL OR a.ts IS NULL OR (a.ts, a.event_id, a.value) <> (b.ts, b.event_id, b.value)
UNION ALL SELECT user_id, event_type, 'update', 'microseconds' FROM b WHERE event_id % 3 <> 0"""
ORACLES["dedup_documents"] = f"""SELECT content_hash, min(doc_id) AS doc_id, count(*) AS copies
FROM (SELECT doc_id, sha256(array_to_string({tok("text")}, ' ')) AS content_hash FROM documents) GROUP BY content_hash"""
ORACLES["enrichment_batches"] = """SELECT batch, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id
FROM (SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 8 AS batch FROM documents) GROUP BY batch"""
