"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions import elements as E
from docflow.functions import paths as P
from docflow.functions import text as T
from docflow.functions.sql import register_functions
from docflow.operators import bronze, changes, enrich, flatten, pages, parsing, quality, routing, search, similarity
from docflow.operators.model import embed_text, hash_batch, label_by_words, model_enrich
from docflow.plans import fixtures as X
from docflow.plans.medallion import run_chain
from docflow.session import scratch_path
from docflow.sinks import bulk
from docflow.sources import files, rescue

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- sources and paths ------------------------------------------------------------------------


@query
def file_name(spark, sf):
    p = X.table(spark, sf, "pages")
    return p.select("page_id", P.file_name("url").alias("by_pattern"), P.last_segment("url").alias("by_split"))


@query
def file_metadata(spark, sf):
    d = X.documents(spark, sf).select("path", F.col("n_chars").alias("length"), files.file_metadata().alias("m"), files.preview("text").alias("preview"))
    kept = d.filter((F.col("length") > 1000) & (F.col("m.parent_path") != "src3/en") & (F.col("m.mime_type") != "application/octet-stream"))
    return kept.select("path", "length", "m.file_name", "m.extension", "m.mime_type", "m.parent_path", "preview")


@query
def rescued_fields(spark, sf):
    return rescue.rescued_fields(X.events(spark, sf), "props", ["channel", "region"], ("event_id",))


@query
def multi_source_union(spark, sf):
    docs = X.table(spark, sf, "documents").select(F.col("doc_id").alias("key"), F.length("text").alias("n_chars"), "lang")
    web = X.table(spark, sf, "pages").select(F.col("page_id").alias("key"), F.length("html").alias("n_chars"), "url")
    chat = X.table(spark, sf, "conversations").select(F.col("conv_id").alias("key"), F.length("text").alias("n_chars"), "role")
    out = files.union_sources(documents=docs, pages=web, conversations=chat)
    return out.withColumn("n_chars", F.col("n_chars").cast("bigint"))


@query
def new_files_only(spark, sf):
    listing = X.table(spark, sf, "pages").select("page_id", F.col("url").alias("path"))
    log = listing.filter(F.col("path").startswith("http://"))
    return changes.new_files_only(listing, log)


# ---- bronze -----------------------------------------------------------------------------------


def _raw_events(spark, sf):
    e = X.events(spark, sf)
    raw = e.select(
        F.when(F.col("value") < 1, "not a time").otherwise(F.col("ts").cast("string")).alias("event_ts"),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("region"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("amount"),
    )
    return raw.unionByName(raw)


@query
def bronze_events(spark, sf):
    out = bronze.bronze_events(_raw_events(spark, sf))
    return out.select(F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "transaction_id", "region", "amount", "_raw_checksum")


@query
def row_checksum(spark, sf):
    e = X.events(spark, sf)
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    return e.select("event_id", T.column_checksum(cols).alias("checksum"), T.column_checksum(cols, "~").alias("checksum_nulls_kept"))


@query
def rows_per_source(spark, sf):
    return bronze.rows_per_source(X.table(spark, sf, "documents"), "source")


@query
def events_since(spark, sf):
    return X.events(spark, sf).filter(F.col("ts") >= X.ts("2024-01-20")).select("event_id", "ts", "event_type")


@query
def recent_events(spark, sf):
    return quality.recent(X.events(spark, sf).select("event_id", "ts", "event_type", "value"), "ts", "event_id")


# ---- pages and routing ------------------------------------------------------------------------


@query
def route_by_page_count(spark, sf):
    d = X.documents(spark, sf).select("doc_id", "page_count")
    return pages.route_by_page_count(d, X.PAGE_LIMIT)


@query
def route_by_file_type(spark, sf):
    return routing.route_counts(routing.route_by_file_type(X.documents(spark, sf).select("path")), "ext", "route")


@query
def parse_by_file_type(spark, sf):
    """Pages of PDFs, lines of slides, the text of other documents as one element."""

    def by(elements: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
        return lambda d: d.select("doc_id", "route", elements().alias("e"))

    whole = lambda: F.array(E.element(F.lit("text"), F.col("text"), F.lit(0)))
    strategies = {
        "full_parse": by(lambda: E.page_elements("text", F.lit(1), F.col("page_count"))),
        "slide_images": by(lambda: E.line_elements("text")),
        "text_only": by(whole),
    }
    done = routing.process_by_route(routing.route_by_file_type(X.documents(spark, sf)), strategies)
    chars = F.aggregate("e", F.lit(0), lambda a, x: a + F.length(x["content"]))
    return done.select("doc_id", "route", F.size("e").alias("elements"), chars.alias("chars"))


@query
def page_chunks(spark, sf):
    d = X.documents(spark, sf).select("doc_id", "page_count")
    return pages.explode_page_ranges(d, X.PAGE_LIMIT).select("doc_id", "chunk_idx", "page_range")


@query
def page_stats(spark, sf):
    return pages.page_stats(X.documents(spark, sf), "lang")


# ---- parsing ----------------------------------------------------------------------------------


@query
def parse_pages_html(spark, sf):
    p = X.table(spark, sf, "pages")
    rows = flatten.flatten_elements(p, E.html_elements("html"), ("page_id",))
    return rows.select("page_id", "pos", "type", "content")


@query
def flatten_elements(spark, sf):
    return X.line_rows(spark, sf).select("doc_id", "pos", "type", "content", "confidence")


@query
def page_elements(spark, sf):
    d = X.documents(spark, sf)
    paged = E.page_elements("text", F.lit(1), F.col("page_count"))
    return flatten.flatten_elements(d, paged).select("doc_id", "page_no", "content")


@query
def element_counts(spark, sf):
    d = X.documents(spark, sf)
    v = parsing.parsed_variant(E.line_elements("text"), parsing.page_list(F.lit(1), F.col("page_count")), F.lit(None), P.file_name("path"))
    return flatten.element_counts(d.select("doc_id", v.alias("parsed")))


def _merged(parsed: DataFrame) -> DataFrame:
    e = flatten.parsed_elements()
    return parsed.select(
        "doc_id",
        "chunk_count",
        F.size(e).alias("elements"),
        F.md5(F.array_join(F.transform(e, lambda x: x["content"]), "")).alias("text_md5"),
    )


@query
def merge_chunks(spark, sf):
    d = X.documents(spark, sf).select("doc_id", "path", "page_count", "text")
    chunks = parsing.parse_text_chunks(parsing.text_chunks(d, X.PAGE_LIMIT))
    return _merged(parsing.merge_chunks(chunks, ["doc_id"]))


@query
def parsed_documents(spark, sf):
    # Unknown and stale page counts among the right ones.
    count = F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 5 == 0, F.ceil(F.col("page_count") / 2)).otherwise(F.col("page_count"))
    d = X.documents(spark, sf).select("doc_id", "path", count.cast("int").alias("page_count"), "text")
    return _merged(parsing.parse_text_documents(d, X.PAGE_LIMIT, ["doc_id", "path"]))


@query
def parse_quarantine(spark, sf):
    d = X.documents(spark, sf).select("doc_id", "path", "text")
    # Missing and empty inputs next to the given ones.
    lost = d.select("doc_id", F.concat(F.lit("lost/"), "path").alias("path"), F.lit(None).cast("string").alias("text"))
    d = d.unionByName(lost)
    error = parsing.text_error(F.col("text"))
    n = F.lit(0)
    v = parsing.parsed_variant(E.line_elements(F.coalesce("text", F.lit(""))), parsing.page_list(F.lit(1), n), error, P.file_name("path"))
    return parsing.parse_status(d.select("doc_id", "path", v.alias("parsed")), ["doc_id", "path"])


@query
def confidence_stats(spark, sf):
    return flatten.confidence_stats(X.line_rows(spark, sf))


@query
def html_table_cells(spark, sf):
    li = X.table(spark, sf, "lineitem")
    row = F.concat(
        F.lit("<tr><td>"), F.col("l_linenumber").cast("string"), F.lit("</td><td class=k>"), F.col("l_partkey").cast("string"),
        F.lit("</td><td><b>"), F.col("l_suppkey").cast("string"), F.lit("</b></td></tr>"),
    )
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("r"))))
    tables = li.groupBy("l_orderkey").agg(rows.alias("rows"))
    html = F.concat(F.lit("<table>"), F.array_join(F.col("rows.r"), ""), F.lit("</table>"))
    return flatten.html_table_cells(tables.select("l_orderkey", html.alias("html")), "html", ("l_orderkey",))


# ---- text -------------------------------------------------------------------------------------


@query
def full_text(spark, sf):
    t = flatten.full_text(F.filter(E.line_elements("text"), lambda e: F.trim(e["content"]) != ""))
    return X.documents(spark, sf).select("doc_id", t.alias("full_text")).select("doc_id", "full_text", F.length("full_text").alias("full_text_len"))


@query
def prep_search_chunks(spark, sf):
    return flatten.prep_search_chunks(X.line_rows(spark, sf))


@query
def document_text(spark, sf):
    return flatten.document_text(flatten.prep_search_chunks(X.line_rows(spark, sf)))


@query
def nested_pages(spark, sf):
    d = X.documents(spark, sf)
    rows = flatten.flatten_elements(d, E.page_elements("text", F.lit(1), F.col("page_count")))
    return flatten.nested_pages(rows).select("doc_id", F.size("pages").alias("n_pages"), F.to_json("pages").alias("pages"))


@query
def truncate_text(spark, sf):
    d = X.documents(spark, sf)
    return d.select("doc_id", T.truncated("text", 4000).alias("prompt_text"), (F.length("text") > 4000).alias("truncated"))


@query
def pig_latin(spark, sf):
    return X.documents(spark, sf).select("doc_id", T.pig_latin("text").alias("pig_latin"))


# ---- enrichment -------------------------------------------------------------------------------


@query
def classify_documents(spark, sf):
    return X.documents(spark, sf).select("doc_id", enrich.classify("text", X.LEXICON).alias("c")).select("doc_id", "c.label", "c.score")


@query
def classification_result(spark, sf):
    d = X.documents(spark, sf)
    error = F.when(T.letter_share("text") < 0.6, "unreadable")
    response = enrich.classification_response(enrich.classify("text", X.LEXICON)["label"], error)
    label, message = enrich.response_label("response")
    return d.select("doc_id", response.alias("response")).select("doc_id", "response", label.alias("label"), message.alias("error_message"))


@query
def sql_functions(spark, sf):
    register_functions(spark, lexicon=X.LEXICON)
    X.documents(spark, sf).createOrReplaceTempView("docflow_documents")
    return spark.sql(
        f"""
        WITH called AS (
            SELECT doc_id, file_name(path) AS file_name, classify_document(text) AS category,
                   extract_document(text) AS fields, size(chunk_page_ranges(page_count, size => {X.PAGE_LIMIT})) AS n_ranges
            FROM docflow_documents)
        SELECT doc_id, file_name, category, fields.title AS title, fields.author AS author, n_ranges FROM called"""
    )


@query
def extract_fields(spark, sf):
    found = enrich.extract_fields(X.documents(spark, sf), "text", enrich.CONTACT_RULES)
    return found.withColumn("offset", F.coalesce("offset", F.lit(0)))


@query
def category_aware_extract(spark, sf):
    d = X.documents(spark, sf).select("doc_id", "text", enrich.classify("text", X.LEXICON)["label"].alias("category"))
    hits = enrich.category_hits("text", F.col("category"), X.CATEGORY_PATTERNS, X.CATEGORY_DEFAULT)
    return d.select("doc_id", "category", hits.alias("h")).select(
        "doc_id", "category", F.size("h").alias("n_hits"), F.get("h", 0).alias("first_hit")
    )


@query
def summarize_documents(spark, sf):
    return enrich.summarize(X.documents(spark, sf))


@query
def key_topics(spark, sf):
    return enrich.key_topics(X.documents(spark, sf))


@query
def sentiment(spark, sf):
    c = X.table(spark, sf, "conversations")
    s = enrich.sentiment("text", X.POSITIVE, X.NEGATIVE)
    return c.select("conv_id", "turn", s.alias("s")).select("conv_id", "turn", "s.score", "s.sentiment")


@query
def enrichment_chain(spark, sf):
    root = scratch_path(spark, "chain")
    d = X.documents(spark, sf).select("doc_id", "text")
    steps = run_chain(d, root, X.LEXICON, X.CATEGORY_PATTERNS, X.CATEGORY_DEFAULT)
    found = steps["entities"].select("doc_id", "category", F.size("entities").alias("n_entities"))
    return enrich.combine(found, "doc_id", steps["summaries"].select("doc_id", "summary_words")).fillna(0, ["summary_words"])


@query
def enriched_documents(spark, sf):
    d = X.documents(spark, sf).select("doc_id", P.doc_key("path").alias("doc_key"), "text")
    out = enrich.enriched_documents(d, lexicon=X.LEXICON)
    return out.withColumn("key_topics", F.array_join("key_topics", ","))


@query
def model_enrich_documents(spark, sf):
    def connect():
        def call(prompt: str) -> str:
            if "token" in prompt:
                raise ValueError("refused")
            return f"{len(prompt)}:" + " ".join(prompt.split(" ")[:5])

        return call

    d = X.documents(spark, sf).select("doc_id", "text")
    return model_enrich(d, "text", connect).select("doc_id", "result", "error_message")


@query
def trained_labels(spark, sf):
    d = X.table(spark, sf, "documents").select("doc_id", "text")
    labelled = d.join(X.table(spark, sf, "labels"), "doc_id").select("text", "quality")
    return label_by_words(d, labelled, label="quality")


# ---- similarity and search --------------------------------------------------------------------


@query
def near_duplicates(spark, sf):
    return similarity.near_duplicates(X.table(spark, sf, "documents"))


@query
def compare_extractions(spark, sf):
    rows = flatten.flatten_elements(X.table(spark, sf, "pages"), E.html_elements("html"), ("page_id",))
    # Whole pages: all blocks against the article's text.
    page = rows.groupBy("page_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("pos", "content")))["content"], " ").alias("text"))
    body = X.table(spark, sf, "pages").select("page_id", E.html_text(F.regexp_extract("html", r"(?is)<article\b.*</article>", 0)).alias("text"))
    return similarity.compare_extractions(page, body, ["page_id"])


@query
def inverted_index(spark, sf):
    return search.inverted_index(search.postings(X.table(spark, sf, "documents")))


@query
def english_index(spark, sf):
    d = X.table(spark, sf, "documents").filter("lang = 'en'")
    return search.inverted_index(search.postings(d, stem=True))


@query
def search_bm25(spark, sf):
    d = X.table(spark, sf, "documents")
    return search.search_bm25(d, X.QUERIES, where=F.col("lang") == "en")


@query
def search_postings(spark, sf):
    root = scratch_path(spark, "postings")
    search.write_postings(X.table(spark, sf, "documents"), root, keywords=("lang",))
    return search.search_postings(spark, root, X.QUERIES, where=F.col("lang") == "en")


@query
def page_index(spark, sf):
    d = X.documents(spark, sf)
    rows = flatten.flatten_elements(d, E.page_elements("text", F.lit(1), F.col("page_count")))
    return search.term_hits(rows, "content", ("doc_id", "page_no"), X.PAGE_TERMS)


@query
def knn_cosine(spark, sf):
    v = X.table(spark, sf, "embeddings")
    return search.knn_cosine(v, search.label_centroids(v), "label", "centroid")


@query
def knn_buckets(spark, sf):
    v = X.table(spark, sf, "embeddings")
    return search.knn_buckets(v, v.filter("vec_id % 20 = 0"), "vec_id", "embedding", dim=64)


@query
def text_embeddings(spark, sf):
    e = embed_text(X.table(spark, sf, "documents").select("doc_id", "text"), features=64)
    return e.select("doc_id", F.posexplode("embedding").alias("place", "weight")).filter("weight <> 0")


def _index(spark, sf):
    d = X.documents(spark, sf).select(
        "path",
        P.extension("path").alias("file_type"),
        enrich.classify("text", X.LEXICON)["label"].alias("category"),
        enrich.extract_field("text", enrich.FIELD_RULES["title"])["value"].alias("title"),
        F.col("text").alias("full_text"),
        F.col("n_chars"),
    )
    mapping = {"path": "keyword", "file_type": "keyword", "category": "keyword", "title": "text", "full_text": "text", "n_chars": "long"}
    return bulk.index_documents(d, "documents", bulk.document_id("path"), mapping)


@query
def index_documents(spark, sf):
    return _index(spark, sf)


def _published(spark, sf):
    root = scratch_path(spark, "index")
    docs = _index(spark, sf)
    bulk.publish(docs, root)
    bulk.publish(docs.filter(F.col("category") == "technical").withColumn("category", F.lit("revised")), root)
    return bulk.read_index(spark, root, "path string, file_type string, category string, full_text string, n_chars bigint")


@query
def index_scan(spark, sf):
    return _published(spark, sf)


@query
def match_all(spark, sf):
    return search.match_all(_published(spark, sf).select("_id", "path", "category"), "_id")


# ---- quality ----------------------------------------------------------------------------------


@query
def expect_or_drop(spark, sf):
    rules = {"has_text": X.RULES["has_text"], "valid_size": X.RULES["valid_size"]}
    return quality.expect_or_drop(X.table(spark, sf, "documents"), rules).select("doc_id", "lang", "n_chars")


@query
def drop_counts(spark, sf):
    return quality.drop_counts(X.table(spark, sf, "documents"), X.RULES)


@query
def quarantine(spark, sf):
    good, bad = quality.quarantine(X.table(spark, sf, "documents"), X.RULES)
    ok = good.select("doc_id", F.lit("").alias("failed_rules"))
    return ok.unionByName(bad.select("doc_id", F.array_join("failed_rules", ",").alias("failed_rules")))


@query
def expectation_metrics(spark, sf):
    return quality.expectation_metrics(X.table(spark, sf, "documents"), X.RULES)


@query
def stage_metrics(spark, sf):
    return quality.stage_metrics(X.documents(spark, sf), X.STAGES, "n_chars")


def _daily(spark, sf):
    e = X.events(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return quality.expectation_metrics(e, X.EVENT_RULES, ["day"])


@query
def quality_trend(spark, sf):
    return quality.quality_trend(_daily(spark, sf)).select("day", "rule", "pass_rate", "previous_rate", "mean_rate")


@query
def quality_alerts(spark, sf):
    return quality.quality_alerts(_daily(spark, sf), 0.8).select("day", "rule", "total", "failed", "pass_rate")


# ---- changes ----------------------------------------------------------------------------------


@query
def latest_version(spark, sf):
    return changes.latest_version(X.events(spark, sf), ["user_id"], ["ts", "event_id"])


@query
def as_of_snapshot(spark, sf):
    return changes.as_of(X.events(spark, sf), ["user_id"], "ts", X.ts("2024-01-16"), ["ts", "event_id"])


@query
def changed_documents(spark, sf):
    e = X.events(spark, sf)
    current = e.groupBy("user_id").agg(F.max("ts").alias("modificationTime"))
    tracking = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("last_processed"))
    return changes.changed_documents(current, tracking, "user_id")


@query
def merge_upsert(spark, sf):
    e = X.events(spark, sf).select("user_id", "ts", "event_id", "event_type", "value")
    target = changes.latest_version(e.filter("event_type IN ('click', 'view')"), ["user_id"], ["ts", "event_id"])
    source = changes.latest_version(e.filter("event_type NOT IN ('click', 'view')"), ["user_id"], ["ts", "event_id"])
    return changes.merge_upsert(target, source, ["user_id"], "ts")


@query
def change_feed(spark, sf):
    e = X.events(spark, sf).select("user_id", "event_type", "ts", "event_id", "value")
    # Some of the newer rows differ from the older ones by a few microseconds only.
    late = F.expr("ts + make_dt_interval(0, 0, 0, (event_id % 3) * 0.000001)")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    before = changes.latest_version(e.filter(F.col("ts") < X.ts("2024-01-16")), keys, order)
    after = changes.latest_version(e.filter(F.col("ts") >= X.ts("2024-01-12")), keys, order)
    shifted = changes.latest_version(e.filter(F.col("ts") < X.ts("2024-01-16")), keys, order).withColumn("ts", late)
    old = changes.change_feed(before, after, keys).withColumn("feed", F.lit("days"))
    return old.unionByName(changes.change_feed(before, shifted, keys).withColumn("feed", F.lit("microseconds")))


@query
def dedup_documents(spark, sf):
    return changes.dedup_documents(X.table(spark, sf, "documents"), T.normalised("text"))


@query
def enrichment_batches(spark, sf):
    d = X.table(spark, sf, "documents")
    batches = d.select("doc_id", hash_batch("doc_id", 8).alias("batch"))
    return batches.groupBy("batch").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


# The key of the inventory; the function name above would hide the operator of the same name.
QUERIES["model_enrich"] = QUERIES.pop("model_enrich_documents")
