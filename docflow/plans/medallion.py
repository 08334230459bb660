"""The five stages from files to search index, for whole folders, changed files and streams.

Every stage is a function of DataFrames. A run stores each stage once below ``root/runs/run=<n>``, so later stages
read files instead of recomputing models or parsers, and a run that breaks off is repeated under the same number.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docflow.functions.paths import doc_key, extension
from docflow.operators import bronze, enrich, flatten, pages, parsing, quality
from docflow.sinks import bulk
from docflow.sinks.tables import materialise, read_current, save_table
from docflow.sources.files import read_files
from docflow.streaming.flows import foreach_batch, process_changed_files, upsert_batches, write_stream

GLOB = "*.{pdf,pptx,docx}"

GOLD_SCHEMA = (
    "doc_key string, path string, fileName string, modificationTime timestamp, category string, error_message string, "
    "title string, company string, product string, author string, date string, key_topics array<string>, "
    "summary string, summary_pig_latin string, full_text string"
)


def silver(files: DataFrame, limit: int = pages.PAGE_LIMIT, parsers: dict | None = None) -> DataFrame:
    """Parsed documents: short ones in one piece, long ones by page range and merged."""
    keys = ["fileName", "path", "modificationTime", "length", "page_count"]
    routed = pages.route_by_page_count(files, limit)
    short = parsing.parse_documents(routed.filter("route = 'short'"), parsers=parsers).select(
        *keys, "parsed", F.lit(1).cast("bigint").alias("chunk_count"), F.lit(0).cast("bigint").alias("failed_chunks")
    )
    long = parsing.parse_long_files(routed.filter("route = 'long'"), keys, limit, parsers=parsers)
    return short.unionByName(long.select(*short.columns))


def gold_text(parsed: DataFrame) -> DataFrame:
    """``doc_key, text, text_with_context``. A document without text has no row."""
    keyed = parsed.select(doc_key("path").alias("doc_key"), flatten.parsed_elements().alias("elements"))
    rows = flatten.flatten_elements(keyed, keys=("doc_key",))
    return flatten.document_text(flatten.prep_search_chunks(rows, "doc_key"), "doc_key")


def gold_enriched(parsed: DataFrame, text: DataFrame, lexicon: dict | None = None, rules: dict | None = None) -> DataFrame:
    """One row per parsed document; one without text keeps its row, with NULL fields and an error message."""
    base = parsed.select(doc_key("path").alias("doc_key"), "path", "fileName", "modificationTime")
    joined = base.join(text.select("doc_key", "text"), "doc_key", "left")
    done = enrich.enriched_documents(joined, key="doc_key", lexicon=lexicon, rules=rules)
    return done.join(text.select("doc_key", F.col("text").alias("full_text")), "doc_key", "left")


def index_rows(enriched: DataFrame, index: str) -> DataFrame:
    ready = enriched.withColumn("modified_date", F.col("modificationTime")).withColumn("file_type", extension("path"))
    return bulk.index_documents(ready, index, F.col("doc_key"))


def run_stages(
    files: DataFrame,
    run: int,
    root: str,
    index: str = "documents",
    limit: int = pages.PAGE_LIMIT,
    parsers: dict | None = None,
    lexicon: dict | None = None,
    rules: dict | None = None,
    max_bytes: int = bronze.MAX_FILE_BYTES,
    writer: str = "run",
) -> None:
    """All stages for the given files; results are merged into the gold table and published.

    ``writer`` and ``run`` together name the run: a repeated one replaces its folders, batches and records, and runs of
    several writers on one root stand beside each other.
    Files that are refused, and those that can't be parsed, are kept as quarantine.
    """
    here = f"{root}/runs/run={run:020d}" + ("" if writer == "run" else f"-by={writer}")
    spark = files.sparkSession
    times: list[tuple] = []

    def stage(name: str, df: DataFrame, folder: str) -> DataFrame:
        started = datetime.now(timezone.utc)
        out = materialise(df, f"{here}/{folder}")
        times.append((name, started, datetime.now(timezone.utc)))
        return out

    refused, taken_in = bronze.file_rules(max_bytes), Observation(f"bronze-{run}")
    bronze.refused_files(files, max_bytes).write.mode("overwrite").parquet(f"{here}/01_quarantine")
    raw = stage("bronze", bronze.bronze_files(files, max_bytes=max_bytes, counts=taken_in), "01_bronze")
    parsed = stage("parsed", silver(raw, limit, parsers), "02_parsed")
    good, bad = parsing.split_parse_errors(parsed)
    bad.write.mode("overwrite").parquet(f"{here}/02_quarantine")
    text = stage("text", gold_text(good), "03_text")
    enriched = stage("enriched", gold_enriched(good, text, lexicon, rules), "03_enriched")
    seen = taken_in.get
    before = [(rule, seen["total"], seen["total"] - seen[rule], seen[rule]) for rule in refused]
    offered = spark.createDataFrame(before, "rule string, total bigint, passed bigint, failed bigint")
    counts = [
        # Counted on the way in, before the files that fail are left out.
        offered.withColumn("pass_rate", F.round(F.try_divide("passed", "total"), 6)),
        quality.expectation_metrics(raw.drop("content"), {"counted_pages": "page_count IS NOT NULL"}),
        quality.expectation_metrics(parsed, {**quality.PARSED_RULES, "no_error": "try_variant_get(parsed, '$.error_status', 'string') IS NULL"}),
        quality.expectation_metrics(enriched, quality.ENRICHED_RULES),
    ]
    stamp = {"run": F.lit(run), "writer": F.lit(writer), "recorded_at": F.current_timestamp()}
    named = [m.withColumns({"stage": F.lit(s), **stamp}) for s, m in zip(("files", "bronze", "parsed", "enriched"), counts)]
    reduce(DataFrame.unionByName, named).write.mode("overwrite").parquet(f"{here}/metrics")
    # Rows, bytes and errors of each stage from what it stored.
    sizes = {
        "bronze": raw.agg(F.count("*").alias("rows"), F.sum("length").alias("bytes"), F.lit(seen["dropped"]).alias("errors")),
        "parsed": parsed.agg(F.count("*").alias("rows"), F.sum("length").alias("bytes"), F.count_if(parsing.error_status().isNotNull()).alias("errors")),
        "text": text.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"), F.lit(0).alias("errors")),
        "enriched": enriched.agg(F.count("*").alias("rows"), F.sum(F.octet_length("full_text")).alias("bytes"), F.count_if(F.col("error_message").isNotNull()).alias("errors")),
    }
    clock = spark.createDataFrame(times, "stage string, started_at timestamp, ended_at timestamp")
    measured = reduce(DataFrame.unionByName, [m.select(F.lit(s).alias("stage"), *[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in ("rows", "bytes", "errors")]) for s, m in sizes.items()])
    clock.join(measured, "stage").withColumns({"run": F.lit(run), "writer": F.lit(writer)}).write.mode("overwrite").parquet(f"{here}/stages")
    columns = [c.split()[0] for c in GOLD_SCHEMA.split(", ")]
    upsert_batches(f"{root}/gold", ["doc_key"], "modificationTime", writer=writer)(enriched.select(*columns), run)
    bulk.publish(index_rows(enriched, index), f"{root}/index", batch=run, writer=writer)


def run_changed(spark: SparkSession, source: str, root: str, pattern: str | None = GLOB, **options) -> int:
    """Process new and modified files of a folder; the first run takes all of them."""

    def work(files: DataFrame, run: int) -> None:
        run_stages(files, run, root, **options)

    return process_changed_files(spark, source, f"{root}/tracking", work, pattern)


def run_stream(
    spark: SparkSession, source: str, root: str, pattern: str | None = GLOB, max_files_per_trigger: int = 1000, **options
) -> StreamingQuery:
    """Process files as they arrive, one run per micro-batch of at most ``max_files_per_trigger`` files."""
    files = read_files(spark, source, stream=True, glob=pattern, max_files_per_trigger=max_files_per_trigger)
    return foreach_batch(files, lambda df, batch, writer: run_stages(df, batch, root, writer=writer, **options), f"{root}/checkpoint")


def run_chain(
    df: DataFrame,
    root: str,
    lexicon: dict[str, list[str]],
    patterns: dict[str, str],
    default: str,
    limits: dict[str, int] | None = None,
    key: str = "doc_id",
    max_words: int = 300,
) -> dict[str, DataFrame]:
    """Classify, extract by category, summarise by category: three stored tables below ``root``.

    ``patterns`` maps a category to what is extracted from it, ``limits`` to the length of its summaries.
    """
    classified = materialise(df.select(key, "text", enrich.classify("text", lexicon)["label"].alias("category")), f"{root}/classified")
    hits = enrich.category_hits("text", F.col("category"), patterns, default)
    entities = materialise(classified.select(key, "category", hits.alias("entities")), f"{root}/entities")
    groups = {**{c: max_words for c in [*lexicon, "other"]}, **(limits or {})}
    summaries = None
    for words in sorted(set(groups.values())):
        part = classified.filter(F.col("category").isin([c for c, n in groups.items() if n == words]))
        done = enrich.summarize(part, key=key, max_words=words)
        summaries = done if summaries is None else summaries.unionByName(done)
    summaries = classified.select(key, "category").join(summaries, key)
    return {"classified": classified, "entities": entities, "summaries": materialise(summaries, f"{root}/summaries")}


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of every enriched document."""
    return read_current(spark, f"{root}/gold", ["doc_key"], "modificationTime", GOLD_SCHEMA)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/runs/*/metrics")


def read_stages(spark: SparkSession, root: str) -> DataFrame:
    """``run, writer, stage, started_at, ended_at, rows, bytes, errors`` of all recorded runs."""
    return spark.read.parquet(f"{root}/runs/*/stages")


def slowest_stages(spark: SparkSession, root: str, n: int = 20) -> DataFrame:
    """The recorded stages that took longest, with seconds, rows a second and share of errors."""
    seconds = F.col("ended_at").cast("double") - F.col("started_at").cast("double")
    rates = {"seconds": F.round(seconds, 3), "rows_per_second": F.round(F.try_divide("rows", seconds), 3), "error_share": F.round(F.try_divide("errors", "rows"), 6)}
    return read_stages(spark, root).withColumns(rates).orderBy(F.desc("seconds"), "run", "stage").limit(n)


def rebuild_index(spark: SparkSession, root: str, index: str = "documents") -> int:
    """Replace the index by one built from the gold table."""
    return bulk.publish(index_rows(read_gold(spark, root), index), f"{root}/index", mode="overwrite")


def declare(df: DataFrame, name: str, kind: str = "view", checkpoint: str | None = None) -> StreamingQuery | None:
    """Name a dataset: a temporary ``view``, a ``materialized`` table, or a ``streaming`` table with a checkpoint."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "materialized":
        save_table(df, name)
    elif kind == "streaming":
        return write_stream(df, checkpoint or "", table=name)
    else:
        raise ValueError(f"unknown kind of dataset: {kind}")
    return None
