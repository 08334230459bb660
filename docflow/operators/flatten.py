"""Elements to rows, rows to chunks, chunks to document text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.functions.elements import ELEMENTS, html_text
from docflow.functions.rows import array_rows

CHUNK_CHARS = 1000
TEXT_TYPES = ["text", "title", "section_header", "table"]


def parsed_elements(parsed: str | Column = "parsed") -> Column:
    """Typed element array of a parsed VARIANT; NULL if it has none."""
    v = F.col(parsed) if isinstance(parsed, str) else parsed
    return F.try_variant_get(v, "$.document.elements", ELEMENTS)


def flatten_elements(
    df: DataFrame, elements: Column | str = "elements", keys: tuple[str, ...] = ("doc_id",), types: list[str] | None = None
) -> DataFrame:
    """One row per non-blank element: keys, ``pos``, ``type``, ``content``, ``confidence``, ``page_no``, ``description``."""
    source = F.col(elements) if isinstance(elements, str) else elements
    rows = array_rows(df, source, "_e", "pos", keys)
    out = rows.select(
        *keys,
        "pos",
        F.col("_e.type").alias("type"),
        F.col("_e.content").alias("content"),
        F.col("_e.confidence").alias("confidence"),
        (F.get(F.col("_e.bbox"), 0)["page_id"] + 1).alias("page_no"),
        F.col("_e.description").alias("description"),
    ).filter(F.trim("content") != "")
    return out.filter(F.col("type").isin(types)) if types else out


def full_text(elements: Column | str) -> Column:
    """Contents in order, joined by a blank line. Stays in the row."""
    e = F.col(elements) if isinstance(elements, str) else elements
    return F.concat_ws("\n\n", F.transform(e, lambda x: x["content"]))


def element_counts(df: DataFrame, parsed: str = "parsed", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    v = F.col(parsed)
    return df.select(
        *keys,
        F.size(F.try_variant_get(v, "$.document.elements", "array<variant>")).alias("elements"),
        F.size(F.try_variant_get(v, "$.document.pages", "array<variant>")).alias("pages"),
    )


def prep_search_chunks(elements: DataFrame, key: str = "doc_id", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Pack consecutive elements into chunks: ``key, chunk_no, chunk_to_retrieve, chunk_to_embed``.

    An element goes to the chunk in which it starts, counted in ``chunk_chars`` of preceding content. The text to
    embed is headed by the document title and by the section header that was open when the chunk began.
    Rows are hashed by document once; the windows and the aggregation reuse that partitioning.
    """
    order = W.partitionBy(key).orderBy("pos")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    title = F.when(F.col("type") == "title", F.col("content"))
    header = F.when(F.col("type") == "section_header", F.col("content"))
    placed = elements.select(
        key,
        "pos",
        "content",
        F.floor(F.coalesce(F.sum(F.length("content")).over(before), F.lit(0)) / chunk_chars).alias("chunk_no"),
        F.first(title, ignorenulls=True).over(order).alias("_title"),
        F.last(header, ignorenulls=True).over(order).alias("_section"),
    )
    packed = placed.groupBy(key, "chunk_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", "content"))).alias("_parts"),
        F.min_by("_title", "pos").alias("_title"),
        F.min_by("_section", "pos").alias("_section"),
    )
    chunk = F.array_join(F.col("_parts.content"), "\n")
    return packed.select(
        key,
        "chunk_no",
        chunk.alias("chunk_to_retrieve"),
        F.concat_ws("\n", "_title", "_section", chunk).alias("chunk_to_embed"),
    )


def document_text(chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Document text and text with context: chunks of a document in order, joined by a blank."""
    parts = F.array_sort(F.collect_list(F.struct("chunk_no", "chunk_to_retrieve", "chunk_to_embed")))
    return (
        chunks.groupBy(key)
        .agg(parts.alias("_p"))
        .select(
            key,
            F.concat_ws(" ", F.col("_p.chunk_to_retrieve")).alias("text"),
            F.concat_ws(" ", F.col("_p.chunk_to_embed")).alias("text_with_context"),
        )
    )


def confidence_stats(elements: DataFrame, threshold: float = 0.8) -> DataFrame:
    c = F.col("confidence")
    return elements.groupBy("type").agg(
        F.count("*").alias("n"),
        F.round(F.avg(c), 6).alias("mean_confidence"),
        F.min(c).alias("min_confidence"),
        F.round(F.sum(F.when(c < threshold, 1).otherwise(0)) / F.count("*"), 6).alias("low_share"),
    )


def nested_pages(elements: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document with its pages nested as ``array<struct<page, text>>``."""
    # Hashed by document alone, so that both groupings work in the same partitions.
    pages = elements.repartition(key).groupBy(key, "page_no").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("pos", "content")))["content"], "\n").alias("text")
    )
    return pages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("page_no").alias("page"), "text"))).alias("pages"))


def html_table_cells(df: DataFrame, html: str, keys: tuple[str, ...]) -> DataFrame:
    """Cells of the HTML table in a column: ``keys, row_no, col_no, cell`` (both from 0)."""
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.regexp_extract_all(F.col("_row"), F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1))
    found = array_rows(array_rows(df, rows, "_row", "row_no", keys), cells, "_cell", "col_no", [*keys, "row_no"])
    return found.select(*keys, "row_no", "col_no", html_text(F.col("_cell")).alias("cell"))
