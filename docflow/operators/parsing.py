"""Documents to parsed VARIANT values, and the merge of page-range chunks."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions import elements as E
from docflow.functions.paths import extension, file_name
from docflow.functions.rows import array_rows
from docflow.operators.office import parse_office
from docflow.operators.pages import PAGE_LIMIT, chunk_page_ranges, explode_page_ranges, route_by_page_count

SCHEMA_VERSION = "2.0"
PAGE = "struct<pageId:int,imageUri:string>"


def parsed_variant(elements: Column, pages: Column, error: Column, name: Column) -> Column:
    """``{document: {elements, pages}, error_status, metadata}``. ``error_status`` is present also when null."""
    return F.to_variant_object(
        F.struct(
            F.struct(elements.alias("elements"), pages.alias("pages")).alias("document"),
            error.cast("string").alias("error_status"),
            F.struct(name.alias("fileName"), F.lit(SCHEMA_VERSION).alias("schemaVersion")).alias("metadata"),
        )
    )


def page_list(first: Column, last: Column) -> Column:
    pages = F.transform(
        F.sequence(first, last),
        lambda p: F.struct((p - 1).cast("int").alias("pageId"), F.lit(None).cast("string").alias("imageUri")),
    )
    return F.when(last >= first, pages).otherwise(F.array().cast(f"array<{PAGE}>"))


def error_status(parsed: str | Column = "parsed") -> Column:
    v = F.col(parsed) if isinstance(parsed, str) else parsed
    return F.try_variant_get(v, "$.error_status", "string")


def parse_status(df: DataFrame, keys: list[str], parsed: str = "parsed") -> DataFrame:
    """One pass over all rows: keys, ``status`` (ok or quarantined) and ``reason``."""
    marked = df.select(*keys, F.when(F.col(parsed).isNull(), "not parsed").otherwise(error_status(parsed)).alias("reason"))
    return marked.select(*keys, F.when(F.col("reason").isNull(), "ok").otherwise("quarantined").alias("status"), "reason")


def split_parse_errors(df: DataFrame, parsed: str = "parsed") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, quarantined rows with ``parse_error``). Give it a stored table: both sides read it."""
    marked = df.withColumn("parse_error", error_status(parsed))
    good = marked.filter(F.col("parse_error").isNull() & F.col(parsed).isNotNull()).drop("parse_error")
    bad = marked.filter(F.col("parse_error").isNotNull() | F.col(parsed).isNull()).drop(parsed)
    return good, bad


# ---- text documents by page range -------------------------------------------------------------


def text_error(text: Column, min_letters: float = 0.6) -> Column:
    """Why a text cannot be used, NULL if it can."""
    from docflow.functions.text import letter_share

    return (
        F.when(text.isNull() | (F.trim(text) == ""), "empty")
        .when(letter_share(text) < min_letters, "unreadable")
    )


def parse_text_short(df: DataFrame, text: str = "text", path: str = "path", page_chars: int = E.PAGE_CHARS) -> DataFrame:
    """Parse whole texts: adds ``parsed`` and ``chunk_count = 1``, drops the text.

    An unknown page count is taken from the text; any text has at least one page.
    """
    some = F.when(F.length(text) > 0, 1).otherwise(0)
    n = F.greatest(F.coalesce(F.col("page_count"), E.page_count(text, page_chars)), some)
    return (
        df.withColumn(
            "parsed",
            parsed_variant(
                E.page_elements(text, F.lit(1), n, page_chars),
                page_list(F.lit(1), n),
                F.when(F.col(text).isNull(), "empty"),
                file_name(path),
            ),
        )
        .withColumn("chunk_count", F.lit(1).cast("bigint"))
        .drop(text)
    )


def text_chunks(df: DataFrame, size: int, text: str = "text", page_chars: int = E.PAGE_CHARS) -> DataFrame:
    """One row per page range holding only its own slice of the text; the last one runs to the end of the text."""
    cut = F.transform(
        F.sequence(F.lit(1), F.col("page_count"), F.lit(size)),
        lambda s, i: F.struct(
            i.cast("int").alias("chunk_idx"),
            s.cast("int").alias("first_page"),
            F.least(s + (size - 1), F.col("page_count")).cast("int").alias("last_page"),
            F.substring(
                F.col(text),
                (s - 1) * page_chars + 1,
                F.when(s + size > F.col("page_count"), E.TO_THE_END).otherwise(size * page_chars),
            ).alias(text),
        ),
    )
    keep = [c for c in df.columns if c != text]
    return array_rows(df.filter(F.col("page_count") > 0), cut, "_c", keep=keep).select(*keep, "_c.*")


def parse_text_chunks(chunks: DataFrame, text: str = "text", path: str = "path", page_chars: int = E.PAGE_CHARS) -> DataFrame:
    return chunks.withColumn(
        "parsed",
        parsed_variant(
            E.page_elements(text, F.col("first_page"), F.col("last_page"), page_chars),
            page_list(F.col("first_page"), F.col("last_page")),
            F.when(F.col(text).isNull(), "empty"),
            file_name(path),
        ),
    ).drop(text, "first_page", "last_page")


def merge_chunks(chunks: DataFrame, keys: list[str], parsed: str = "parsed") -> DataFrame:
    """Merge parsed chunks into one row per document in chunk order.

    ``chunk_count`` counts merged chunks and ``failed_chunks`` those left out because of an error. A chunk without
    elements adds nothing. Metadata comes from the first chunk. VARIANT cannot be a key: group on paths or doc keys.
    """
    v = F.col(parsed)
    ok = error_status(v).isNull()

    def part(name: str) -> Column:
        found = F.try_variant_get(v, f"$.document.{name}", "array<variant>")
        return F.coalesce(found, F.array().cast("array<variant>"))

    rows = chunks.select(
        *keys,
        "chunk_idx",
        ok.alias("_ok"),
        part("elements").alias("_elements"),
        part("pages").alias("_pages"),
        F.try_variant_get(v, "$.metadata", "variant").alias("_metadata"),
    )
    kept = F.when(F.col("_ok"), F.struct("chunk_idx", "_elements", "_pages", "_metadata"))
    grouped = rows.groupBy(*keys).agg(
        F.count_if("_ok").alias("chunk_count"),
        F.count_if(~F.col("_ok")).alias("failed_chunks"),
        # A comparator, because VARIANT has no order of its own.
        F.array_sort(F.collect_list(kept), lambda a, b: a["chunk_idx"] - b["chunk_idx"]).alias("_c"),
    )
    first = F.get(F.col("_c"), 0)
    return grouped.select(
        *keys,
        "chunk_count",
        "failed_chunks",
        F.to_variant_object(
            F.struct(
                F.struct(
                    F.flatten(F.col("_c._elements")).alias("elements"),
                    F.flatten(F.col("_c._pages")).alias("pages"),
                ).alias("document"),
                F.when(F.size("_c") == 0, "all chunks failed").alias("error_status"),
                first["_metadata"].alias("metadata"),
            )
        ).alias("parsed"),
    )


def parse_text_documents(df: DataFrame, limit: int = PAGE_LIMIT, keys: list[str] | None = None) -> DataFrame:
    """Short texts in one piece, long texts by page range, then one table by name."""
    keys = keys or [c for c in df.columns if c != "text"]
    routed = route_by_page_count(df, limit)
    short = parse_text_short(routed.filter("route = 'short'")).select(*keys, "parsed", "chunk_count", F.lit(0).cast("bigint").alias("failed_chunks"))
    long = merge_chunks(parse_text_chunks(text_chunks(routed.filter("route = 'long'"), limit)), keys)
    return short.unionByName(long.select(*keys, "parsed", "chunk_count", "failed_chunks"))


# ---- binary files -----------------------------------------------------------------------------

Parser = Callable[[bytes, "str | None"], dict]

_OFFICE = ["docx", "pptx"]
_MARKUP = ["html", "htm"]
_PLAIN = ["txt", "md", "csv", "json"]


def parse_documents(
    df: DataFrame,
    content: str = "content",
    path: str = "path",
    page_range: str | None = None,
    parsers: dict[str, Parser] | None = None,
) -> DataFrame:
    """Add ``parsed`` to rows of binary files and drop the bytes.

    HTML and plain text are parsed by built-in expressions. DOCX and PPTX, and any extension in ``parsers``
    (a callable of bytes and page range that returns ``{"elements": [...], "pages": [...]}``), run in Arrow batches.
    A file that fails has ``error_status`` and no elements; it never fails the job. ``page_range`` names a column of
    ranges such as ``501-750``.
    """
    custom = {**{ext: parse_office for ext in _OFFICE}, **(parsers or {})}
    ext = extension(path)
    ranges = F.array(F.col(page_range) if page_range else F.lit(None).cast("string"))
    # One scan for all types: rows of other types reach the Python worker as NULL.
    called = _call_parser(custom)(F.when(ext.isin(list(custom)), F.col(content)), ext, ranges)
    return _assembled(df.withColumn("_one", F.get(called, F.lit(0))), list(custom), content, path)


def _assembled(rows: DataFrame, custom: list[str], content: str, path: str) -> DataFrame:
    """``parsed`` from the parser's answer in ``_one``, or from the bytes of markup and plain text; both are dropped."""
    ext = extension(path)
    is_custom, is_markup, is_plain = ext.isin(custom), ext.isin(_MARKUP), ext.isin(_PLAIN)
    text = F.try_validate_utf8(F.col(content))
    rows = rows.withColumn("_r", F.from_json("_one", _RESULT))
    no_elements, no_pages = F.array().cast(E.ELEMENTS), F.array().cast(f"array<{PAGE}>")
    elements = (
        F.when(is_custom, F.col("_r.elements"))
        .when(is_markup, E.html_elements(text))
        .when(is_plain, E.line_elements(text))
    )
    pages = F.when(is_custom, F.col("_r.pages")).when((is_markup | is_plain) & text.isNotNull(), page_list(F.lit(1), F.lit(1)))
    error = (
        F.when(is_custom, F.col("_r.error_status"))
        .when((is_markup | is_plain) & text.isNull(), "not utf-8 text")
        .when(~(is_markup | is_plain), F.concat(F.lit("no parser for ."), ext))
    )
    parsed = parsed_variant(F.coalesce(elements, no_elements), F.coalesce(pages, no_pages), error, file_name(path))
    return rows.withColumn("parsed", parsed).drop("_r", "_one", content)


_RESULT = f"struct<elements:{E.ELEMENTS},pages:array<{PAGE}>,error_status:string>"


def _call_parser(parsers: dict[str, Parser]):
    @F.pandas_udf("array<string>")
    def run(data: pd.Series, exts: pd.Series, ranges: pd.Series) -> pd.Series:
        def one(content, ext, page_range):
            try:
                return json.dumps({**parsers[ext](content, page_range), "error_status": None})
            except Exception as err:
                return json.dumps({"elements": [], "pages": [], "error_status": f"{type(err).__name__}: {err}"})

        def each(content, ext, asked):
            return None if content is None else [one(bytes(content), ext, r) for r in asked]

        return pd.Series([each(*row) for row in zip(data, exts, ranges)], dtype=object)

    return run


def parse_long_files(
    df: DataFrame, keys: list[str], size: int = PAGE_LIMIT, spread: bool = False, content: str = "content", path: str = "path", parsers: dict[str, Parser] | None = None
) -> DataFrame:
    """Parse long files by page range and merge.

    A file goes to its parser once, with the list of its ranges, where it was read: its bytes are neither copied nor
    shuffled. ``spread`` sends every range to its own task instead, for parsers that cost more than moving the file.
    """
    if spread:
        chunks = explode_page_ranges(df, size).repartition(path, "chunk_idx")
        return merge_chunks(parse_documents(chunks, content, path, page_range="page_range", parsers=parsers), keys)
    custom = {**{ext: parse_office for ext in _OFFICE}, **(parsers or {})}
    is_custom = extension(path).isin(list(custom))
    called = _call_parser(custom)(F.when(is_custom, F.col(content)), extension(path), chunk_page_ranges("page_count", size))
    # Markup and plain text have no ranges: one row with the whole text.
    rest = [c for c in df.columns if c != content]
    rows = df.select(*rest, F.when(~is_custom, F.col(content)).alias(content), called.alias("_all"))
    rows = rows.select(*rest, content, F.posexplode_outer("_all").alias("chunk_idx", "_one")).withColumn("chunk_idx", F.coalesce("chunk_idx", F.lit(0)))
    return merge_chunks(_assembled(rows, list(custom), content, path), keys)
