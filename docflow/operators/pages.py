"""Page ranges and routing by page count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.rows import array_rows

PAGE_LIMIT = 500


def chunk_page_ranges(n_pages: str | Column, size: int = PAGE_LIMIT) -> Column:
    """Ranges such as ``1-500, 501-750`` that cover ``1..n`` once; empty for NULL or a count below 1."""
    n = F.col(n_pages) if isinstance(n_pages, str) else n_pages
    ranges = F.transform(
        F.sequence(F.lit(1), n, F.lit(size)),
        lambda s: F.concat(s.cast("string"), F.lit("-"), F.least(s + (size - 1), n).cast("string")),
    )
    return F.when(n > 0, ranges).otherwise(F.array().cast("array<string>"))


def route_by_page_count(df: DataFrame, limit: int = PAGE_LIMIT, page_count: str = "page_count") -> DataFrame:
    """Add ``route``: long above the limit, short otherwise. An unknown page count goes short."""
    return df.withColumn("route", F.when(F.col(page_count) > limit, "long").otherwise("short"))


def explode_page_ranges(df: DataFrame, size: int = PAGE_LIMIT, page_count: str = "page_count") -> DataFrame:
    """One row per page range with ``chunk_idx``, ``page_range``, ``first_page`` and ``last_page``.

    The ranges come from the row's own page count, so a file of any length is covered to its last page.
    """
    bounds = F.split("page_range", "-")
    return (
        array_rows(df, chunk_page_ranges(page_count, size), "page_range", "chunk_idx", df.columns)
        .withColumn("first_page", F.element_at(bounds, 1).cast("int"))
        .withColumn("last_page", F.element_at(bounds, 2).cast("int"))
    )


def page_stats(df: DataFrame, key: str, page_count: str = "page_count") -> DataFrame:
    return df.groupBy(key).agg(
        F.count("*").alias("documents"),
        F.max(page_count).alias("max_pages"),
        F.sum(page_count).alias("total_pages"),
    )
