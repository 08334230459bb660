"""Routes by file type and by content category."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.paths import extension

# Extension -> processing route.
TYPE_ROUTES = {
    "pdf": "full_parse",
    "pptx": "slide_images",
    "docx": "text_only",
}


def file_route(path: str | Column, routes: dict[str, str] | None = None) -> Column:
    out = F.lit("other")
    for ext, route in (routes or TYPE_ROUTES).items():
        out = F.when(extension(path) == ext, route).otherwise(out)
    return out


def route_by_file_type(df: DataFrame, path: str = "path", routes: dict[str, str] | None = None) -> DataFrame:
    return df.withColumn("ext", extension(path)).withColumn("route", file_route(path, routes))


def process_by_route(
    df: DataFrame, strategies: dict[str, Callable[[DataFrame], DataFrame]], route: str = "route"
) -> DataFrame:
    """Each route's rows by its own strategy, then one table by name. Rows of a route without a strategy are refused.

    Every strategy reads ``df``: give it a stored table, or a scan whose filter on the route is cheap.
    """
    known = F.col(route).isin(list(strategies))
    stop = F.raise_error(F.concat(F.lit("no strategy for route "), F.coalesce(route, F.lit("NULL")))).cast("boolean")
    checked = df.filter(F.when(known, True).otherwise(stop))
    parts = [work(checked.filter(F.col(route) == name)) for name, work in strategies.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def route_counts(routed: DataFrame, *keys: str) -> DataFrame:
    """Rows of every route from one aggregation."""
    return routed.groupBy(*(keys or ("route",))).agg(F.count("*").alias("n"))
