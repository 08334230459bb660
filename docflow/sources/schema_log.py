"""Versioned schemas of a source: new columns stop a stream, are added to it, or stay rescued."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docflow.sinks.tables import committed_parts
from docflow.sources.rescue import CORRUPT

MODES = ("stop", "evolve", "rescue")


class NewColumns(RuntimeError):
    """Files have columns that the schema doesn't have. They are in the log: the stream goes on with them when it starts again."""


def versions(spark: SparkSession, location: str) -> dict[int, StructType]:
    """All recorded schemas by version, from 0."""
    found = {}
    for part in committed_parts(spark, location):
        name = part.rsplit("/", 1)[-1]
        if name.startswith("version="):
            found[int(name.split("=")[1])] = StructType.fromJson(json.loads(spark.read.text(part).first()["value"]))
    return found


def current_schema(spark: SparkSession, location: str, declared: StructType) -> StructType:
    """The newest recorded schema; the declared one is recorded as the first. Columns that are declared later are added."""
    known = versions(spark, location)
    schema = known[max(known)] if known else StructType([])
    new = [f for f in declared.fields if f.name not in schema.names]
    return add_columns(spark, location, new) if new or not known else schema


def add_columns(spark: SparkSession, location: str, fields: list[StructField]) -> StructType:
    """Record a version with more columns. A version counts when its folder has committed; an equal one is not written again."""
    known = versions(spark, location)
    schema = known[max(known)] if known else StructType([])
    more = StructType([*schema.fields, *[f for f in fields if f.name not in schema.names]])
    if not known or more != schema:
        number = max(known, default=-1) + 1
        spark.createDataFrame([(more.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{location}/version={number:010d}")
    return more


def unknown_columns(batch: DataFrame) -> list[str]:
    """Names of rescued columns that the batch doesn't have: as many as columns, not as rows."""
    names = batch.select(F.explode(F.map_keys("_rescued_data")).alias("k")).distinct().collect()
    return sorted({r["k"] for r in names} - set(batch.columns) - {CORRUPT})


def with_columns(batch: DataFrame, schema: StructType) -> DataFrame:
    """The batch with all columns of the schema; those it rescued before come from ``_rescued_data``, by their type."""
    new = [f for f in schema.fields if f.name not in batch.columns]
    if not new:
        return batch
    taken = [f.name for f in new]
    fits = {f.name: F.col("_rescued_data")[f.name].try_cast(f.dataType) for f in new}
    # A value that the type refuses stays rescued.
    bad = F.array_compact(F.array(*[F.when(fits[n].isNull(), F.lit(n)) for n in taken]))
    left = F.map_filter("_rescued_data", lambda k, _: ~k.isin(taken) | F.array_contains(bad, k))
    order = [c for c in batch.columns if c in schema.names] + taken
    rest = [c for c in batch.columns if c not in schema.names and c != "_rescued_data"]
    return batch.select(*[F.col(f"`{c}`") if c in batch.columns else fits[c].alias(c) for c in order], F.when(F.size(left) > 0, left).alias("_rescued_data"), *rest)


def evolving(write: Callable[..., None], location: str, declared: StructType, mode: str = "stop") -> Callable[..., None]:
    """Callback for ``foreach_batch`` over a rescuing reader: ``write`` gets micro-batches with all recorded columns.

    If files bring new columns, they are recorded as strings in a new version of the schema at ``location``. ``stop`` then ends
    the stream before the batch is written; started again, it repeats the batch with them. ``evolve`` goes on at once.
    ``rescue`` records nothing and leaves them in ``_rescued_data``.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")

    def run(batch: DataFrame, batch_id: int, writer: str) -> None:
        spark = batch.sparkSession
        schema = current_schema(spark, location, declared)
        ready = with_columns(batch, schema)
        new = unknown_columns(ready) if mode != "rescue" else []
        if new:
            schema = add_columns(spark, location, [StructField(n, StringType()) for n in new])
            if mode == "stop":
                raise NewColumns(f"new columns {new}; recorded as version {max(versions(spark, location))}")
            ready = with_columns(batch, schema)
        write(ready, batch_id, writer)

    return run
