"""Idempotent load of files into a table folder, tracked by a log of loaded paths."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.changes import new_files_only
from docflow.session import hadoop_fs
from docflow.sinks.tables import append_aligned, committed_parts
from docflow.sources.files import literal_path

LOG_SCHEMA = "path string, load bigint, loaded_at timestamp"


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``path, modificationTime, length`` of a folder's files. The content column is pruned, so no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "modificationTime", "length")


def load_log(spark: SparkSession, log: str) -> DataFrame:
    fs, path = hadoop_fs(spark, log)
    if not fs.exists(path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(log)


def copy_into(
    spark: SparkSession,
    table: str,
    source: str,
    format: str = "csv",
    pattern: str | None = None,
    merge_schema: bool = False,
    log: str | None = None,
    **options: object,
) -> int:
    """Append the files that were not loaded before and return how many there were.

    Rows carry the file they come from. Columns are matched by name: every CSV file by its own header; later loads may add
    columns with ``merge_schema``. Every load writes one part folder under the log's next number: a load that breaks off
    before it is logged has its part replaced by the next one, whatever files were added meanwhile.
    """
    log = log or table.rstrip("/") + "_load_log"
    done = load_log(spark, log)
    number = 1 + (done.agg(F.max("load")).first()[0] if done.take(1) else -1)
    fresh = new_files_only(list_files(spark, source, pattern), done).select("path")
    # Paths only: Spark's own file index holds the listing on the driver as well.
    paths = sorted(r["path"] for r in fresh.toLocalIterator())
    if not paths:
        return 0
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", True).option("inferSchema", True).option("escape", '"')
    for name, value in options.items():
        reader = reader.option(name, value)
    groups = csv_groups(spark, paths) if format == "csv" and str(options.get("header", True)).lower() == "true" else [paths]
    parts = [reader.load([literal_path(p) for p in group]).withColumn("_source_file", F.col("_metadata.file_path")) for group in groups]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    append_aligned(spark, rows, table, f"load={number:020d}", merge_schema)
    stamp = [F.lit(number).cast("bigint").alias("load"), F.current_timestamp().alias("loaded_at")]
    spark.createDataFrame([(p,) for p in paths], "path string").select("path", *stamp).write.mode("append").parquet(log)
    return len(paths)


def csv_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The paths by their header line. Only the first block of each file is looked at, line by line where it is read."""

    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            new = batch[batch["path"].ne(batch["path"].shift(fill_value=last or ""))]
            last = batch["path"].iloc[-1] if len(batch) else last
            yield new.drop_duplicates("path")

    lines = spark.read.text([literal_path(p) for p in paths])
    top = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    heads = top.filter("start = 0").select("path", "value").mapInPandas(first_lines, "path string, value string")
    found = {r["path"]: r["value"] for r in heads.toLocalIterator()}
    groups: dict[str, list[str]] = {}
    for p in paths:
        groups.setdefault(found.get(p) or found.get(p.replace("file:///", "file:/")) or "", []).append(p)
    return [g for _, g in sorted(groups.items())]


def read_loaded(spark: SparkSession, table: str) -> DataFrame:
    """The loaded table, columns added by later loads included."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*committed_parts(spark, table))
