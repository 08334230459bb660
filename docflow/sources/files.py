"""File scans, batch and streaming, with one helper for both."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docflow.functions.paths import extension, file_name, media_type, parent_path

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
IMAGE_GLOB = "*.{png,jpg,jpeg,tiff,bmp,gif}"


def read_files(
    spark: SparkSession,
    path: str,
    format: str = "binaryFile",
    schema: str | StructType | None = None,
    stream: bool = False,
    glob: str | None = None,
    recursive: bool = True,
    max_files_per_trigger: int | None = None,
    **options: object,
) -> DataFrame:
    """Scan a folder. ``stream=True`` reads the files there first and then only new ones.

    CSV is read with a header, inferred types (batch) and ``"`` as escape. ``excel`` goes to the spreadsheet reader,
    as a stream with a schema.
    """
    if format == "excel":
        from docflow.sources.spreadsheet import read_excel, stream_excel

        if stream:
            if schema is None:
                raise ValueError("a stream of workbooks needs a schema")
            return stream_excel(spark, path, schema, glob=glob or "*.xlsx", max_files_per_trigger=max_files_per_trigger, **options)
        if schema is not None:
            options["schema"] = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        return read_excel(spark, path, glob=glob or "*.xlsx", **options)
    reader = (spark.readStream if stream else spark.read).format(format)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"')
        if schema is None and not stream:
            reader = reader.option("inferSchema", True)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for name, value in options.items():
        reader = reader.option(name, value)
    if format == "binaryFile":
        schema = BINARY_SCHEMA if stream else None
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def literal_path(path: str) -> str:
    """A listed path for ``load``, which would read brackets and the like in a file name as a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def with_extensions(files: DataFrame, *extensions: str, path: str = "path") -> DataFrame:
    """Keep files by extension whatever its case. A source glob is case-sensitive."""
    return files.filter(extension(path).isin([e.lower() for e in extensions]))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    return read_files(spark, path, glob=IMAGE_GLOB)


def file_metadata(path: str | Column = "path") -> Column:
    """Struct of ``file_name, extension, mime_type, parent_path`` derived from the path."""
    return F.struct(
        file_name(path).alias("file_name"),
        extension(path).alias("extension"),
        media_type(path).alias("mime_type"),
        parent_path(path).alias("parent_path"),
    )


def preview(content: str | Column = "content", n: int = 100) -> Column:
    """First bytes or characters of the content."""
    return F.substring(F.col(content) if isinstance(content, str) else content, 1, n)


def union_sources(**sources: DataFrame) -> DataFrame:
    """Several sources as one table by name, with ``source_kind``; columns a source lacks are NULL."""
    out: DataFrame | None = None
    for kind, df in sources.items():
        part = df.withColumn("source_kind", F.lit(kind))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no source")
    return out
