"""Search-index documents as bulk files, written by the executors.

An index is a folder of bulk lines (an action line with index and id, then the source document), one sub-folder per
published batch. The id is a stable hash, the reader keeps the newest batch of an id: publishing twice changes
nothing. ``send_bulk`` sends the same documents through a transport of the user instead of to files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docflow.session import hadoop_fs
from docflow.operators.changes import FULL_JSON
from docflow.sinks.tables import committed_parts, next_folder

# Field types of the document index.
INDEX_MAPPING = {
    "path": "keyword",
    "title": "text",
    "full_text": "text",
    "summary": "text",
    "category": "keyword",
    "author": "keyword",
    "key_topics": "keyword",
    "modified_date": "date",
    "file_type": "keyword",
}

_TYPES = {"keyword": "string", "text": "string", "date": "timestamp", "long": "bigint", "double": "double", "boolean": "boolean"}


def document_id(path: str | Column) -> Column:
    return F.md5(F.col(path) if isinstance(path, str) else path)


def typed_fields(df: DataFrame, mapping: dict[str, str]) -> list[Column]:
    """Columns of the mapping with their types. Arrays stay arrays, JSON text in a complex field stays text."""
    out = []
    for name, kind in mapping.items():
        if name not in df.columns:
            out.append(F.lit(None).cast(_TYPES[kind]).alias(name))
        elif df.schema[name].dataType.typeName() in ("array", "struct", "map", "variant"):
            out.append(F.col(name))
        else:
            out.append(F.col(name).try_cast(_TYPES[kind]).alias(name))
    return out


def index_documents(df: DataFrame, index: str, id_column: Column, mapping: dict[str, str] | None = None) -> DataFrame:
    """``_index, _id`` and the typed fields of every document."""
    return df.select(F.lit(index).alias("_index"), id_column.alias("_id"), *typed_fields(df, mapping or INDEX_MAPPING))


def json_or_text(value: str | Column) -> Column:
    """A JSON string as VARIANT; text that is no JSON stays a string value."""
    col = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.try_parse_json(col), F.variant_get(F.to_variant_object(F.array(col)), "$[0]", "variant"))


def bulk_lines(docs: DataFrame) -> DataFrame:
    """Two lines per document in one value: action and source."""
    fields = [c for c in docs.columns if c not in ("_index", "_id")]
    action = F.to_json(F.struct(F.struct("_index", "_id").alias("index")))
    source = F.to_json(F.struct(*fields), FULL_JSON)
    return docs.select(F.concat(action, F.lit("\n"), source).alias("value"))


def publish(docs: DataFrame, root: str, batch: int | None = None, mode: str = "append", writer: str | None = None) -> int:
    """Write a batch of an index folder and return its number.

    ``append`` upserts: the reader prefers the newest batch of an id. ``overwrite`` replaces the index by a base folder:
    readers see nothing that is older, so the change is made by the commit of that folder, and what it replaces is removed
    afterwards. Numbers are the index's own; ``writer`` and its count ``batch`` together tell a replay, which replaces itself.
    Documents without an id are refused.
    """
    spark = docs.sparkSession
    number, name = next_folder(spark, root, "base=" if mode == "overwrite" else "batch=", batch, writer)
    old = [p for p in committed_parts(spark, root) if not p.endswith(name)]
    checked = docs.withColumn("_id", F.coalesce("_id", F.raise_error(F.lit("document without id")).cast("string")))
    bulk_lines(checked).write.mode("overwrite").text(f"{root}/{name}")
    if mode == "overwrite":
        for part in old:
            fs, path = hadoop_fs(spark, part)
            fs.delete(path, True)
    return number


def read_index(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """``_id`` and the fields of ``schema``: the newest version of every document.

    A record starts at its action line and holds the source line, so the pair is never split. Which batch holds the
    newest version is found on ids alone: source lines are not shuffled unless the ids of changed documents are many.
    """
    parts = _visible(committed_parts(spark, root))
    shape = StructType.fromDDL(schema)
    if not parts:
        return spark.createDataFrame([], f"_id string, {schema}")
    raw = spark.read.option("lineSep", '\n{"index":{').text(parts)
    text = F.when(F.col("value").startswith('{"index":{'), F.col("value")).otherwise(F.concat(F.lit('{"index":{'), F.col("value")))
    lines = F.split(text, "\n", 2)
    rows = raw.filter(F.trim("value") != "").select(
        F.get_json_object(F.element_at(lines, 1), "$.index._id").alias("_id"),
        F.from_json(F.element_at(lines, 2), shape).alias("_source"),
        F.regexp_extract(F.col("_metadata.file_path"), r"(?:batch|base)=([0-9]+[^/]*)/[^/]*$", 1).alias("_batch"),
    )
    if len(parts) == 1:
        return rows.select("_id", "_source.*")
    # Ids that later batches hold too: their older versions go. The first folder, the bulk of an index, only gives rows.
    later = rows.filter(F.col("_batch") > min(p.rsplit("/", 1)[-1].split("=", 1)[1] for p in parts)).groupBy("_id").agg(F.max("_batch").alias("_newest"))
    kept = rows.join(later, "_id", "left").filter(F.col("_newest").isNull() | (F.col("_batch") == F.col("_newest")))
    return kept.select("_id", "_source.*")


def _number_of(part: str) -> int:
    return int(part.rsplit("/", 1)[-1].split("=")[1].split("-")[0])


def _visible(parts: list[str]) -> list[str]:
    """The newest base folder and the batches after it."""
    base = max((_number_of(p) for p in parts if p.rsplit("/", 1)[-1].startswith("base=")), default=-1)
    return [p for p in parts if _number_of(p) >= base]


# ---- pluggable transport ------------------------------------------------------------------------

# Sends (id, source JSON) pairs to an index and returns the number of errors.
Transport = Callable[[str, "list[tuple[str, str]]"], int]


def send_bulk(docs: DataFrame, connect: Callable[[], Transport], size: int = 1000) -> DataFrame:
    """Send documents from the executors and return ``index, ok, errors``.

    ``connect`` opens one transport per task. Ids make a repeated task harmless. The frame is lazy: act on it once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = connect()
        for pdf in batches:
            for index, group in pdf.groupby("_index"):
                pairs = list(zip(group["_id"], group["_source"]))
                for i in range(0, len(pairs), size):
                    part = pairs[i : i + size]
                    failed = send(index, part)
                    yield pd.DataFrame({"index": [index], "ok": [len(part) - failed], "errors": [failed]})

    fields = [c for c in docs.columns if c not in ("_index", "_id")]
    source = F.to_json(F.struct(*fields), FULL_JSON).alias("_source")
    sent = docs.select("_index", "_id", source).mapInPandas(run, "index string, ok bigint, errors bigint")
    return sent.groupBy("index").agg(F.sum("ok").alias("ok"), F.sum("errors").alias("errors"))


def batch_publisher(root: str, index: str, id_column: Column, mapping: dict[str, str] | None = None, writer: str | None = None):
    """Callback for ``foreachBatch``: publishes a micro-batch under its batch id, so a replay replaces itself.

    ``writer`` names the stream's start; ``foreach_batch`` gives the checkpoint's own name to callbacks that take one."""

    def write(df: DataFrame, batch_id: int, by: str | None = None) -> None:
        publish(index_documents(df, index, id_column, mapping), root, batch=batch_id, writer=writer or by)

    return write
