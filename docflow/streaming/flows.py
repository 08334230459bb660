"""Streaming stages: table to table, several sources to one table, changed files, derived tables."""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docflow.operators.bronze import bronze_events, event_schema
from docflow.operators.changes import changed_documents, latest_version
from docflow.session import hadoop_fs, scratch_path
from docflow.sinks.tables import fit_to_table, last_batch, materialise, read_current, write_changes
from docflow.sources.files import literal_path, read_files
from docflow.sources.load_log import list_files
from docflow.sources.rescue import read_csv_rescued, read_json_rescued

Stage = Callable[[DataFrame], DataFrame]


def _trigger(available_now: bool, interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": available_now}


def write_stream(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    interval: str | None = None,
    name: str | None = None,
    merge_schema: bool = False,
) -> StreamingQuery:
    """Append a stream to a parquet folder or table. Runs over what is available, or at an interval.

    A stream with columns that the table does not have is refused; with ``merge_schema`` they are added first. In a folder,
    files with new columns stand beside the others: read it with ``mergeSchema``.
    """
    if table and df.sparkSession.catalog.tableExists(table):
        df = fit_to_table(df, table, merge_schema)
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(**_trigger(True, interval))
    if name:
        writer = writer.queryName(name)
    return writer.toTable(table) if table else writer.start(path)


def checkpoint_writer(spark: SparkSession, checkpoint: str) -> str:
    """Identity of a stream's start: Spark's id of the query, kept in its checkpoint. A restart from the checkpoint has the same
    one; a deleted or new checkpoint gives another."""
    fs, path = hadoop_fs(spark, f"{checkpoint}/metadata")
    if not fs.exists(path):
        raise ValueError(f"no stream has started from {checkpoint}")
    return json.loads(spark.read.text(literal_path(path.toString()), wholetext=True).first()["value"])["id"].replace("-", "")


def foreach_batch(
    df: DataFrame, write: Callable[..., None], checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Run ``write(batch, batch_id)`` for each micro-batch; a callback that takes a third argument also gets the identity of the
    stream's start, by which keyed tables and indexes tell a replay from a stream that starts again."""
    known = {}

    def identified(batch: DataFrame, batch_id: int) -> None:
        if "writer" not in known:
            known["writer"] = checkpoint_writer(batch.sparkSession, checkpoint)
        write(batch, batch_id, known["writer"])

    takes = len([p for p in inspect.signature(write).parameters.values() if p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD)])
    writer = df.writeStream.foreachBatch(identified if takes > 2 else write).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(True, interval)).start()


def stream_bronze_events(
    spark: SparkSession,
    source: str,
    format: str = "json",
    max_files_per_trigger: int = 1000,
    watermark: str | None = None,
    rescue: bool = True,
) -> DataFrame:
    """Structured events from files, conditioned and deduplicated by the batch functions."""
    rescuers = {"json": read_json_rescued, "csv": read_csv_rescued}
    if format in rescuers and rescue:
        raw = rescuers[format](spark, source, event_schema(), stream=True, max_files_per_trigger=max_files_per_trigger)
        return bronze_events(raw, F.col("_source_file"), watermark, checked=event_schema().names)
    raw = read_files(
        spark, source, format=format, schema=event_schema(), stream=True, recursive=False, max_files_per_trigger=max_files_per_trigger
    )
    return bronze_events(raw, F.col("_metadata.file_path"), watermark)


def stream_table(spark: SparkSession, path: str, stage: Stage, schema: str | None = None) -> DataFrame:
    """A stage over a table folder that grows."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    return stage(reader.parquet(path))


def append_flows(flows: dict[str, DataFrame], target: str, checkpoints: str) -> list[StreamingQuery]:
    """One query per source, all appending to one folder with ``source_kind``."""
    return [
        write_stream(df.withColumn("source_kind", F.lit(kind)), f"{checkpoints}/{kind}", path=f"{target}/flow={kind}", name=kind)
        for kind, df in flows.items()
    ]


def upsert_batches(
    table: str,
    keys: list[str],
    version: str,
    stage: Stage | None = None,
    rows: DataFrame | None = None,
    by: list[str] | None = None,
    writer: str | None = None,
) -> Callable[..., None]:
    """Callback that keeps a keyed table current: the newest row per key of the micro-batch, under its writer and batch id.

    Only changed rows are written; ``read_current`` merges them. A batch that the same writer repeats replaces itself; a
    stream that starts again with a new checkpoint is another writer and goes on with the table's next number, also
    after a single batch. ``writer`` is given by ``foreach_batch``, or fixed here; without one nothing is replaced. With ``rows``, the whole source table, and
    ``by``, ``stage`` is computed anew from all rows of the keys that the micro-batch touches.
    """

    def write(df: DataFrame, batch_id: int, started: str | None = None) -> None:
        if rows is not None and by:
            df = rows.join(df.select(*by).distinct(), by, "left_semi")
        changed = stage(df) if stage else df
        rest = [c for c in changed.columns if c not in (*keys, version)]
        write_changes(latest_version(changed, keys, [version, *rest]), table, tag=batch_id, writer=writer or started)

    return write


TRACKING_SCHEMA = "path string, last_processed timestamp"


def process_changed_files(
    spark: SparkSession,
    source: str,
    tracking: str,
    work: Callable[[DataFrame, int], None],
    pattern: str | None = None,
    group_files: int = 10_000,
) -> int:
    """Process files that are new or were modified since the last run; returns their number.

    The changed paths are listed once into the shared folder and worked through in groups of about ``group_files`` by a
    hash of the path, so that only one group's paths are on the driver at a time. Each group is a run of its own:
    ``work`` gets its files with content and a run number to write under, and tracking is written last. A run that breaks
    off is repeated with the same number; groups before it are done.
    """
    before = read_current(spark, tracking, ["path"], "last_processed", TRACKING_SCHEMA)
    listed = changed_documents(list_files(spark, source, pattern), before)
    changed = materialise(listed.select("path", F.col("modificationTime").alias("last_processed")), scratch_path(spark, "changed-files"))
    total = changed.count()
    groups = max(1, -(-total // group_files))
    for g in range(groups if total else 0):
        mine = changed.filter(F.pmod(F.xxhash64("path"), F.lit(groups)) == g)
        paths = [r["path"] for r in mine.select("path").toLocalIterator()]
        if paths:
            run = 1 + last_batch(spark, tracking)
            work(spark.read.format("binaryFile").load([literal_path(p) for p in paths]), run)
            write_changes(mine, tracking, run)
    return total


def active_queries(spark: SparkSession) -> list[dict]:
    """Name, id and last progress of the running queries."""
    return [{"name": q.name, "id": q.id, "status": q.status, "progress": q.lastProgress} for q in spark.streams.active]
