"""Bronze conditioning of files and of structured events. The same functions serve batch and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docflow.functions.pagecount import file_page_count
from docflow.functions.paths import file_name
from docflow.functions.text import column_checksum
from docflow.operators import quality

MAX_FILE_BYTES = 104_857_600

# Columns of the raw event record, all read as text.
EVENT_COLUMNS = [
    "event_ts", "transaction_id", "customer_id", "merchant_id", "region", "amount", "currency", "status", "channel",
]

DEDUPE_KEYS = ["transaction_id", "event_ts"]


def event_schema() -> StructType:
    return StructType([StructField(c, StringType(), True) for c in EVENT_COLUMNS])


def file_rules(max_bytes: int = MAX_FILE_BYTES) -> dict[str, str]:
    """What a file must meet to be taken in."""
    return {"has_content": "content IS NOT NULL", "valid_size": f"length > 0 AND length < {max_bytes}"}


def refused_files(files: DataFrame, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Files that ``bronze_files`` leaves out for their size, with ``failed_rules``. No file is opened for it."""
    return quality.quarantine(files.drop("content"), {"valid_size": file_rules(max_bytes)["valid_size"]})[1]


def bronze_files(
    files: DataFrame, page_counter: Column | None = None, max_bytes: int = MAX_FILE_BYTES, counts: Observation | None = None
) -> DataFrame:
    """Files with content and a size below ``max_bytes``, with file name and page count. ``counts`` sees those left out."""
    kept = quality.expect_or_drop(files, file_rules(max_bytes), counts)
    counter = file_page_count("content") if page_counter is None else page_counter
    return kept.select(
        file_name("path").alias("fileName"),
        "path",
        "content",
        "modificationTime",
        "length",
        counter.alias("page_count"),
    )


def condition_events(
    df: DataFrame, source_file: Column | None = None, null_token: str | None = None, checked: list[str] | None = None
) -> DataFrame:
    """Typed events with ingestion columns; rows without a time or a transaction id are left out.

    A value that cannot be cast becomes NULL. The checksum covers the incoming columns (or ``checked``) after
    conditioning.
    """
    typed = df.withColumns(
        {
            "event_ts": F.try_to_timestamp(F.col("event_ts")),
            "amount": F.col("amount").try_cast("double"),
            "region": F.upper(F.trim("region")),
        }
    )
    kept = typed.filter(F.col("event_ts").isNotNull() & F.col("transaction_id").isNotNull())
    now = F.current_timestamp()
    return kept.withColumns(
        {
            "_ingest_ts": now,
            "_ingest_date": F.to_date(now),
            "_source_file": F.lit(None).cast("string") if source_file is None else source_file,
            "_raw_checksum": column_checksum(checked or df.columns, null_token),
        }
    )


def dedupe(df: DataFrame, keys: list[str] | None = None, watermark: str | None = None, event_time: str = "event_ts") -> DataFrame:
    """One row per key. In a stream, ``watermark`` bounds the state; without it every key is remembered."""
    keys = keys or DEDUPE_KEYS
    if watermark and df.isStreaming:
        return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``: a repeatable choice.

    An aggregation, so copies of a hot key are combined before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    sort = [*order, *[c for c in rest if c not in order and c not in keys]]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*[c for c in sort if c not in keys])).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def bronze_events(
    df: DataFrame, source_file: Column | None = None, watermark: str | None = None, checked: list[str] | None = None
) -> DataFrame:
    return dedupe(condition_events(df, source_file, checked=checked), watermark=watermark)


def rows_per_source(df: DataFrame, source: str = "_source_file", n: int = 20) -> DataFrame:
    """The ``n`` sources with the most rows; ties by name."""
    return df.groupBy(source).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(source)).limit(n)
