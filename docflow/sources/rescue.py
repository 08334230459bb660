"""JSON and CSV records read against a declared schema, with other fields kept in ``_rescued_data``."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def rescued_map(line: str | Column, known: list[str]) -> Column:
    """Fields of a JSON object that the schema does not have, as ``map<string,string>``; NULL if there are none.

    A line that is no JSON is kept whole, under ``CORRUPT``.
    """
    col = F.col(line) if isinstance(line, str) else line
    extra = F.map_filter(F.from_json(col, "map<string,string>"), lambda k, _: ~k.isin(known))
    broken = F.try_parse_json(col).isNull() & (F.trim(col) != "")
    return F.when(broken, F.create_map(F.lit(CORRUPT), col)).when(F.size(extra) > 0, extra)


def with_rescue(df: DataFrame, line: str, schema: StructType) -> DataFrame:
    """Declared columns plus ``_rescued_data``. Works on batch and streaming frames."""
    keep = [c for c in df.columns if c != line]
    return df.select(*keep, F.from_json(line, schema).alias("_d"), rescued_map(line, schema.names).alias("_rescued_data")).select(
        *keep, "_d.*", "_rescued_data"
    )


def rescued_fields(df: DataFrame, line: str, known: list[str], keys: tuple[str, ...]) -> DataFrame:
    """One row per rescued field: keys, ``rescued_key, rescued_value``."""
    rows = df.select(*keys, F.explode_outer(rescued_map(line, known)).alias("rescued_key", "rescued_value"))
    return rows.filter(F.col("rescued_key").isNotNull())


def read_json_rescued(
    spark: SparkSession, path: str, schema: StructType, stream: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.format("text").schema("value string").load(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("_source_file"))
    return with_rescue(lines, "value", schema)


def read_csv_rescued(
    spark: SparkSession, path: str, schema: StructType, stream: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """CSV files against a declared schema, each by its own header: columns may stand in any order, be missing or be more.

    Values land by name (an exact one first, else one that differs in case only). ``_rescued_data`` keeps what has no place:
    columns that the schema doesn't have, values that their type refuses, and, under ``CORRUPT``, a whole line with more or
    fewer fields than its header. An empty field is NULL. A second column of one name is kept as ``name#2``.

    Files are read line by line from their start, so a file is not split, and is never held as a whole.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # As multi-line CSV with one field: a file goes to one task, its lines in order.
    reader = reader.option("multiLine", True).option("header", False).option("sep", "\x01").option("quote", "\x00").option("escape", "\x00")
    lines = reader.schema("line string").format("csv").load(path).select("line", F.col("_metadata.file_path").alias("_source_file"))
    named = lines.mapInArrow(lines_by_header, "_source_file string, fields map<string,string>, corrupt string")
    return typed_fields(named, schema)


def typed_fields(named: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema, ``_rescued_data`` and ``_source_file`` from ``fields`` by name and ``corrupt``, a record that doesn't fit."""
    columns, refused = [], []
    for f in schema.fields:
        text = F.col("fields")[f.name]
        value = text.try_cast(f.dataType)
        columns.append(value.alias(f.name))
        refused.append(F.when(text.isNotNull() & value.isNull(), F.lit(f.name)))
    bad = F.array_compact(F.array(*refused)) if refused else F.array().cast("array<string>")
    extra = F.map_filter("fields", lambda k, v: v.isNotNull() & (~k.isin(schema.names) | F.array_contains(bad, k)))
    whole = F.when(F.col("corrupt").isNotNull(), F.create_map(F.lit(CORRUPT), F.col("corrupt"))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    rescued = F.map_concat(extra, whole)
    spelled = named.withColumn("fields", named_as(F.col("fields"), schema.names))
    return spelled.select(*columns, F.when(F.size(rescued) > 0, rescued).alias("_rescued_data"), "_source_file")


def named_as(fields: Column, names: list[str]) -> Column:
    """Fields under the names of the schema where they differ in case only and the exact name is not there."""
    if not names:
        return fields
    by_case = F.create_map(*[F.lit(x) for n in reversed(list({n.lower(): n for n in reversed(names)}.values())) for x in (n.lower(), n)])

    def name(k: Column) -> Column:
        known = F.coalesce(by_case[F.lower(k)], k)
        return F.when(k.isin(names) | F.map_contains_key(fields, known), k).otherwise(known)

    # Two spellings of one name: the first takes it.
    keys = F.map_keys(fields)
    plain = F.transform(keys, lambda k, i: F.when(F.array_position(F.transform(keys, name), name(k)) == i + 1, name(k)).otherwise(k))
    return F.map_from_arrays(plain, F.map_values(fields))


OPEN_LINES = 1000  # a quoted field that goes on for more lines is no field: its lines count one by one


class _Lines:
    """Lines of files, each file in order from its header."""

    def __init__(self) -> None:
        self.file, self.header, self.open, self.odd = None, None, [], 0
        csv.field_size_limit(1 << 30)
        self.clear()

    def clear(self) -> None:
        self.files, self.rows, self.corrupt = [], [], []

    def add(self, path: str, line: str) -> None:
        if path != self.file:
            self.end()
            self.file, self.header = path, None
        self.odd = (self.odd if self.open else 0) ^ (line.count('"') & 1)
        self.open.append(line)
        if not self.odd:
            self.record("\n".join(self.open))
            self.open = []
        elif len(self.open) > OPEN_LINES:
            self.end()

    def end(self) -> None:
        """A quote that is never closed: every line stands for itself."""
        for line in self.open:
            self.record(line)
        self.open = []

    def record(self, text: str) -> None:
        if not text:
            return
        values = next(csv.reader(io.StringIO(text, newline="")), [])
        if self.header is None:
            self.header = unique_names(v.strip().lstrip("\ufeff") for v in values)
            return
        self.files.append(self.file)
        self.rows.append([(n, v or None) for n, v in zip(self.header, values)])
        self.corrupt.append(text if len(values) != len(self.header) else None)

    def batch(self) -> pa.RecordBatch:
        made = [pa.array(self.files, pa.string()), pa.array(self.rows, pa.map_(pa.string(), pa.string())), pa.array(self.corrupt, pa.string())]
        self.clear()
        return pa.RecordBatch.from_arrays(made, names=["_source_file", "fields", "corrupt"])


def lines_by_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines as fields by name, and the line where it doesn't fit its header."""
    lines = _Lines()
    for b in batches:
        for line, path in zip(b.column("line").to_pylist(), b.column("_source_file").to_pylist()):
            lines.add(path, line or "")
        yield lines.batch()
    lines.end()
    yield lines.batch()


def unique_names(names: Iterable[str]) -> list[str]:
    out: list[str] = []
    for n in names:
        k = 1
        while (n if k == 1 else f"{n}#{k}") in out:
            k += 1
        out.append(n if k == 1 else f"{n}#{k}")
    return out
