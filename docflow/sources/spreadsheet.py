"""XLSX scan: many workbooks in parallel, one Arrow batch of files at a time."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docflow.session import scratch_path
from docflow.sinks.tables import materialise
from docflow.sources.rescue import typed_fields, unique_names

M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_ADDRESS = re.compile(r"^(?:'?(?P<sheet>[^'!]+)'?!)?(?:(?P<c1>[A-Z]+)(?P<r1>\d+):(?P<c2>[A-Z]+)(?P<r2>\d+))?$")


def column_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + ord(ch) - 64
    return n


def parse_address(address: str | None) -> tuple[str | None, tuple[int, int, int, int] | None]:
    """``Sheet1!A1:Y200`` to (sheet, (first column, first row, last column, last row))."""
    m = _ADDRESS.match(address or "")
    if not m:
        raise ValueError(f"bad data address: {address}")
    box = (column_index(m["c1"]), int(m["r1"]), column_index(m["c2"]), int(m["r2"])) if m["c1"] else None
    return m["sheet"], box


def _sheet_name(z: zipfile.ZipFile, sheet: str | None) -> str:
    book = ET.fromstring(z.read("xl/workbook.xml"))
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    for s in book.iter(f"{M}sheet"):
        if sheet is None or s.get("name") == sheet:
            target = targets[s.get(f"{R}id")]
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError(f"no sheet {sheet}")


def workbook_rows(content: bytes, sheet: str | None, box: tuple[int, int, int, int] | None) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number, {column number: text}) of one sheet, one row at a time."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{M}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{M}si")]
        with z.open(_sheet_name(z, sheet)) as f:
            for _, row in ET.iterparse(f):
                if row.tag != f"{M}row":
                    continue
                cells: dict[int, str] = {}
                for c in row.iter(f"{M}c"):
                    col = column_index(re.match(r"[A-Z]+", c.get("r"))[0])
                    value = c.find(f"{M}v")
                    if c.get("t") == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(f"{M}t"))
                    elif value is None or value.text is None:
                        continue
                    else:
                        text = shared[int(value.text)] if c.get("t") == "s" else value.text
                    if box is None or box[0] <= col <= box[2]:
                        cells[col] = text
                number = int(row.get("r"))
                if cells and (box is None or box[1] <= number <= box[3]):
                    yield number, cells
                row.clear()


def workbook_cells(spark: SparkSession, path: str, data_address: str | None = None, glob: str = "*.xlsx") -> DataFrame:
    """``path, row_no, cells, error`` of the workbooks below a path. A workbook that cannot be read to its end gives no
    cells, only one row with ``error``."""
    sheet, box = parse_address(data_address)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                try:
                    out = [(name, number, cells, None) for number, cells in workbook_rows(bytes(content), sheet, box)]
                except (zipfile.BadZipFile, KeyError, ValueError, IndexError, ET.ParseError) as err:
                    out = [(name, None, None, f"{type(err).__name__}: {err}")]
                for i in range(0, len(out), 10_000):
                    yield _frame(out[i : i + 10_000])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInPandas(scan, "path string, row_no int, cells map<int,string>, error string")


def unreadable_workbooks(spark: SparkSession, path: str, data_address: str | None = None, glob: str = "*.xlsx") -> DataFrame:
    """Quarantine of ``read_excel``: ``path, error``."""
    return workbook_cells(spark, path, data_address, glob).filter("error IS NOT NULL").select("path", "error")


def read_excel(
    spark: SparkSession,
    path: str,
    data_address: str | None = None,
    header_rows: int = 1,
    infer_schema: bool = True,
    schema: str | None = None,
    glob: str = "*.xlsx",
) -> DataFrame:
    """Rows of the workbooks below a path.

    Column names come from each file's own header row, so files may have their columns in any order; without a header,
    and with a schema, columns are taken by position. Types are inferred by one pass over the cells (bigint, double,
    else string), unless a schema is given. Workbooks are parsed once into the shared folder. A file that cannot be read
    gives no rows here and one in ``unreadable_workbooks``.
    """
    _, box = parse_address(data_address)
    cells = materialise(workbook_cells(spark, path, data_address, glob), scratch_path(spark, "workbooks")).filter("error IS NULL")
    first_row = box[1] if box else 1
    body = cells.filter(F.col("row_no") >= first_row + header_rows)
    if schema is None and header_rows:
        heads = cells.groupBy("path").agg(F.min_by("cells", "row_no").alias("head"))
        pairs = heads.select("path", F.explode("head").alias("col", "name"))
        # A second cell of one name is named apart, as in streams.
        again = F.row_number().over(Window.partitionBy("path", "name").orderBy("col"))
        pairs = pairs.select("path", "col", again.alias("k"), "name").select("path", "col", F.when(F.col("k") == 1, F.col("name")).otherwise(F.concat("name", F.lit("#"), F.col("k"))).alias("name"))
        order = pairs.groupBy("name").agg(F.min(F.struct("path", "col")).alias("at")).orderBy("at").select("name")
        names = [r["name"] for r in order.collect()]
        # Where each file has each name; one short row per file.
        where = pairs.groupBy("path").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("name", F.col("col"))))).alias("where"))
        body = body.join(where, "path")
        columns = {n: F.col("cells")[F.col("where")[F.lit(n)]] for n in names}
    elif schema is None:
        found = body.select(F.explode(F.map_keys("cells")).alias("c")).distinct().orderBy("c").collect()
        columns = {f"_c{r['c']}": F.col("cells")[r["c"]] for r in found}
    else:
        start = box[0] if box else 1
        columns = {f.name: F.col("cells")[start + i] for i, f in enumerate(StructType.fromDDL(schema).fields)}
    if not columns:
        return spark.createDataFrame([], "path string")
    if schema is not None:
        types = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(schema).fields}
    elif infer_schema:
        types = _infer(body, columns)
    else:
        types = {n: "string" for n in columns}
    return body.select(*[c.try_cast(types[n]).alias(n) for n, c in columns.items()])


def stream_excel(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    data_address: str | None = None,
    header_rows: int = 1,
    glob: str = "*.xlsx",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows of workbooks as they arrive, against a declared schema.

    Columns are matched by each workbook's own header (without one: ``_c1, _c2, ..``); a second column of a name is ``name#2``.
    ``_rescued_data`` keeps columns that the schema doesn't have and values that their type refuses. A workbook that cannot
    be read gives one row, with its error under ``_corrupt_record``. Which files are new is Spark's own record in the
    stream's checkpoint, so a restart reads none twice."""
    shape = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    sheet, box = parse_address(data_address)
    first = box[1] if box else 1

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content")):
                files, rows, corrupt = [], [], []
                try:
                    where: dict[int, str] = {}
                    for number, cells in workbook_rows(content.as_py(), sheet, box):
                        if header_rows and not where and number >= first:
                            where = dict(zip(sorted(cells), unique_names(str(cells[c]) for c in sorted(cells))))
                        if number >= first + header_rows:
                            rows.append([(where.get(c, f"_c{c}"), v) for c, v in cells.items()])
                    files, corrupt = [name] * len(rows), [None] * len(rows)
                except (zipfile.BadZipFile, KeyError, ValueError, IndexError, ET.ParseError) as err:
                    files, rows, corrupt = [name], [[]], [f"{type(err).__name__}: {err}"]
                for i in range(0, len(files), 10_000):
                    part = slice(i, i + 10_000)
                    made = [pa.array(files[part], pa.string()), pa.array(rows[part], pa.map_(pa.string(), pa.string())), pa.array(corrupt[part], pa.string())]
                    yield pa.RecordBatch.from_arrays(made, names=["_source_file", "fields", "corrupt"])

    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    named = reader.load(path).select("path", "content").mapInArrow(records, "_source_file string, fields map<string,string>, corrupt string")
    return typed_fields(named, shape)


def _frame(rows: list[tuple[str, int, dict[int, str]]]) -> pd.DataFrame:
    path, number, cells, error = zip(*rows)
    return pd.DataFrame({"path": path, "row_no": pd.array(number, dtype="Int32"), "cells": cells, "error": error})


def _infer(body: DataFrame, columns: dict) -> dict[str, str]:
    checks = []
    for name, c in columns.items():
        for kind in ("bigint", "double"):
            checks.append(F.coalesce(F.bool_and(c.isNull() | c.try_cast(kind).isNotNull()), F.lit(False)).alias(f"{name}\x00{kind}"))
    found = body.agg(*checks).first().asDict()
    return {n: "bigint" if found[f"{n}\x00bigint"] else "double" if found[f"{n}\x00double"] else "string" for n in columns}
