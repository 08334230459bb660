"""Table writes: managed tables, part folders and keyed tables.

A part folder counts only when its job has committed (Spark's ``_SUCCESS`` mark), so a lost executor or
a crashed driver leaves nothing half visible, and repeating a write replaces the same folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import hadoop_fs


def save_table(df: DataFrame, name: str, mode: str = "overwrite", merge_schema: bool = False) -> None:
    """Write a managed table: ``overwrite`` takes the new schema, ``append`` matches columns by name.

    A column that the table does not have is refused on append; with ``merge_schema`` it is added to the table first.
    """
    if mode == "append" and df.sparkSession.catalog.tableExists(name):
        df = fit_to_table(df, name, merge_schema)
    df.write.mode(mode).saveAsTable(name)


def fit_to_table(df: DataFrame, name: str, merge_schema: bool = False) -> DataFrame:
    """``df`` with the columns of an existing table, in its order; missing ones are NULL. Batch or stream.

    New columns are added to the table with ``merge_schema`` and refused without.
    """
    spark = df.sparkSession
    known = {c.lower() for c in spark.table(name).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new and not merge_schema:
        raise ValueError(f"new columns {[f.name for f in new]}; use merge_schema")
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    have = {c.lower() for c in df.columns}
    fields = spark.table(name).schema.fields
    return df.select(*[F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def create_or_replace_as(spark: SparkSession, name: str, query: str) -> None:
    """Create or replace a table from a SQL query."""
    save_table(spark.sql(query), name)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a stage and read it back: later stages do not recompute it and its lineage ends here."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _children(spark: SparkSession, root: str) -> list[str]:
    fs, path = hadoop_fs(spark, root)
    if not fs.exists(path):
        return []
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(path) if s.isDirectory())


def _committed(spark: SparkSession, folder: str) -> bool:
    fs, path = hadoop_fs(spark, folder + "/_SUCCESS")
    return bool(fs.exists(path))


def committed_parts(spark: SparkSession, table: str) -> list[str]:
    return [f for f in _children(spark, table) if _committed(spark, f)]


def append_aligned(spark: SparkSession, df: DataFrame, table: str, part: str, merge_schema: bool = False) -> None:
    """Write one part of a table folder after checking its columns against the parts already there.

    A changed type is refused, a new column needs ``merge_schema``.
    """
    parts = [p for p in committed_parts(spark, table) if not p.endswith("/" + part)]
    if parts:
        old = spark.read.option("mergeSchema", True).parquet(*parts).schema
        types = {f.name: f.dataType for f in old.fields}
        for f in df.schema.fields:
            if f.name in types and types[f.name] != f.dataType:
                raise ValueError(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
            if f.name not in types and not merge_schema:
                raise ValueError(f"new column {f.name}; use merge_schema")
    df.write.mode("overwrite").parquet(f"{table}/{part}")


# ---- keyed tables: batches of changed rows, merged when read -------------------------------------
#
# A batch writes only its own rows (``batch=<n>``), whatever the size of the table. ``compact`` folds the state up to
# a batch into one folder (``state=<n>``); readers take the newest state and the batches after it.
#
# The number is the table's own. A writer that counts by itself (a stream's batch, a run) gives its count as a tag, and its
# identity: every start of a stream from a new checkpoint is another writer. A folder is named ``<number>-by=<writer>-of=<tag>``,
# so the commit of the folder is also the record of who wrote it. A batch is a replay, and replaces itself, if the same writer
# wrote the same tag; nothing else is ever replaced. Once a writer has been followed by a newer start of its own name
# (``name@epoch``), its batches are refused: two starts of one stream can't take turns.

_FOLDER = re.compile(r"^([a-z]+)=(\d+)(?:-by=([A-Za-z0-9_.@]+))?(?:-of=(\d+))?$")


class StaleWriter(RuntimeError):
    """A newer start of the same writer has written to the table."""


def _number(name: str) -> int:
    return int(name.split("=")[1].split("-")[0])


def _numbered(folders: list[str], prefix: str) -> dict[str, str]:
    """Folders by name. Writers that work at the same time may take one number; their folders count both."""
    named = [(f.rsplit("/", 1)[-1], f) for f in folders]
    return {name: f for name, f in named if name.startswith(prefix)}


def commits(spark: SparkSession, table: str) -> list[tuple[str, int, str | None, int | None]]:
    """Kind, number, writer and tag of each committed folder, in the order of the numbers. Only names are read."""
    found = [_FOLDER.match(f.rsplit("/", 1)[-1]) for f in committed_parts(spark, table)]
    rows = [(m[1], int(m[2]), m[3], None if m[4] is None else int(m[4])) for m in found if m]
    return sorted(rows, key=lambda r: (r[1], r[0]))


def _parted(writer: str) -> tuple[str, int]:
    name, _, epoch = writer.partition("@")
    return name, int(epoch or 0)


def new_epoch(spark: SparkSession, table: str, writer: str) -> str:
    """``writer@epoch`` for a new start of a writer: one more than its newest start that wrote to the table."""
    mine = [_parted(w)[1] for _, _, w, _ in commits(spark, table) if w and _parted(w)[0] == writer]
    return f"{writer}@{max(mine, default=0) + 1}"


def next_folder(spark: SparkSession, table: str, prefix: str, tag: int | None = None, writer: str | None = None) -> tuple[int, str]:
    """Number and name of the folder for a new batch, or of the one that the same writer wrote under the same tag.

    Without a writer there are no replays: each call gets the next number."""
    known = commits(spark, table)
    if writer is not None:
        if not re.fullmatch(r"[A-Za-z0-9_.]+(@\d+)?", writer):
            raise ValueError(f"not a writer's name: {writer!r}")
        name, epoch = _parted(writer)
        if any(w and _parted(w)[0] == name and _parted(w)[1] > epoch for _, _, w, _ in known):
            raise StaleWriter(f"{writer}: a newer start of this writer has written to {table}")
        for kind, number, w, t in known:
            if tag is not None and (f"{kind}=", w, t) == (prefix, writer, tag):
                return number, _folder(prefix, number, writer, tag)
    return (number := max([n for _, n, _, _ in known], default=-1) + 1), _folder(prefix, number, writer, tag)


def _folder(prefix: str, number: int, writer: str | None, tag: int | None) -> str:
    return f"{prefix}{number:020d}" + (f"-by={writer}" if writer else "") + (f"-of={tag}" if tag is not None else "")


def batches(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the committed batches that are not part of a compacted state."""
    parts = committed_parts(spark, table)
    floor = max(map(_number, _numbered(parts, "state=")), default=-1)
    return sorted(n for n in map(_number, _numbered(parts, "batch=")) if n > floor)


def last_batch(spark: SparkSession, table: str) -> int:
    """Number of the newest batch, -1 before the first."""
    parts = committed_parts(spark, table)
    return max(map(_number, [*_numbered(parts, "batch="), *_numbered(parts, "state=")]), default=-1)


def write_changes(df: DataFrame, table: str, batch: int | None = None, tag: int | None = None, writer: str | None = None) -> int:
    """Write the rows that a batch inserts or updates and return its number.

    The same ``batch`` replaces itself; without one the table's next number is taken, or again the one that this ``writer``
    wrote under this ``tag``. A tag without a writer tells nothing and is only kept in the folder's name.
    """
    if batch is None:
        batch, name = next_folder(df.sparkSession, table, "batch=", tag, writer)
    else:
        name = f"batch={batch:020d}"
    df.write.mode("overwrite").parquet(f"{table}/{name}")
    return batch


def read_current(spark: SparkSession, table: str, keys: list[str], version: str, schema: str, upto: int | None = None) -> DataFrame:
    """Newest row per key by ``version``; on equal versions the earlier batch stays, as in an upsert. One rule for any
    number of folders.

    ``upto`` reads the state as it was after that batch.
    """
    parts = committed_parts(spark, table)
    states = {_number(n): f for n, f in _numbered(parts, "state=").items() if upto is None or _number(n) <= upto}
    floor = max(states, default=-1)
    later = [f for n, f in sorted(_numbered(parts, "batch=").items()) if _number(n) > floor and (upto is None or _number(n) <= upto)]
    found = ([states[floor]] if states else []) + later
    if not found:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*found)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"(?:batch|state)=([0-9]+[^/]*)/[^/]*$", 1)
    number = F.substring_index(folder, "-", 1).cast("bigint")
    rest = [c for c in rows.columns if c not in keys]
    ranked = rows.select(*keys, F.struct(*rest).alias("_row"), F.struct(F.col(version).alias("v"), (-number).alias("n"), folder.alias("f")).alias("_order"))
    return ranked.groupBy(*keys).agg(F.max_by("_row", "_order").alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def compact(spark: SparkSession, table: str, keys: list[str], version: str, schema: str) -> None:
    """Fold all batches so far into one state, while nobody else writes. Batches stay until they are removed by hand."""
    newest = last_batch(spark, table)
    if newest >= 0:
        read_current(spark, table, keys, version, schema).write.mode("overwrite").parquet(f"{table}/state={newest:020d}")
