"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.session import scratch_path

# Words are runs of characters other than space and \x09-\x0D.
BREAK = r"[ \t-\r]+"
WORD_CHAR = r"[^ \t-\r]"


def word_array(text: str | Column) -> Column:
    """Words of a text in order; NULL and blank texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the cluster's shared folder and read back: the lineage ends here and every later use reads the
    same rows, also after executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until the frame has no such column (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
