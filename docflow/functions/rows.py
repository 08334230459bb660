"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.text import WORD_BREAK


def array_rows(df: DataFrame, array: str | Column, value: str, pos: str | None = None, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``keep``, the position (from 0) if named, and one row per array entry.

    The outer form with a later filter is used on purpose: for the inner form Catalyst adds a size check of the
    array below the explode, which computes a derived array (tokens, parsed elements) two more times.
    """
    index = pos or "_pos"
    rows = df.select(*keep, F.posexplode_outer(array).alias(index, value)).filter(F.col(index).isNotNull())
    return rows if pos else rows.drop(index)


def token_rows(df: DataFrame, text: str, value: str = "term", keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One row per token. Blanks are dropped as rows: without a lambda the split and explode are compiled together."""
    return array_rows(df, F.split(F.lower(F.col(text)), WORD_BREAK), value, keep=keep).filter(F.col(value) != "")
