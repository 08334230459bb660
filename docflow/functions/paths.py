"""Columns derived from a file path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extension -> media type.
MEDIA_TYPES = {
    "pdf": "application/pdf",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "html": "text/html",
    "htm": "text/html",
    "txt": "text/plain",
    "md": "text/markdown",
    "csv": "text/csv",
    "json": "application/json",
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "tiff": "image/tiff",
    "bmp": "image/bmp",
    "gif": "image/gif",
}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path: str | Column) -> Column:
    """Last path component by regular expression; empty for a path that ends in a slash."""
    return F.regexp_extract(_col(path), r"([^/]+)$", 1)


def last_segment(path: str | Column) -> Column:
    """Last path component by splitting."""
    return F.element_at(F.split(_col(path), "/"), -1)


def extension(path: str | Column) -> Column:
    """Lower-case extension without the dot; empty if there is none."""
    return F.lower(F.regexp_extract(_col(path), r"\.([A-Za-z0-9]+)$", 1))


def parent_path(path: str | Column) -> Column:
    return F.regexp_extract(_col(path), r"^(.*)/[^/]*$", 1)


def media_type(path: str | Column) -> Column:
    ext = extension(path)
    out = F.lit("application/octet-stream")
    for name, value in MEDIA_TYPES.items():
        out = F.when(ext == name, value).otherwise(out)
    return out


def doc_key(path: str | Column) -> Column:
    """Stable document identity. File names repeat across folders, paths do not."""
    return F.sha2(_col(path), 256)
