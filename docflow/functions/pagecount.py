"""Page count of binary files, one Arrow batch at a time."""

from __future__ import annotations

import io
import re
import zipfile
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

_PAGE = re.compile(rb"/Type\s*/Page(?![A-Za-z])")
_STREAM = re.compile(rb"/ObjStm\b.*?stream\r?\n(.*?)endstream", re.S)
MAX_INFLATED = 64 << 20
_SLIDE = re.compile(r"ppt/slides/slide\d+\.xml$")


def count_pages(content: bytes | None) -> int | None:
    """Pages of a PDF, slides of a PPTX, 1 for a DOCX; None if the bytes cannot be read."""
    if content is None:
        return None
    try:
        if content[:4] == b"PK\x03\x04":
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                names = z.namelist()
            slides = sum(1 for n in names if _SLIDE.match(n))
            return slides or (1 if "word/document.xml" in names else None)
        if not content.startswith(b"%PDF-") or b"%%EOF" not in content[-2048:]:
            return None
        parts = [content, *_object_streams(content)]
        found = _tree_count(content, parts)
        return found if found is not None else sum(len(_PAGE.findall(p)) for p in parts)
    except Exception:
        return None


def _object_streams(content: bytes) -> list[bytes]:
    """Contents of the compressed object streams, in file order. One that inflates beyond ``MAX_INFLATED`` is an error."""
    found = []
    for m in _STREAM.finditer(content):
        inflate = zlib.decompressobj()
        try:
            found.append(inflate.decompress(m.group(1), MAX_INFLATED))
        except zlib.error:
            continue
        if inflate.unconsumed_tail:
            raise ValueError("object stream too large")
    return found


def _tree_count(content: bytes, parts: list[bytes]) -> int | None:
    """``/Count`` of the page tree that the last trailer leads to, so replaced and deleted pages don't count; None if
    the way there isn't found."""
    roots = re.findall(rb"/Root\s+(\d+)\s+\d+\s+R", content)
    if not roots:
        return None
    root = _last_object(roots[-1], content, parts)
    pages = re.search(rb"/Pages\s+(\d+)\s+\d+\s+R", root or b"")
    tree = _last_object(pages[1], content, parts) if pages else None
    count = re.search(rb"/Count\s+(\d+)", tree or b"")
    return int(count[1]) if count else None


def _last_object(number: bytes, content: bytes, parts: list[bytes]) -> bytes | None:
    """The newest definition of an object: the last one in the file, else the one in an object stream."""
    plain = re.findall(rb"(?<!\d)%s\s+\d+\s+obj\b(.*?)endobj" % number, content, re.S)
    if plain:
        return plain[-1]
    for part in reversed(parts[1:]):
        head = re.match(rb"\s*((?:\d+\s+\d+\s+)+)", part)
        places = head[1].split() if head else []
        for i in range(0, len(places) - 1, 2):
            if places[i] == number:
                body = part[head.end() :]
                stop = int(places[i + 3]) if i + 3 < len(places) else len(body)
                return body[int(places[i + 1]) : stop]
    return None


@F.pandas_udf(IntegerType())
def file_page_count(content: pd.Series) -> pd.Series:
    return pd.Series([count_pages(None if b is None else bytes(b)) for b in content], dtype="Int32")
