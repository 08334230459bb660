"""DOCX and PPTX bytes to elements. Small helpers for one file, called inside Arrow batches."""

from __future__ import annotations

import html
import io
import re
import xml.etree.ElementTree as ET
import zipfile

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
_SLIDE = re.compile(r"ppt/slides/slide(\d+)\.xml$")


def _element(kind: str, content: str, page: int) -> dict:
    return {"type": kind, "content": content, "confidence": 1.0, "bbox": [{"page_id": page, "coord": None}], "description": None}


def _joined(node: ET.Element, tag: str) -> str:
    return "".join(t.text or "" for t in node.iter(tag)).strip()


def _table(rows: list[list[str]]) -> str:
    body = "".join("<tr>" + "".join(f"<td>{html.escape(c, quote=False)}</td>" for c in r) + "</tr>" for r in rows)
    return f"<table>{body}</table>"


def _word(z: zipfile.ZipFile) -> list[dict]:
    body = ET.fromstring(z.read("word/document.xml")).find(f"{W}body")
    found = []
    for node in body if body is not None else []:
        if node.tag == f"{W}tbl":
            rows = [[_joined(c, f"{W}t") for c in r.iter(f"{W}tc")] for r in node.iter(f"{W}tr")]
            found.append(_element("table", _table(rows), 0))
        elif node.tag == f"{W}p" and (text := _joined(node, f"{W}t")):
            style = node.find(f"{W}pPr/{W}pStyle")
            name = (style.get(f"{W}val", "") if style is not None else "").lower()
            kind = "title" if name == "title" else "section_header" if name.startswith("heading") else "text"
            found.append(_element(kind, text, 0))
    return found


def _slides(z: zipfile.ZipFile) -> dict[int, str]:
    return {int(m.group(1)): n for n in z.namelist() if (m := _SLIDE.match(n))}


def _shapes(z: zipfile.ZipFile, name: str, page: int) -> list[dict]:
    found = []
    for shape in ET.fromstring(z.read(name)).iter():
        if shape.tag == f"{P}sp":
            lines = [t for p in shape.iter(f"{A}p") if (t := _joined(p, f"{A}t"))]
            holder = shape.find(f"{P}nvSpPr/{P}nvPr/{P}ph")
            title = holder is not None and holder.get("type") in ("title", "ctrTitle")
            if lines:
                found.append(_element("title" if title else "text", "\n".join(lines), page))
        elif shape.tag == f"{A}tbl":
            rows = [[_joined(c, f"{A}t") for c in r.iter(f"{A}tc")] for r in shape.iter(f"{A}tr")]
            found.append(_element("table", _table(rows), page))
    return found


def parse_office(content: bytes, page_range: str | None = None) -> dict:
    """Elements and pages of a DOCX (one page) or a PPTX (a page per slide, limited to ``page_range``)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        slides = _slides(z)
        if not slides:
            return {"elements": _word(z), "pages": [{"pageId": 0, "imageUri": None}]}
        first, last = (int(x) for x in page_range.split("-")) if page_range else (1, max(slides))
        wanted = [n for n in sorted(slides) if first <= n <= last]
        found = [e for n in wanted for e in _shapes(z, slides[n], n - 1)]
        return {"elements": found, "pages": [{"pageId": n - 1, "imageUri": None} for n in wanted]}
