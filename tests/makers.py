"""Files that the tests need, written with the standard library."""

from __future__ import annotations

import html
import io
import zipfile
import zlib


def pdf(pages: int, packed: bool = False) -> bytes:
    marks = b"".join(b"%d 0 obj << /Type /Page /Parent 1 0 R >> endobj\n" % (i + 2) for i in range(pages))
    head = b"%PDF-1.5\n1 0 obj << /Type /Pages /Count " + str(pages).encode() + b" >> endobj\n"
    if packed:
        body = zlib.compress(marks)
        marks = b"9 0 obj << /Type /ObjStm /Filter /FlateDecode >> stream\n" + body + b"\nendstream endobj\n"
    return head + marks + b"trailer\n%%EOF\n"


def _zip(files: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def docx(title: str, paragraphs: list[str], table: list[list[str]] | None = None) -> bytes:
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'

    def para(text: str, style: str = "") -> str:
        mark = f'<w:pPr><w:pStyle w:val="{style}"/></w:pPr>' if style else ""
        return f"<w:p>{mark}<w:r><w:t>{html.escape(text)}</w:t></w:r></w:p>"

    body = para(title, "Title") + para("Part one", "Heading1") + "".join(para(p) for p in paragraphs)
    if table:
        body += "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{para(c)}</w:tc>" for c in r) + "</w:tr>" for r in table) + "</w:tbl>"
    return _zip({"word/document.xml": f"<w:document {ns}><w:body>{body}</w:body></w:document>"})


def pptx(slides: list[tuple[str, str]]) -> bytes:
    ns = (
        'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" '
        'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main"'
    )

    def shape(text: str, title: bool) -> str:
        holder = '<p:nvSpPr><p:nvPr><p:ph type="title"/></p:nvPr></p:nvSpPr>' if title else ""
        return f"<p:sp>{holder}<p:txBody><a:p><a:r><a:t>{text}</a:t></a:r></a:p></p:txBody></p:sp>"

    return _zip(
        {
            f"ppt/slides/slide{i + 1}.xml": f"<p:sld {ns}><p:cSld><p:spTree>{shape(t, True)}{shape(b, False)}</p:spTree></p:cSld></p:sld>"
            for i, (t, b) in enumerate(slides)
        }
    )


def xlsx(rows: list[list], sheet: str = "Sheet1") -> bytes:
    m = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    r = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    body = ""
    for i, row in enumerate(rows, 1):
        cells = ""
        for j, v in enumerate(row):
            ref = f"{chr(65 + j)}{i}"
            if v is None:
                continue
            cells += f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{ref}"><v>{v}</v></c>'
        body += f'<row r="{i}">{cells}</row>'
    return _zip(
        {
            "xl/workbook.xml": f'<workbook {m} {r}><sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/worksheets/sheet1.xml": f"<worksheet {m}><sheetData>{body}</sheetData></worksheet>",
        }
    )
