"""Element arrays built from raw text and HTML with built-in expressions.

An element is ``{type, content, confidence, bbox: [{page_id, coord}], description}``; ``page_id`` counts from 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions.text import _col, letter_share

ELEMENT = (
    "struct<type:string,content:string,confidence:double,"
    "bbox:array<struct<page_id:int,coord:array<int>>>,description:string>"
)
ELEMENTS = f"array<{ELEMENT}>"

# Element types of a parsed document.
ELEMENT_TYPES = [
    "text", "title", "section_header", "table", "figure", "caption", "page_header", "page_footer", "footnote",
]

PAGE_CHARS = 500
TO_THE_END = 2**31 - 1
TITLE_MAX = 80
HEADER_MAX = 40

# HTML tag -> element type. Any other block tag is text.
HTML_TYPES = {
    "title": "title",
    "h1": "title",
    "h2": "section_header",
    "h3": "section_header",
    "h4": "section_header",
    "h5": "section_header",
    "h6": "section_header",
    "table": "table",
    "caption": "caption",
    "figcaption": "caption",
    "nav": "page_header",
    "footer": "page_footer",
}

# Character references decoded in this order, the ampersand last.
HTML_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "),
    ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
]

HTML_SKIP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|\x01"
# Tags that end a line of text where they open and where they close.
HTML_BREAKS = [
    "html", "head", "body", "title", "h[1-6]", "p", "br", "hr", "div", "section", "article", "aside", "main", "header", "nav", "footer",
    "address", "blockquote", "pre", "figure", "figcaption", "ul", "ol", "li", "dl", "dt", "dd", "table", "caption", "thead", "tbody",
    "tfoot", "tr", "td", "th", "form", "fieldset", "legend", "option", "details", "summary",
]
# A whole table, navigation or footer is one block; any other block begins at a tag that ends a line.
HTML_BLOCK = rf"(?is)(<table\b.*?</table>|<nav\b.*?</nav>|<footer\b.*?</footer>)|(</?(?:{'|'.join(HTML_BREAKS)})\b[^>]*>)"


def element(kind: Column, content: Column, page_id: Column) -> Column:
    return F.struct(
        kind.alias("type"),
        content.alias("content"),
        F.round(letter_share(content), 4).alias("confidence"),
        F.array(F.struct(page_id.cast("int").alias("page_id"), F.lit(None).cast("array<int>").alias("coord"))).alias("bbox"),
        F.lit(None).cast("string").alias("description"),
    )


def line_type(line: Column, pos: Column) -> Column:
    """Type of a text line: a short first line is the title, any other very short line a header."""
    return (
        F.when((pos == 0) & (F.length(line) <= TITLE_MAX), "title")
        .when(F.length(line) <= HEADER_MAX, "section_header")
        .otherwise("text")
    )


def line_elements(text: str | Column) -> Column:
    """One element for each line; blank lines keep their position and are dropped on flattening."""
    return F.transform(
        F.split(_col(text), "\n"),
        lambda line, pos: element(line_type(line, pos), line, F.lit(0)),
    )


def page_count(text: str | Column, page_chars: int = PAGE_CHARS) -> Column:
    """Pages of plain text. NULL text has an unknown count."""
    return F.ceil(F.length(_col(text)) / page_chars).cast("int")


def page_slice(text: str | Column, page: Column, page_chars: int = PAGE_CHARS) -> Column:
    """Text of one page, counted from 1."""
    return F.substring(_col(text), (page - 1) * page_chars + 1, F.lit(page_chars))


def page_elements(text: str | Column, first: Column, last: Column, page_chars: int = PAGE_CHARS) -> Column:
    """One text element for each page of the range ``first..last`` (from 1). ``text`` starts at page ``first``.

    The last page takes all the rest of the text, so a page count that is too low loses nothing.
    """
    return F.when(
        last >= first,
        F.transform(
            F.transform(
                F.sequence(first, last),
                lambda p: F.when(p < last, page_slice(text, p - first + 1, page_chars)).otherwise(
                    F.substring(_col(text), (p - first) * page_chars + 1, F.lit(TO_THE_END))
                ),
            ),
            lambda content, i: element(F.lit("text"), content, i + first - 1),
        ),
    ).otherwise(F.array().cast(ELEMENTS))


def decode_entities(text: Column) -> Column:
    for name, value in HTML_ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(value))
    return text


def html_text(fragment: Column) -> Column:
    """Visible text of an HTML fragment."""
    bare = F.regexp_replace(fragment, r"(?s)<[^>]*>", " ")
    return decode_entities(F.trim(F.regexp_replace(bare, r"[ \t\r\n]+", " ")))


def html_elements(html: str | Column) -> Column:
    """Elements of an HTML page in document order. Tables keep their markup.

    The page is split at block boundaries, so every visible character lands in exactly one element. Blocks without text
    keep their position and are dropped on flattening.
    """
    marked = F.regexp_replace(F.regexp_replace(_col(html), HTML_SKIP, " "), HTML_BLOCK, "\x01$1$2")
    # What follows a whole block is a block of its own.
    closed = F.regexp_replace(marked, r"(?is)(\x01(?:<table\b[^\x01]*?</table>|<nav\b[^\x01]*?</nav>|<footer\b[^\x01]*?</footer>))", "$1\x01")
    blocks = F.split(closed, "\x01")

    def one(block: Column) -> Column:
        tag = F.lower(F.regexp_extract(block, r"^<([A-Za-z0-9]+)", 1))
        content = F.when((tag == "table") & F.lower(block).endswith("</table>"), block).otherwise(html_text(block))
        return F.struct(tag.alias("tag"), content.alias("content"))

    def typed(b: Column) -> Column:
        kind = F.lit("text")
        for name, value in HTML_TYPES.items():
            kind = F.when(b["tag"] == name, value).otherwise(kind)
        return element(kind, b["content"], F.lit(0))

    return F.transform(F.transform(blocks, one), typed)
