"""Text expressions. All of them stay inside the row: no shuffle, no Python worker."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BREAK = r"[^\p{L}]+"
SENTENCE = r"[^.!?\n]+[.!?]*"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def tokens(text: str | Column) -> Column:
    """Lower-case runs of letters."""
    return F.filter(F.split(F.lower(_col(text)), WORD_BREAK), lambda t: t != "")


def sentences(text: str | Column) -> Column:
    """Trimmed sentences in order, blank ones left out."""
    found = F.regexp_extract_all(_col(text), F.lit(SENTENCE), F.lit(0))
    return F.filter(F.transform(found, lambda s: F.trim(s)), lambda s: s != "")


def letter_share(text: str | Column) -> Column:
    """Share of characters that are letters, 0 for empty text."""
    letters = F.length(F.regexp_replace(_col(text), WORD_BREAK, ""))
    return F.coalesce(F.try_divide(letters, F.length(_col(text))), F.lit(0.0))


def normalised(text: str | Column) -> Column:
    """Lower-case words joined by one space: equal for copies that differ in case, marks or spacing."""
    return F.array_join(tokens(text), " ")


def truncated(text: str | Column, n: int) -> Column:
    return F.left(_col(text), F.lit(n))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token arrays as sets; NULL if both are empty."""
    return let(
        F.struct(a.alias("a"), b.alias("b")),
        lambda s: F.try_divide(F.size(F.array_intersect(s["a"], s["b"])), F.size(F.array_union(s["a"], s["b"]))),
    )


def text_similarity(a: str | Column, b: str | Column) -> Column:
    """Similarity of two texts in 0..1 over their word sets."""
    return jaccard(tokens(a), tokens(b))


def pig_latin(text: str | Column) -> Column:
    """Each blank-separated word in pig latin, in lower case."""

    def word(w: Column) -> Column:
        return (
            F.when(w.rlike("^[aeiou]"), F.concat(w, F.lit("way")))
            .when(w.rlike("^[a-z]"), F.regexp_replace(w, r"(?s)^([^aeiou]+)(.*)$", "$2$1ay"))
            .otherwise(w)
        )

    return F.array_join(F.transform(F.split(F.lower(_col(text)), " "), word), " ")


def column_checksum(columns: list[str], null_token: str | None = None) -> Column:
    """SHA-256 over the columns in the order given, joined by ``||``.

    NULL is skipped unless ``null_token`` is given, so (a, NULL, b) equals (a, b) by default.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.sha2(F.concat_ws("||", *parts), 256)


def lexicon_hits(text_tokens: Column, terms: list[str]) -> Column:
    """Number of tokens that belong to the term list."""
    return F.size(F.filter(text_tokens, lambda t: t.isin(terms)))
