"""Enrichment steps as SQL functions, so that plain SQL jobs can call them by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

from docflow.functions.lexicon import LABEL_TERMS
from docflow.functions.text import SENTENCE, WORD_BREAK
from docflow.operators.enrich import FIELD_RULES, TOPIC_BREAK


def _q(value: str) -> str:
    """SQL raw string literal of a pattern or word."""
    return 'r"' + value.replace('"', r"\x22") + '"'


def _words(terms: list[str]) -> str:
    return ", ".join(f"'{t}'" for t in terms)


def register_functions(
    spark: SparkSession,
    lexicon: dict[str, list[str]] | None = None,
    rules: dict[str, tuple[str, int, float]] | None = None,
    prefix: str = "",
    temporary: bool = True,
) -> list[str]:
    """Create the SQL functions and return their names.

    ``prefix`` may be a database name with a dot, together with ``temporary=False``, for a catalog-wide function.
    """
    lexicon, rules = lexicon or LABEL_TERMS, rules or FIELD_RULES
    kind = "CREATE OR REPLACE TEMPORARY FUNCTION" if temporary else "CREATE OR REPLACE FUNCTION"
    every = _words(sorted({t for terms in lexicon.values() for t in terms}))
    scores = ", ".join(
        f"named_struct('rank', -size(filter(hits, t -> t IN ({_words(terms)}))), 'label', '{label}')" for label, terms in lexicon.items()
    )
    shape, values = [], []
    for name, (pattern, group, _) in rules.items():
        value = f"nullif(regexp_extract(text, {_q(pattern)}, {group}), '')"
        many = name == "key_topics"
        shape.append(f"{name}: {'ARRAY<STRING>' if many else 'STRING'}")
        values.append(f"'{name}', " + (f"split({value}, {_q(TOPIC_BREAK)})" if many else value))
    # Sentences of the text, each with its place, its number of words and the mean frequency of its words.
    sentence = f"filter(transform(regexp_extract_all(text, {_q(SENTENCE)}, 0), s -> trim(s)), s -> s <> '')"
    
    def tokens_of(x: str) -> str:
        return f"filter(split(lower({x}), {_q(WORD_BREAK)}), t -> t <> '')"

    bodies = {
        "file_name": "(path STRING) RETURNS STRING RETURN regexp_extract(path, r'([^/]+)$', 1)",
        "chunk_page_ranges": (
            "(n INT, size INT DEFAULT 500) RETURNS ARRAY<STRING> RETURN CASE WHEN n > 0 THEN "
            "transform(sequence(1, n, size), s -> concat(s, '-', least(s + size - 1, n))) ELSE array() END"
        ),
        "classify_document": (
            "(text STRING) RETURNS STRING RETURN (WITH found AS (SELECT "
            f"filter(split(lower(text), {_q(WORD_BREAK)}), t -> t IN ({every})) AS hits), "
            f"ranked AS (SELECT array_sort(array({scores}))[0] AS best FROM found) "
            "SELECT CASE WHEN text IS NULL THEN NULL WHEN best.rank < 0 THEN best.label ELSE 'other' END FROM ranked)"
        ),
        "extract_document": (
            f"(text STRING) RETURNS STRUCT<{', '.join(shape)}> RETURN named_struct({', '.join(values)})"
        ),
        "summarize_document": (
            "(text STRING, max_words INT DEFAULT 300) RETURNS STRING RETURN (WITH "
            f"cut AS (SELECT {sentence} AS s, {tokens_of('text')} AS w), "
            f"told AS (SELECT s, w, transform(s, x -> {tokens_of('x')}) AS t FROM cut), "
            "scored AS (SELECT s, filter(transform(t, (x, i) -> named_struct('rank', -aggregate(x, 0D, (a, y) -> a + size(filter(w, z -> z = y))) / "
            "nullif(size(x), 0), 'pos', i, 'n', size(x))), x -> x.n > 0) AS r FROM told), "
            "taken AS (SELECT s, aggregate(array_sort(r), named_struct('run', 0, 'words', 0, 'pos', cast(array() AS ARRAY<INT>)), (a, x) -> named_struct("
            "'run', a.run + x.n, 'words', CASE WHEN a.run + x.n <= max_words OR a.run = 0 THEN a.words + x.n ELSE a.words END, "
            "'pos', CASE WHEN a.run + x.n <= max_words OR a.run = 0 THEN array_append(a.pos, x.pos) ELSE a.pos END)) AS k FROM scored), "
            "joined AS (SELECT k.words AS n, array_join(transform(array_sort(k.pos), p -> s[p]), ' ') AS j FROM taken) "
            "SELECT CASE WHEN n > max_words THEN array_join(slice(split(j, ' '), 1, max_words), ' ') ELSE j END FROM joined)"
        ),
        "pig_latin": (
            "(text STRING) RETURNS STRING RETURN array_join(transform(split(lower(text), ' '), w -> CASE "
            "WHEN w RLIKE '^[aeiou]' THEN concat(w, 'way') "
            "WHEN w RLIKE '^[a-z]' THEN regexp_replace(w, r'(?s)^([^aeiou]+)(.*)$', '$2$1ay') ELSE w END), ' ')"
        ),
    }
    for name, body in bodies.items():
        spark.sql(f"{kind} {prefix}{name}{body}")
    return [prefix + name for name in bodies]
