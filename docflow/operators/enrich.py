"""Deterministic enrichment: classification, field extraction, summaries, topics, sentiment.

The defaults are simple baselines that keep the contracts (label in a response array, NULL for an absent field,
summary under a word limit). ``docflow.operators.model`` runs any model of the user in their place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.functions.lexicon import LABEL_TERMS, NEGATIVE, POSITIVE
from docflow.functions.rows import array_rows, token_rows
from docflow.functions.text import let, lexicon_hits, pig_latin, sentences, tokens

FREQUENT = 1 << 16  # terms whose frequencies go to all tasks; the others are joined

RESPONSE = "struct<response:array<string>,error_message:string>"

# ---- classification ---------------------------------------------------------------------------


def label_scores(text: str | Column, lexicon: dict[str, list[str]]) -> Column:
    """``array<struct<score, label>>`` counted in the row: one pass over the tokens, then over the few hits."""
    every = sorted({t for terms in lexicon.values() for t in terms})
    hits = F.filter(tokens(text), lambda t: t.isin(every))
    return let(
        hits,
        lambda h: F.array(*[F.struct(lexicon_hits(h, terms).alias("score"), F.lit(label).alias("label")) for label, terms in lexicon.items()]),
    )


def best_label(scores: Column, other: str = "other") -> Column:
    """Label with the highest score, ties by name; ``other`` if nothing was hit."""
    ranked = F.transform(scores, lambda s: F.struct((-s["score"]).alias("rank"), s["label"].alias("label")))
    none = F.struct(F.lit(other).alias("label"), F.lit(0).alias("score"))
    return let(
        F.array_min(ranked),
        lambda best: F.when(best["rank"] < 0, F.struct(best["label"].alias("label"), (-best["rank"]).alias("score"))).otherwise(none),
    )


def classify(text: str | Column, lexicon: dict[str, list[str]] | None = None, other: str = "other") -> Column:
    """``struct<label, score>``; NULL for NULL text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.when(col.isNotNull(), best_label(label_scores(col, lexicon or LABEL_TERMS), other))


def classification_response(label: Column, error: Column) -> Column:
    """JSON response in the contract of a classification call."""
    response = F.when(error.isNull(), F.array(label))
    return F.to_json(F.struct(response.alias("response"), error.alias("error_message")), {"ignoreNullFields": "false"})


def response_label(response: str | Column) -> tuple[Column, Column]:
    """(first label, error message) of a JSON response; a response that is no such JSON is an error."""
    raw = F.col(response) if isinstance(response, str) else response
    value = F.from_json(raw, RESPONSE)
    label = F.get(value["response"], 0)
    error = F.coalesce(value["error_message"], F.when(raw.isNotNull() & value["response"].isNull(), "malformed response"))
    return label, error


# ---- extraction -------------------------------------------------------------------------------

# Field -> (pattern, group, confidence).
FIELD_RULES: dict[str, tuple[str, int, float]] = {
    "title": (r"^\s*([^\n]+)", 1, 0.6),
    "company": (r"(?i:company|organisation|organization)\s*[:=]\s*([^\n]+)", 1, 0.8),
    "product": (r"(?i:product)\s*[:=]\s*([^\n]+)", 1, 0.8),
    "author": (r"(?i:author|written by|prepared by)\s*[:=]?\s+([^\n]+)", 1, 0.8),
    "date": (r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1, 0.9),
    "key_topics": (r"(?i:key topics|keywords)\s*[:=]\s*([^\n]+)", 1, 0.7),
    "summary": (r"(?i:summary|abstract)\s*[:=]\s*([^\n]+)", 1, 0.7),
}

# Contact and licence patterns.
CONTACT_RULES: dict[str, tuple[str, int, float]] = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", 0, 0.95),
    "phone": (r"\+?[0-9][0-9 ()-]{7,}[0-9]", 0, 0.6),
    "ip": (r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", 0, 0.9),
    "licence": (r"(?i:licen[cs]e|copyright)[^\n]*", 0, 0.7),
}


def extract_field(text: str | Column, rule: tuple[str, int, float]) -> Column:
    """``struct<value, offset, confidence>``: first match, its place (from 1) as citation, the rule's weight."""
    col = F.col(text) if isinstance(text, str) else text
    pattern, group, weight = rule
    return let(
        F.nullif(F.regexp_extract(col, pattern, group), F.lit("")),
        lambda value: F.when(
            value.isNotNull(),
            F.struct(value.alias("value"), F.instr(col, value).alias("offset"), F.lit(weight).alias("confidence")),
        ),
    )


def extract(text: str | Column, rules: dict[str, tuple[str, int, float]] | None = None) -> Column:
    """Struct with one entry per field; an absent field is NULL."""
    return F.struct(*[extract_field(text, rule).alias(name) for name, rule in (rules or FIELD_RULES).items()])


def extract_fields(df: DataFrame, text: str, rules: dict, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document and field: keys, ``field, value, offset, confidence``."""
    pairs = [F.struct(F.lit(name).alias("field"), extract_field(text, rule).alias("found")) for name, rule in rules.items()]
    rows = array_rows(df, F.array(*pairs), "_f", keep=keys)
    return rows.select(*keys, "_f.field", "_f.found.value", "_f.found.offset", "_f.found.confidence")


TOPIC_BREAK = r",\s*"


def topic_list(value: str | Column) -> Column:
    """Comma-separated topics to an array; NULL stays NULL."""
    return F.split(F.col(value) if isinstance(value, str) else value, TOPIC_BREAK)


def category_hits(text: str | Column, category: Column, patterns: dict[str, str], default: str) -> Column:
    """All matches of the pattern that belongs to the document's category."""
    col = F.col(text) if isinstance(text, str) else text
    out = F.regexp_extract_all(col, F.lit(default), F.lit(0))
    for name, pattern in patterns.items():
        out = F.when(category == name, F.regexp_extract_all(col, F.lit(pattern), F.lit(0))).otherwise(out)
    return out


# ---- summaries and topics ---------------------------------------------------------------------


def summarize(df: DataFrame, text: str = "text", key: str = "doc_id", max_words: int = 300) -> DataFrame:
    """Extractive summary: ``key, summary, sentences_kept, summary_words``.

    A sentence scores the mean frequency of its words in the document. Sentences are taken by score, ties by
    position, while the running word count stays within ``max_words``, and are put back in text order; a best
    sentence that is longer by itself is cut. Texts are hashed once by key; every later window, aggregation and join
    works inside that partitioning.
    """
    docs = df.filter(F.col(key).isNotNull()).select(key, text).repartition(key)
    rows = array_rows(docs, sentences(text), "sentence", "pos", [key])
    words = token_rows(rows, "sentence", keep=[key, "pos"])
    weighted = words.withColumn("tf", F.count("*").over(W.partitionBy(key, "term")))
    scored = weighted.groupBy(key, "pos").agg(
        (F.sum("tf") / F.count("*")).alias("score"), F.count("*").alias("n_words")
    )
    best_first = W.partitionBy(key).orderBy(F.desc("score"), "pos")
    ranked = (
        scored.withColumn("running", F.sum("n_words").over(best_first.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("place", F.row_number().over(best_first))
        .filter((F.col("running") <= max_words) | (F.col("place") == 1))
    )
    chosen = ranked.groupBy(key).agg(
        F.array_sort(F.collect_list("pos")).alias("_pos"), F.count("*").alias("sentences_kept"), F.sum("n_words").alias("_n")
    )
    # The chosen sentences are cut out of the text again: joining on the key alone needs no further shuffle.
    picked = let(sentences(text), lambda s: F.array_join(F.transform("_pos", lambda p: F.element_at(s, p + 1)), " "))
    # A text without any word has no summary but keeps its row.
    kept = docs.join(chosen, key, "left").select(key, F.coalesce("sentences_kept", F.lit(0)).cast("bigint").alias("sentences_kept"), F.coalesce("_n", F.lit(0)).alias("_n"), picked.alias("_s"))
    cut = F.array_join(F.slice(F.split("_s", " "), 1, max_words), " ")
    return kept.select(
        key,
        F.when(F.col("_n") > max_words, cut).otherwise(F.col("_s")).alias("summary"),
        "sentences_kept",
        F.least("_n", F.lit(max_words)).alias("summary_words"),
    )


def key_topics(df: DataFrame, text: str = "text", key: str = "doc_id", n: int = 5) -> DataFrame:
    """Top ``n`` TF-IDF terms per document: ``key, rank, term, score``; ties by term.

    The frequencies of the ``FREQUENT`` most frequent terms are a bounded list that goes to all tasks: of those terms, only the
    best ``n`` of a document leave it. The rows of all other terms, which are rare, are joined by term.
    """
    # The same shuffle of texts as in ``summarize``: used together they share it. Terms are counted inside it.
    docs = df.filter(F.col(key).isNotNull()).select(key, text).repartition(key)
    tf = token_rows(docs, text, keep=[key]).groupBy(key, "term").agg(F.count("*").alias("tf"))
    # Counting on ``tf`` keeps the column in this branch as well, or the shuffle would not be shared.
    df_ = tf.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    total = df.agg(F.count("*").alias("n"))
    idf = F.log((F.lit(1.0) + total.scalar()) / (F.lit(1.0) + F.col("df")))
    score = F.round(F.col("tf") * idf, 6).alias("score")
    order = W.partitionBy(key).orderBy(F.desc("score"), "term")

    def best(scored: DataFrame) -> DataFrame:
        return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

    frequent = F.broadcast(df_.orderBy(F.desc("df"), "term").limit(FREQUENT))
    # Both sides ask for the same columns of the list, so it is sent once.
    marked = tf.join(frequent, "term", "left")
    known = best(marked.filter("df IS NOT NULL").select(key, "term", score)).drop("rank")
    rare = marked.filter("df IS NULL").drop("df").join(df_, "term").select(key, "term", score)
    return best(known.unionByName(rare))


# ---- sentiment --------------------------------------------------------------------------------


def sentiment(text: str | Column, positive: list[str] | None = None, negative: list[str] | None = None) -> Column:
    """``struct<score, sentiment>``: positive minus negative words."""
    pos, neg = positive or POSITIVE, negative or NEGATIVE
    hits = F.filter(tokens(text), lambda t: t.isin([*pos, *neg]))
    score = let(hits, lambda h: lexicon_hits(h, pos) - lexicon_hits(h, neg))
    return let(
        score,
        lambda n: F.struct(
            n.alias("score"),
            F.when(n > 0, "positive").when(n < 0, "negative").otherwise("neutral").alias("sentiment"),
        ),
    )


# ---- combined results -------------------------------------------------------------------------


def combine(base: DataFrame, key: str, *results: DataFrame) -> DataFrame:
    """Left join of enrichment results that hold one row per key; rows of ``base`` always survive."""
    for result in results:
        base = base.join(result, key, "left")
    return base


def enriched_documents(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    lexicon: dict[str, list[str]] | None = None,
    rules: dict | None = None,
    max_words: int = 300,
    topics: int = 5,
) -> DataFrame:
    """One row per document: category, error, extracted fields, key topics, summary and its pig-latin form."""
    rules = rules or FIELD_RULES
    skip = {"key_topics", "summary"}
    label = classify(text, lexicon)["label"]
    error = F.when(F.col(text).isNull(), "no text")
    category, message = response_label("_response")
    keep = [c for c in df.columns if c != text]
    # The response is its own step: Catalyst keeps it apart because it is used more than once.
    base = df.withColumn("_response", classification_response(label, error)).select(
        *keep,
        category.alias("category"),
        message.alias("error_message"),
        *[extract_field(text, rule)["value"].alias(name) for name, rule in rules.items() if name not in skip],
    )
    top = (
        key_topics(df, text, key, topics)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "term")))["term"].alias("key_topics"))
    )
    short = summarize(df, text, key, max_words).select(key, "summary")
    return combine(base, key, top, short).withColumn("summary_pig_latin", pig_latin("summary"))
