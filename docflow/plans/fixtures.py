"""The driver's tables as inputs of the document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions import elements as E
from docflow.operators.flatten import flatten_elements

PAGE_LIMIT = 10

# Words that occur in the invented prose of the tables.
LEXICON = {
    "technical": ["thatin", "ononst", "reth", "shat"],
    "financial": ["inoran", "orantion", "hehely", "quevi"],
    "marketing": ["attion", "erble", "thble", "eau"],
    "report": ["the", "und", "los"],
}
POSITIVE = ["thing", "tion", "attion", "ing"]
NEGATIVE = ["re", "er", "ed", "st"]
QUERIES = {"q1": ["thatin", "ononst"], "q2": ["orantion", "hehely", "thing"], "q3": ["attion", "erble", "thble", "thtion"]}
PAGE_TERMS = ["thatin", "ononst", "orantion", "erble"]
CATEGORY_PATTERNS = {
    "technical": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "financial": r"[0-9]+",
    "marketing": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
}
CATEGORY_DEFAULT = r"[A-Z][a-z]+"
RULES = {
    "has_text": "text IS NOT NULL AND n_chars > 0",
    "valid_size": "n_chars > 0 AND n_chars < 5000",
    "is_english": "lang = 'en'",
}
EVENT_RULES = {"not_error": "event_type <> 'error'", "value_in_range": "value >= 1 AND value < 100"}

STAGES = [
    ("bronze", "true", "text IS NOT NULL"),
    ("parse", "text IS NOT NULL", "text IS NOT NULL AND page_count > 0"),
    ("quality", "text IS NOT NULL AND page_count > 0", "page_count > 0 AND n_chars < 5000"),
    ("publish", "page_count > 0 AND n_chars < 5000", "page_count > 0 AND n_chars < 5000 AND lang = 'en'"),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files: path and page count (pages of 500 characters, from the stored length: no text is read)."""
    d = table(spark, sf, "documents")
    kinds = F.array(F.lit("pdf"), F.lit("pptx"), F.lit("docx"))
    ext = F.get(kinds, F.pmod("doc_id", F.lit(3)).cast("int"))
    return d.select(
        "doc_id",
        F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit("."), ext)).alias("path"),
        "text",
        "lang",
        "source",
        "n_chars",
        F.ceil(F.col("n_chars") / E.PAGE_CHARS).cast("int").alias("page_count"),
    )


def line_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Elements (lines) of the documents, one row each."""
    return flatten_elements(documents(spark, sf), E.line_elements("text"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def ts(literal: str) -> Column:
    return F.lit(literal).cast("timestamp_ntz")
