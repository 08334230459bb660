"""From raw documents to encoded training data, stage by stage. Each stage works on all rows that the one before it kept.

All stages but the last return the columns of ``documents``; the last one the tokens of each document of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docflow.llm import bpe, line_dedup, mixing, near_copies, rule_ledger, simhash
from docflow.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return rule_ledger.kept_documents(docs)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go, and documents of such lines only."""
    return line_dedup.line_deduped(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays. SimHash groups texts whose fingerprints differ by at most two bits, as its
    own query does; what it can't see is added exactly: all texts whose five-word shingles are at least 80 % alike, however many
    bits their fingerprints differ by. Both kinds of links connect a group."""
    linked = simhash.simhash_groups(docs).select("text_hash", "root").distinct()
    return near_copies.drop_near_copies(docs, linked=linked)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document of the mix."""
    return bpe.digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", remove_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# The SimHash and BPE stages can't be stated in SQL: tests compare run() with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
