"""One query per operator over its whole table, with production parameters, and the DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import bpe, conversations, cotraining, line_dedup, mixing, packing, pii, pivot_topk, rule_ledger, simhash, toxicity, url_trust, whitening
from docflow.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

__all__ = ["ORACLES", "QUERIES"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_url_trust(spark, sf):
    judged = url_trust.judge_urls(table(spark, sf, "pages").select("page_id", "url", "html"))
    return judged.select("page_id", "url_filter.host", "url_filter.path", "url_filter.rule", "url_filter.verdict")


@query
def op2_packing(spark, sf):
    return packing.packed(table(spark, sf, "documents"))


@query
def op3_simhash(spark, sf):
    groups = simhash.simhash_groups(table(spark, sf, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_cotraining(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    model = cotraining.fit(docs, table(spark, sf, "labels"))
    return cotraining.scored(docs, model).select("doc_id", "quality.*")


@query
def op5_systematic_mix(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", mixing.n_words("text").alias("size"))
    mix = mixing.systematic_copies(sized, F.col("size"))
    return mix.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.copies") * F.col("mix.size")).alias("taken"))


@query
def op6_rule_ledger(spark, sf):
    entries = rule_ledger.ledger(table(spark, sf, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return entries.select(
        "doc_id",
        *[F.col(f"measures.{n}").alias(n) for n in names],
        (~rule_ledger.passes("failed", "base")).alias("base_failed"),
        rule_ledger.passes("failed").alias("kept"),
        "failed",
    )


@query
def op7_bpe(spark, sf):
    return bpe.digests(table(spark, sf, "documents"))


@query
def op8_line_dedup(spark, sf):
    out = line_dedup.remove_repeated_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "line_dedup.*")


@query
def op9_pivot_topk(spark, sf):
    return pivot_topk.exact_top_k(table(spark, sf, "embeddings"))


@query
def op10_pii(spark, sf):
    found = pii.find_pii(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin("email", "ip", "card", "phone"))
    counts = [pii.count_of(F.col("pii"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(pii.span_list(base), 256).alias("base_sha256"), pii.span_list(F.col("pii")).alias("spans"))


@query
def op11_whitening(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return whitening.component_rows(vectors, whitening.fit(vectors))


@query
def op12_conversation_repair(spark, sf):
    return conversations.repaired(table(spark, sf, "conversations"))[0]


@query
def op13_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.scored(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "toxicity.*")
