"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are masks over the bits. DataFrame
functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.text import let
from docflow.llm.common import BREAK, WORD_CHAR, free_name, word_array

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# Bit by bit: name and condition under which a document fails. A rule's bit never changes; new rules get new bits.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("many_symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
]
# Versions of the policy: names of the rules that reject a document.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_words"],
    "v1": ["few_words", "repeated_words", "many_symbols"],
    "v2": ["few_words", "repeated_words", "many_symbols", "repeated_lines", "word_length"],
}
POLICY = "v2"


def policy_mask(policy: str | list[str]) -> int:
    names = [n for n, _ in RULES]
    return sum(1 << names.index(n) for n in (POLICIES[policy] if isinstance(policy, str) else policy))


def repeated_window_words(words: Column, n: int = WINDOW) -> Column:
    """Number of words that lie in an ``n``-word window found twice or more in the text.

    Hashes of the windows tell at once that no window repeats; only then are the windows themselves left out. Otherwise
    they are sorted with their places, equal neighbours are the repeats, and their places are joined to spans.
    """
    starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.element_at(words, (i + k).cast("int")) for k in range(n)]))
    windows = F.sort_array(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i, n), " ").alias("w"), i.alias("i"))))

    def places(w: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            return F.get(w, i - 1)["w"].eqNullSafe(x["w"]) | F.get(w, i + 1)["w"].eqNullSafe(x["w"])

        return F.sort_array(F.transform(F.filter(w, twice), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            return F.struct((acc["n"] + F.least(F.lit(n), i - acc["last"])).alias("n"), i.alias("last"))

        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last")), add)["n"]

    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) <= n, 0).when(~repeats, 0).otherwise(let(let(windows, places), covered))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a struct column ``measures`` (all long); the words of a text are split once."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHAR))
    name = free_name(df, "measures")

    def long(c: Column) -> Column:
        return c.cast("long")

    def all_of(w: Column, ls: Column) -> Column:
        return F.struct(
            long(F.size(w)).alias("n_words"),
            long(F.length(F.regexp_replace(t, BREAK, ""))).alias("word_chars"),
            long(F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).alias("n_symbols"),
            long(F.size(ls)).alias("n_lines"),
            long(F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines"),
            long(repeated_window_words(w)).alias("n_repeat_words"),
        )

    bound = let(F.struct(word_array(t).alias("w"), lines.alias("l")), lambda b: all_of(b["w"], b["l"]))
    return df.select(*[F.col(f"`{c}`") for c in df.columns], bound.alias(name))


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``measures`` and ``failed``, a long with bit k set if rule k of ``RULES`` fails.

    NULL and blank texts measure zero and fail ``few_words``. No row is moved or dropped: there is no shuffle.
    """
    measured = measure(df, text)
    m, bits = measured.columns[-1], F.lit(0).cast("long")
    for k, (_, fails) in enumerate(RULES):
        expression = F.expr(" ".join(f"`{m}`.{x}" if x.strip("()") in MEASURES else x for x in fails.split()))
        bits = bits.bitwiseOR(F.when(expression, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn(free_name(measured, "failed"), bits)


def passes(failed: str | Column, policy: str | list[str] = POLICY) -> Column:
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0


def ablation(entries: DataFrame, policy: str | list[str] = POLICY, failed: str = "failed") -> DataFrame:
    """One row per rule of the policy: documents that fail it, that only it rejects, and that are kept without it.

    One pass over the ledger: the bits of each document are compared with masks and summed.
    """
    mask = policy_mask(policy)
    names = POLICIES[policy] if isinstance(policy, str) else policy
    seen = F.col(failed).bitwiseAND(F.lit(mask).cast("long"))
    one = {n: policy_mask([n]) for n in names}
    sums = entries.agg(
        F.count_if(seen == 0).alias("kept"),
        *[F.count_if(seen.bitwiseAND(F.lit(b).cast("long")) != 0).alias(f"f_{n}") for n, b in one.items()],
        *[F.count_if(seen == b).alias(f"o_{n}") for n, b in one.items()],
    )
    rows = [F.struct(F.lit(n).alias("rule"), F.col(f"f_{n}").alias("failed"), F.col(f"o_{n}").alias("only"), (F.col("kept") + F.col(f"o_{n}")).alias("kept_without")) for n in names]
    return sums.select(F.inline(F.array(*rows)))


def kept_documents(df: DataFrame, text: str = "text", policy: str | list[str] = POLICY) -> DataFrame:
    """The rows of ``df`` that the policy keeps, with its columns."""
    entries = ledger(df, text)
    return entries.filter(passes(F.col(f"`{entries.columns[-1]}`"), policy)).select(*[F.col(f"`{c}`") for c in df.columns])
