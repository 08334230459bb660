"""URL filter: rules first, then trust and distrust that flow over the host graph. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import free_name, stored

# Rules as (host and path prefix, verdict). A rule holds for its host and all subdomains; the longest that fits wins.
RULES: list[tuple[str, str]] = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
CHECKPOINT_EVERY = 4
DAMPING_PERCENT = 85
RATIO = 2
UNIT = 10**12  # of the ranks that are returned
FINE = 10**24  # ranks are carried as whole numbers of this unit, so sums don't depend on their order
BOUND = FINE // 10**9  # the rounds end when none reaches a new host and all ranks together change by less
RANK, COUNT = "decimal(38,0)", "decimal(12,0)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?((?:https?:)?//[^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest rule that fits and its verdict, NULL if none does. Equally long ones: block first, then by text."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block", r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(says)).otherwise(verdict)
    return found, verdict


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst, n``: links from pages of one host to another host. Links within a host are none."""
    links = pages.select(
        host_of(F.col(url)).alias("src"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1))).alias("_to"),
    )
    target = F.when(F.col("_to").startswith("//"), F.concat(F.lit("http:"), F.col("_to"))).otherwise(F.col("_to"))
    edges = links.select("src", host_of(target).alias("dst")).filter("src <> '' AND dst <> '' AND src <> dst")
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def share_of(rank: Column, part: Column, whole: Column) -> Column:
    """``floor(rank * part / whole)``; exact for ranks up to ``FINE`` and counts up to 10**11 times a percentage."""
    return F.floor((rank * part).cast(RANK) / whole).cast(RANK)


def propagate(edges: DataFrame, seeds: DataFrame, iterations: int | None = None, damping_percent: int = DAMPING_PERCENT) -> DataFrame:
    """Personalised PageRank of two kinds at once: ``kind, host, rank``.

    ``seeds``: ``kind, host, seed`` in ``FINE``. Kind ``trust`` goes along the links, kind ``distrust`` against them.
    Rank that reaches a host without a way on leaves the graph. Each round is one join and one sum combined before its
    shuffle, with one division per link; the lineage is cut every ``CHECKPOINT_EVERY`` rounds. Without ``iterations``,
    the rounds end when the last one reached no new host and changed all ranks together by less than ``BOUND``; what is
    left to come is then below ``BOUND * d / (1 - d)`` for a damping d.
    """
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), "n").unionAll(
        edges.select(F.lit("distrust"), "dst", "src", "n")
    )
    degree = both.groupBy("kind", "from").agg(F.sum("n").alias("_all"))
    part, whole = (F.col("n") * damping_percent).cast("decimal(14,0)").alias("part"), (F.col("_all") * 100).cast("decimal(14,0)").alias("whole")
    ways = stored(both.join(degree, ["kind", "from"]).select(F.col("kind").alias("_kind"), "from", "to", part, whole), "host-ways")
    ranks = seeds.select("kind", "host", F.col("seed").alias("rank"))
    start = share_of(F.col("seed"), F.lit(100 - damping_percent).cast(COUNT), F.lit(100).cast(COUNT))
    kept = seeds.select("kind", "host", start.alias("rank"))

    def turn(ranks: DataFrame) -> DataFrame:
        sent = ranks.join(ways, (F.col("kind") == F.col("_kind")) & (F.col("host") == F.col("from"))).select(
            "kind", F.col("to").alias("host"), share_of(F.col("rank"), F.col("part"), F.col("whole")).alias("rank")
        )
        return kept.unionAll(sent.filter("rank > 0")).groupBy("kind", "host").agg(F.sum("rank").cast(RANK).alias("rank"))

    i = 0
    while iterations is None or i < iterations:
        before, ranks, i = ranks, turn(ranks), i + 1
        if iterations is not None and i % CHECKPOINT_EVERY == 0:
            ranks = stored(ranks, "host-ranks")
        if iterations is None and (i == 1 or i % CHECKPOINT_EVERY == 0):
            before, ranks = stored(before, "host-ranks"), stored(ranks, "host-ranks")
            old = before.withColumnRenamed("rank", "old")
            moved = F.abs(F.coalesce("rank", F.lit(0)) - F.coalesce("old", F.lit(0)))
            change = ranks.join(old, ["kind", "host"], "full").agg(F.sum(moved).alias("moved"), F.count_if(F.col("old").isNull()).alias("new")).first()
            if not change["new"] and (change["moved"] or 0) < BOUND:
                break
    return ranks


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]] = RULES,
    url: str = "url",
    html: str = "html",
    ratio: int = RATIO,
    iterations: int | None = None,
) -> DataFrame:
    """``pages`` with a struct column ``url_filter``: ``host, path, rule, verdict, trust, distrust``.

    Pages that a rule allows are trusted seeds, pages that a rule blocks are blocked seeds, by host and number. A page
    without a rule takes its host's verdict: blocked if the host's distrust is above ``ratio`` times its trust. Hosts
    that neither reaches, and pages without a host, are allowed. Every row of ``pages`` stays one row.
    """
    out = free_name(pages, "url_filter")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    places = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    marked = places.select("host", verdict.alias("says"))
    seeds = marked.filter("says IS NOT NULL AND host <> ''").groupBy("host", F.when(F.col("says") == "allow", "trust").otherwise("distrust").alias("kind"))
    seeds = seeds.agg(F.count(F.lit(1)).alias("n"))
    total = seeds.groupBy("kind").agg(F.sum("n").alias("_all"))
    scaled = share_of(F.lit(str(FINE)).cast(RANK), F.col("n").cast(COUNT), F.col("_all").cast(COUNT))
    seeds = stored(seeds.join(total, "kind").select("kind", "host", scaled.alias("seed")), "host-seeds")
    ranks = propagate(host_edges(pages, url, html), seeds, iterations)
    hosts = stored(
        ranks.groupBy("host").agg(
            F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("rank"))), F.lit(0)).cast(RANK).alias("_trust"),
            F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))), F.lit(0)).cast(RANK).alias("_distrust"),
        ).withColumnRenamed("host", "_host"),
        "host-verdicts",
    )
    rows = pages.withColumn(out, F.struct(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")))
    mine = F.col(f"`{out}`")
    r, v = rule_for(mine["host"], mine["path"], rules)
    other = F.when(F.col("_distrust") > ratio * F.col("_trust"), F.lit("block")).otherwise(F.lit("allow"))
    verdicts = F.struct(
        mine["host"].alias("host"), mine["path"].alias("path"), r.alias("rule"), F.coalesce(v, other).alias("verdict"),
        *[F.coalesce(F.floor(F.col(f"_{k}") / F.lit(FINE // UNIT).cast("decimal(13,0)")).cast("long"), F.lit(0)).alias(k) for k in ("trust", "distrust")],
    )
    joined = rows.join(hosts, mine["host"] == hosts["_host"], "left")
    return joined.select(*[F.col(f"`{c}`") for c in pages.columns], verdicts.alias(out))
