"""Expectations, quarantine, metrics and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Rules = dict[str, str]

# Rule sets of the later stages; those of files are in ``bronze.file_rules``.
PARSED_RULES = {
    "has_parsed": "parsed IS NOT NULL",
    "has_elements": "size(try_variant_get(parsed, '$.document.elements', 'array<variant>')) > 0",
}
ENRICHED_RULES = {"has_summary": "summary IS NOT NULL", "has_category": "category IS NOT NULL"}


def _holds(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def _all_hold(rules: Rules) -> Column:
    out = F.lit(True)
    for condition in rules.values():
        out = out & _holds(condition)
    return out


def failed_rules(rules: Rules) -> Column:
    """Names of the rules a row breaks. A condition that is NULL counts as broken."""
    names = [F.when(~_holds(c), F.lit(name)) for name, c in rules.items()]
    return F.filter(F.array(*names), lambda n: n.isNotNull())


def expect(df: DataFrame, rules: Rules, name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Keep all rows and count violations while the rows pass by; read them from the observation after an action."""
    seen = Observation(name)
    counts = [F.count_if(~_holds(c)).alias(rule) for rule, c in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("total"), *counts), seen


def expect_or_drop(df: DataFrame, rules: Rules, counts: Observation | None = None) -> DataFrame:
    """Rows that meet every rule. ``counts`` sees all rows on their way: ``total``, ``dropped`` and failures by rule."""
    if counts is not None:
        failures = [F.count_if(~_holds(c)).alias(rule) for rule, c in rules.items()]
        df = df.observe(counts, F.count(F.lit(1)).alias("total"), F.count_if(~_all_hold(rules)).alias("dropped"), *failures)
    return df.filter(_all_hold(rules))


def drop_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """``rule, total, failed, dropped`` of ``expect_or_drop``, in one pass over the rows before the drop."""
    failures = [F.count_if(~_holds(c)).alias(f"_{i}") for i, c in enumerate(rules.values())]
    sums = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(~_all_hold(rules)).alias("dropped"), *failures)
    rows = [F.struct(F.lit(r).alias("rule"), "total", F.col(f"_{i}").alias("failed"), "dropped") for i, r in enumerate(rules)]
    return sums.select(F.inline(F.array(*rows)))


def expect_or_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """Stop the job on the first row that breaks a rule. Works in batch and in streams."""
    broken = F.array_join(failed_rules(rules), ", ")
    stop = F.raise_error(F.concat(F.lit("expectation failed: "), broken)).cast("boolean")
    return df.filter(F.when(_all_hold(rules), True).otherwise(stop))


def quarantine(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(rows that meet every rule, other rows with ``failed_rules``)."""
    marked = df.withColumn("failed_rules", failed_rules(rules))
    return marked.filter(F.size("failed_rules") == 0).drop("failed_rules"), marked.filter(F.size("failed_rules") > 0)


def expectation_metrics(df: DataFrame, rules: Rules, by: list[str] | None = None) -> DataFrame:
    """``rule, total, passed, failed, pass_rate`` (and ``by``) for all rules in one pass."""
    by = by or []
    sums = df.groupBy(*by).agg(
        F.count("*").alias("total"), *[F.count_if(_holds(c)).alias(f"_{i}") for i, c in enumerate(rules.values())]
    )
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"_{i}").alias("passed")) for i, r in enumerate(rules)])
    return sums.select(*by, "total", F.explode(rows).alias("_m")).select(
        *by,
        "_m.rule",
        "total",
        "_m.passed",
        (F.col("total") - F.col("_m.passed")).alias("failed"),
        F.round(F.try_divide(F.col("_m.passed"), F.col("total")), 6).alias("pass_rate"),
    )


def stage_metrics(df: DataFrame, stages: list[tuple[str, str, str]], size: str) -> DataFrame:
    """Rows and characters that reach each stage, counted in one pass.

    A stage is (name, condition on its input, condition on its output); ``size`` is the expression that is summed.
    """
    aggs = []
    for i, (_, before, after) in enumerate(stages):
        aggs += [
            F.count_if(_holds(before)).alias(f"_i{i}"),
            F.count_if(_holds(after)).alias(f"_o{i}"),
            F.coalesce(F.sum(F.when(_holds(after), F.expr(size))), F.lit(0)).alias(f"_c{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("stage"),
                F.col(f"_i{i}").alias("rows_in"),
                F.col(f"_o{i}").alias("rows_out"),
                F.col(f"_c{i}").alias("chars_out"),
            )
            for i, (name, _, _) in enumerate(stages)
        ]
    )
    return df.agg(*aggs).select(F.explode(rows).alias("_m")).select("_m.*")


def quality_trend(daily: DataFrame, day: str = "day", rate: str = "pass_rate", span: int = 7) -> DataFrame:
    """Rate of each rule with the previous run's rate and a moving mean. Input has one row per rule and run."""
    order = W.partitionBy("rule").orderBy(day)
    return daily.select(
        "*",
        F.lag(rate).over(order).alias("previous_rate"),
        F.round(F.avg(rate).over(order.rowsBetween(1 - span, 0)), 6).alias("mean_rate"),
    )


def quality_alerts(metrics: DataFrame, threshold: float, rate: str = "pass_rate") -> DataFrame:
    return metrics.filter(F.col(rate) < threshold)


def recent(df: DataFrame, ts: str, tie: str, n: int = 20) -> DataFrame:
    """The newest ``n`` rows of a log."""
    return df.orderBy(F.desc(ts), F.desc(tie)).limit(n)
