"""Row-quality rules: ``warn`` counts failures, ``drop`` removes and keeps rows aside.

A rule fails when its predicate is false *or NULL*. Key-only delete rows carry
NULL payload by construction, so ``warn`` rules skip them by default, while key
rules (``applies_to_deletes``) check every row. All counting is one aggregate
over the batch (partial + final, one output row), never a per-rule scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import DELETE_PREDICATE, Rule

REJECT_RULES_COL = "_failed_rules"


def _is_delete(delete_when: str | None) -> Column:
    if not delete_when:
        return F.lit(False)
    return F.coalesce(F.expr(delete_when), F.lit(False))


def failed(rule: Rule, delete_when: str | None = DELETE_PREDICATE) -> Column:
    """True when ``rule`` fails on the row (NULL counts as failure)."""
    bad = ~F.coalesce(F.expr(rule.predicate), F.lit(False))
    if not rule.applies_to_deletes:
        bad = bad & ~_is_delete(delete_when)
    return bad


@dataclass
class QualityResult:
    kept: DataFrame  # rows passing every drop rule (warn failures kept)
    rejects: DataFrame  # rows failing a drop rule, with the names of the failed rules
    metrics: DataFrame  # one row per rule: rule, action, failed_rows


def check(df: DataFrame, rules: Sequence[Rule], delete_when: str | None = DELETE_PREDICATE) -> QualityResult:
    rules = list(rules)
    drops = [r for r in rules if r.action == "drop"]
    if drops:
        names = F.array_compact(F.array(*[F.when(failed(r, delete_when), F.lit(r.name)) for r in drops]))
        any_drop = F.lit(False)
        for r in drops:
            any_drop = any_drop | failed(r, delete_when)
        kept = df.where(~any_drop)
        rejects = df.where(any_drop).withColumn(REJECT_RULES_COL, names)
    else:
        kept = df
        rejects = df.where(F.lit(False)).withColumn(REJECT_RULES_COL, F.array().cast("array<string>"))
    return QualityResult(kept, rejects, rule_metrics(df, rules, delete_when))


def rule_metrics(df: DataFrame, rules: Sequence[Rule], delete_when: str | None = DELETE_PREDICATE) -> DataFrame:
    """``(rule, action, failed_rows)`` for every rule, from one aggregate."""
    rules = list(rules)
    spark = df.sparkSession
    if not rules:
        return spark.createDataFrame([], "rule string, action string, failed_rows bigint")
    counts = df.agg(*[F.count_if(failed(r, delete_when)).alias(f"r{i}") for i, r in enumerate(rules)])
    entries = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"), F.col(f"r{i}").cast("bigint").alias("failed_rows"))
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(entries))
