"""Incremental refresh of aggregates, and the choice between incremental and full.

``refresh_touched_groups`` recomputes only the rollup groups a change batch can
have moved: a changed claim touches the group it was in *and* the group it is
in now (its date, payer or provider may have changed). Untouched groups are
carried over from the previous rollup. Group keys may be NULL, so matching is
null-safe. The touched-group set follows the batch size; Spark sizes the
semi/anti joins against it at run time (AQE turns them into broadcast joins
only when the set is measured to be small).

``choose_refresh`` compares the change ratio with a threshold: below it the
incremental path is cheaper (cost follows the changes), above it a full
rebuild wins (one scan instead of many keyed lookups).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import gold

DEFAULT_FULL_REFRESH_RATIO = 0.20


def touched_groups(changed_keys: DataFrame, key: str, before: DataFrame, after: DataFrame, group_keys: Sequence[str]) -> DataFrame:
    """Distinct group keys of changed entities, before and after the change."""
    gk = list(group_keys)
    old = before.join(changed_keys, key, "left_semi").select(*gk)
    new = after.join(changed_keys, key, "left_semi").select(*gk)
    return old.unionByName(new).distinct()


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"{prefix}{k}"])
    return cond


def refresh_touched_groups(
    previous: DataFrame,
    touched: DataFrame,
    rows_after: DataFrame,
    group_keys: Sequence[str],
    aggregate: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``previous`` rollup with the ``touched`` groups recomputed from ``rows_after``.

    ``rows_after`` are the rollup's input rows as of now (any superset of the
    touched groups' rows); group keys match null-safely.
    """
    gk = list(group_keys)
    t = touched.select(*[F.col(k).alias(f"__t_{k}") for k in gk])
    keep = previous.join(t, _null_safe(previous, t, gk, "__t_"), "left_anti")
    rows = rows_after.join(t, _null_safe(rows_after, t, gk, "__t_"), "left_semi")
    return keep.unionByName(aggregate(rows).select(*previous.columns))


def refresh_daily(
    previous: DataFrame,
    header_before: DataFrame,
    header_after: DataFrame,
    detail_after: DataFrame,
    changed_claims: DataFrame,
) -> DataFrame:
    """Daily KPIs refreshed for the groups touched by ``changed_claims`` only.

    The header fact is rebuilt only for claims in touched groups (lines are cut
    to those claims before the aggregate), then rolled up.
    """
    keys = gold.DAILY_KEYS

    def group_cols(h: DataFrame) -> DataFrame:
        return h.select("claim_id", F.col("service_from_date").alias("service_date_key"), "payer_id", "provider_id")

    touched = touched_groups(changed_claims, "claim_id", group_cols(header_before), group_cols(header_after), keys)
    t = touched.select(*[F.col(k).alias(f"__t_{k}") for k in keys])
    after = group_cols(header_after)
    claims = after.join(t, _null_safe(after, t, keys, "__t_"), "left_semi").select("claim_id")
    fact = gold.fact_claim(
        header_after.join(claims, "claim_id", "left_semi"), detail_after.join(claims, "claim_id", "left_semi")
    )
    return refresh_touched_groups(previous, touched, fact, keys, gold.daily_kpis)


def change_ratio(changes: DataFrame, base: DataFrame) -> DataFrame:
    """One row: changed_rows, base_rows, change_ratio_bp, from a single aggregate (no join)."""
    both = changes.select(F.lit(1).alias("c"), F.lit(0).alias("b")).unionByName(base.select(F.lit(0).alias("c"), F.lit(1).alias("b")))
    agg = both.agg(F.sum("c").cast("bigint").alias("changed_rows"), F.sum("b").cast("bigint").alias("base_rows"))
    return agg.withColumn(
        "change_ratio_bp", F.when(F.col("base_rows") > 0, F.expr("(changed_rows * 10000) div base_rows"))
    )


def choose_refresh(ratio: DataFrame, threshold: float = DEFAULT_FULL_REFRESH_RATIO) -> DataFrame:
    """Add ``strategy``: ``full`` when the change ratio reaches ``threshold``, else ``incremental``.

    An empty base (first load) is always a full build.
    """
    bp = int(round(threshold * 10000))
    strategy = F.when(F.col("change_ratio_bp").isNull() | (F.col("change_ratio_bp") >= bp), F.lit("full")).otherwise(
        F.lit("incremental")
    )
    return ratio.withColumn("strategy", strategy)


def decide(changed_rows: int, base_rows: int, threshold: float = DEFAULT_FULL_REFRESH_RATIO) -> str:
    """Driver-side form of ``choose_refresh`` for a runner holding the two counts."""
    if base_rows <= 0:
        return "full"
    return "full" if changed_rows / base_rows >= threshold else "incremental"
