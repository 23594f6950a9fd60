"""Batch layers: change logs -> current state (rules applied) -> gold datasets.

The same functions serve a full rebuild (replay of a whole change log) and the
runner's materialised tables; the streaming path (``tidewater.streaming``)
writes the same reduced rows incrementally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import cdc, quality
from ..specs import CLAIMS, TableSpec
from . import gold, roles


def silver(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop rules, then SCD1 change apply keyed by the registry."""
    kept = quality.check(changes, spec.rules, spec.delete_predicate).kept
    return cdc.apply_changes(kept, cdc.ApplySpec.for_table(spec))


def silver_from_roles(spark: SparkSession, sf_dir: str, table: str, rm: roles.RoleMap | None = None, runs=(roles.SEED, roles.INCREMENT)) -> DataFrame:
    return silver(roles.change_log(spark, sf_dir, table, runs, rm), CLAIMS[table])


def gold_datasets(spark: SparkSession, current: dict[str, DataFrame], calendar=None) -> dict[str, DataFrame]:
    """All full-refresh gold datasets from current-state tables (lazy plans).

    ``calendar`` is ``(start, end)``; by default whole years of the claims'
    service dates.
    """
    header, detail = current["claim"], current["claim_detail"]
    fact = gold.fact_claim(header, detail)
    return {
        "dim_provider": gold.dim_provider(current["provider"]),
        "dim_member": gold.dim_member(current["member"]),
        "dim_payer": gold.dim_payer(current["payer"]),
        "dim_procedure": gold.dim_procedure(detail),
        "dim_diagnosis": gold.dim_diagnosis(current["claim_diagnosis"]),
        "dim_date": gold.dim_date(spark, *calendar) if calendar else gold.dim_date_of(header),
        "fact_claim_line": gold.fact_claim_line(detail, header),
        "fact_claim": fact,
        "agg_claims_daily": gold.daily_kpis(fact),
    }
