"""Self-maintained rollups: stored totals that signed rows move.

A rollup keeps, for each group, how many rows it has and sums over them; averages
and rates are derived from those when it is read. Rows that come add to their
group's totals, rows that go are taken off them, and a group without rows is gone.
So a refresh reads the changed rows and the totals of their groups, and writes
those totals; neither the rollup's input nor its other groups are read.

The totals are a stored keyed table like any other (``streaming.apply``): a refresh
is a batch of it, merged on read and folded into its buckets by compaction. NULL
group keys are groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc
from ..sources import buckets
from ..sources.buckets import KEY, Layout
from . import apply as ap

ROWS = "__rows"  # rows of the group
AS_OF = "__as_of"  # the refresh that last moved the group


@dataclass(frozen=True)
class Rollup:
    """``totals``: (column, SQL of what one input row adds to it, type of the total). A NULL adds nothing."""

    name: str
    keys: tuple[str, ...]
    totals: tuple[tuple[str, str, str], ...]

    @property
    def spec(self) -> cdc.ApplySpec:
        return cdc.ApplySpec(keys=self.keys, sequence_by=(AS_OF,), delete_when=f"{ROWS} = 0", except_columns=(AS_OF,))


def signed_sums(rollup: Rollup, added: DataFrame | None, removed: DataFrame | None) -> DataFrame:
    """By how much each group's totals move; groups that don't are left out. Summed in each task before the shuffle."""
    rows = None
    for part, sign in ((added, 1), (removed, -1)):
        if part is None:
            continue
        values = [(F.coalesce(F.expr(sql), F.lit(0)) * F.lit(sign)).cast(kind).alias(c) for c, sql, kind in rollup.totals]
        part = part.select(*rollup.keys, *values, F.lit(sign).cast("bigint").alias(ROWS))
        rows = part if rows is None else rows.unionByName(part)
    sums = rows.groupBy(*rollup.keys).agg(*[F.sum(c).cast(kind).alias(c) for c, _, kind in rollup.totals], F.sum(ROWS).alias(ROWS))
    moved = F.col(ROWS) != 0
    for c, _, _ in rollup.totals:
        moved = moved | (F.col(c) != 0)
    return sums.where(moved)


def rebuild(spark: SparkSession, root: str, rollup: Rollup, batch_id: int, rows: DataFrame, layout: Layout | None = None) -> None:
    """All totals anew from the whole input."""
    totals = signed_sums(rollup, rows, None).withColumn(AS_OF, F.lit(int(batch_id)).cast("bigint"))
    ap.replace(spark, root, rollup.name, totals, rollup.spec, batch_id, layout)


def move(spark: SparkSession, root: str, rollup: Rollup, batch_id: int, added: DataFrame | None, removed: DataFrame | None) -> None:
    """Move the totals by rows that came and rows that went; nothing if the batch is in the table already."""
    if ap.is_done(ap.contents(spark, root, rollup.name), batch_id):
        return
    keys = list(rollup.keys)
    delta = signed_sums(rollup, added, removed)
    delta = delta.withColumn(KEY, buckets.key_text(delta, keys))
    known = ap.reduced_state_for(spark, root, rollup.name, rollup.spec, delta)
    columns = [c for c, _, _ in rollup.totals] + [ROWS]
    kinds = {c: kind for c, _, kind in rollup.totals} | {ROWS: "bigint"}
    if known is not None:
        old = known.select(buckets.key_text(known, keys).alias("__old"), *[F.col(c).alias(f"__old_{c}") for c in columns])
        delta = delta.join(old, F.col(KEY) == F.col("__old"), "left")
        now = [(F.col(c) + F.coalesce(f"__old_{c}", F.lit(0))).cast(kinds[c]).alias(c) for c in columns]
    else:
        now = [F.col(c) for c in columns]
    rows = delta.select(*keys, *now, F.lit(int(batch_id)).cast("bigint").alias(AS_OF))
    ap.append_reduced(spark, root, rollup.name, batch_id, rows, rollup.spec)


def totals(spark: SparkSession, root: str, rollup: Rollup, version: int | None = None) -> DataFrame:
    """The rollup's groups with their totals and ``__rows``."""
    return ap.current_state(spark, root, rollup.name, rollup.spec, version)


def totals_for(spark: SparkSession, root: str, rollup: Rollup, keys: DataFrame) -> DataFrame | None:
    return ap.current_state_for(spark, root, rollup.name, rollup.spec, keys)
