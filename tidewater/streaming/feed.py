"""Change feed of a stored table between two versions, with before and after images.

The batches committed between the versions name the keys that may have changed.
Only those keys are looked up, as of either version, through the same keyed
reads as everywhere else; neither version is read whole, and no table is joined
with another of its size. Versions are those of the table's manifest and can be
read until they expire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc
from ..plans.reconcile import changed_names
from ..sources import buckets, files
from . import apply as ap


def current_version(spark: SparkSession, root: str, name: str) -> int | None:
    table = ap.contents(spark, root, name)
    return None if table is None else table["version"]


def last_batch(table: dict | None) -> int:
    """The newest batch that a table's content holds (-1: none)."""
    if table is None:
        return -1
    ids = [b["id"] for b in table["batches"]] + ([table["upto"]] if table["upto"] is not None else [])
    return max(ids, default=-1)


def batches_between(spark: SparkSession, root: str, name: str, since: int | None, until: int) -> list[int]:
    """Ids of the batches that version ``until`` has and ``since`` (None: before the first) has not; from one listing."""
    first = last_batch(None if since is None else ap.contents(spark, root, name, since))
    last = last_batch(ap.contents(spark, root, name, until))
    return [b for b in files.numbered(spark, ap.state_path(root, name), "batch_id=") if first < b <= last]


def touched_share(spark: SparkSession, root: str, name: str, since: int | None, until: int) -> float:
    """How much of a version's rows came in batches after another one, as counted when they were written; 0 if they are folded already."""
    first, table = last_batch(None if since is None else ap.contents(spark, root, name, since)), ap.contents(spark, root, name, until)
    all_rows = ap.snapshot_rows(table) + ap.changed_rows(table)
    return sum(b["rows"] for b in table["batches"] if b["id"] > first) / all_rows if all_rows else 0.0


def touched_keys(spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, since: int | None, until: int) -> DataFrame | None:
    """The keys in the batches between two versions (None: no batch)."""
    ids = batches_between(spark, root, name, since, until)
    if not ids:
        return None
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*[f"{ap.state_path(root, name)}/batch_id={b}" for b in ids])
    return rows.select(*apply.keys) if len(ids) == 1 else rows.select(*apply.keys).distinct()  # a batch has a row a key


def change_feed(
    spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, since: int | None, until: int | None = None, columns: Sequence[str] | None = None
) -> DataFrame | None:
    """``(keys..., oper, before, after)`` for every key whose live row differs between two versions.

    ``oper`` is I, U or D; the images are structs of the other columns (or of
    ``columns``), null where there is no row. ``since`` None means before the first
    batch. None if no batch lies between the versions.
    """
    until = current_version(spark, root, name) if until is None else until
    keys = None if until is None else touched_keys(spark, root, name, apply, since, until)
    if keys is None:
        return None
    after = ap.current_state_for(spark, root, name, apply, keys, until, keyed=True)
    before = after.where(F.lit(False)) if since is None else ap.current_state_for(spark, root, name, apply, keys, since, keyed=True)
    cols = [c for c in (columns or after.columns) if c not in (*apply.keys, buckets.KEY)]
    return between(before, after, list(apply.keys), cols)


def between(before: DataFrame, after: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """The images of two sets of rows with the same keys side by side, where they differ; rows stored by ``__k`` are joined where they lie."""
    both = buckets.KEY

    def key(rows: DataFrame):
        return F.col(both) if both in rows.columns else buckets.key_text(rows, keys).alias(both)

    old = before.select(key(before), F.struct(*keys).alias("__old"), F.struct(*cols).alias("before"))
    new = after.select(key(after), F.struct(*keys).alias("__new"), F.struct(*cols).alias("after"))
    rows = old.join(new, both, "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))
    oper = F.when(F.col("__old").isNull(), "I").when(F.col("__new").isNull(), "D").otherwise("U")
    key = F.coalesce("__old", "__new")
    return rows.select(*[key[k].alias(k) for k in keys], oper.alias("oper"), "before", "after")


def with_changed_columns(feed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feed`` without its images but with the names of the changed columns, as ``reconcile.snapshot_diff`` gives them."""
    names = F.when(F.col("oper") == "U", changed_names(columns, "before", "after")).otherwise(F.lit(""))
    keys = [c for c in feed.columns if c not in ("oper", "before", "after")]
    return feed.select(*keys, "oper", names.alias("changed_columns"))
