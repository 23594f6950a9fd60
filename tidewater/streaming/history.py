"""Stored type-2 history, kept up to date by interval.

A history is a stored keyed table of versions: every distinct change of a key with
where it starts and where it ends. A batch reads the stored versions of the keys it
touches, and writes only what it alters: its own changes, with their ends, and the
versions whose end it moves. A late change splits the interval it falls into, a
duplicate alters nothing. How much is written follows the batch, also for a key
with very many versions.

Versions are keyed by (key, identity of the change) and laid out in slots by the
key, so a batch's keys are looked up in their slots, and a key with a third of
all versions is still spread over all buckets of its slot. "Next change of the
key" is ``ordered.next_in_key``, which splits such a key over range partitions.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc, quality
from ..operators.ordered import next_in_key
from ..sources.buckets import Layout
from ..specs import TableSpec
from . import apply as ap
from .ingest import checkpoint_path, read_bronze_stream

VERSION = "__version"  # identity of a change within its key
AS_OF = "__as_of"  # the batch that last altered the version


def history_name(table: str) -> str:
    return f"{table}__history"


def _stored(apply: cdc.ApplySpec) -> cdc.ApplySpec:
    """How stored versions are keyed: the newest batch's row of a version holds."""
    return cdc.ApplySpec(keys=(*apply.keys, VERSION), sequence_by=(AS_OF,), delete_when=None, slot_by=tuple(apply.keys))


def _identity(columns: list[str]):
    """128 bits of a change's typed values; not their texts, which depend on the session's time zone."""
    values = [F.col(c) for c in columns]
    return F.concat(F.hex(F.xxhash64(*values)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *values)))


def update_history(
    batch: DataFrame, batch_id: int, root: str, name: str, apply: cdc.ApplySpec, rules=(), delete_when: str | None = None, layout: Layout = Layout()
) -> None:
    """Bring the stored history up to date with a batch of changes; nothing if the batch is in it already."""
    spark, kept_in = batch.sparkSession, history_name(name)
    if ap.is_done(ap.contents(spark, root, kept_in), batch_id):
        return
    kept = quality.check(batch, rules, delete_when).kept if rules else batch
    base, order = cdc.scd2_base(kept, apply)
    keys, spec = list(apply.keys), _stored(apply)
    columns = list(base.columns)
    fresh = base.withColumn(VERSION, _identity(columns)).withColumns({cdc.END_COL: F.lit(None).cast(base.schema[cdc.START_COL].dataType), "__known": F.lit(0)})
    known = ap.reduced_state_for(spark, root, kept_in, spec, base.select(*keys))
    rows = fresh
    if known is not None:
        rows = rows.unionByName(known.drop(AS_OF).withColumn("__known", F.lit(1)))
    # of a change that comes again, the stored row stays; that also folds duplicates in the batch
    payload = [c for c in rows.columns if c not in (*keys, VERSION)]
    one = rows.groupBy(*keys, VERSION).agg(F.max(F.struct("__known", *[c for c in payload if c != "__known"])).alias("r"))
    one = one.select(*keys, VERSION, *[F.col(f"r.{c}").alias(c) for c in payload])
    moved = next_in_key(one, keys, order, cdc.START_COL, "__end")
    altered = moved.where((F.col("__known") == 0) | ~F.col("__end").eqNullSafe(F.col(cdc.END_COL)))
    altered = altered.select(*columns, VERSION, F.col("__end").alias(cdc.END_COL), F.lit(int(batch_id)).cast("long").alias(AS_OF))
    ap.append_reduced(spark, root, kept_in, batch_id, altered, spec, layout)


def has_history(spark: SparkSession, root: str, name: str) -> bool:
    return ap.contents(spark, root, history_name(name)) is not None


def read_history(spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, version: int | None = None) -> DataFrame:
    """The stored history: as ``cdc.scd2_history`` of all batches so far."""
    rows = ap.reduced_state(spark, root, history_name(name), _stored(apply), version)
    return cdc.scd2_versions(rows.drop(VERSION, AS_OF), apply)


def history_as_of(history: DataFrame, at) -> DataFrame:
    """The rows of a history that were current at a start value: intervals are closed at their start, open at their end."""
    at = F.lit(at)
    return history.where((F.col(cdc.START_COL) <= at) & (F.col(cdc.END_COL).isNull() | (at < F.col(cdc.END_COL))))


def compact_history(spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, layout: Layout | None = None) -> str | None:
    return ap.compact(spark, root, history_name(name), _stored(apply), layout=layout)


def start_history(spark: SparkSession, root: str, spec: TableSpec, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """History flow of one registry table: bronze stream -> altered versions a batch."""
    apply = cdc.ApplySpec.for_table(spec)

    def run(batch: DataFrame, batch_id: int) -> None:
        update_history(batch, batch_id, root, spec.name, apply, spec.drop_rules(), spec.delete_predicate, spec.layout)

    return (
        read_bronze_stream(spark, root, spec, max_files_per_trigger)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint_path(root, f"history_{spec.name}"))
        .queryName(f"history_{spec.name}_{abs(hash(root)) % 10**8}")
        .trigger(availableNow=True)
        .start()
    )
