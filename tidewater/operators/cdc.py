"""Keyed change application: change log -> current state (SCD1), tombstones, history (SCD2).

One reduction underlies everything: for each key keep the change with the
greatest ordering, where the ordering is

    (sequence columns..., tie-break columns..., then every remaining column)

``max(struct(order, payload))`` compares field by field, so the winner is a
total, deterministic function of the set of changes: arrival order, batch
split, retries and exact duplicates cannot change it. That makes the reduction
associative, commutative and idempotent, so it is applied per micro-batch, again
on read, and again on compaction with the same result.

Physically it is a partial + final aggregate on the key: a key holding a third
of all changes is folded to one row per map task before the shuffle, so hot
keys do not land whole in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col_of, oper_rank
from ..sources.buckets import KEY, SLOT, key_text
from ..specs import CHANGE_COLUMNS, DELETE_PREDICATE, INGEST_COLUMNS, OPER_COL, SEQ_COL, TS_COL, TableSpec

_WIN = "__win"
DELETED_COL = "__is_delete"


@dataclass(frozen=True)
class ApplySpec:
    """How to resolve one change log.

    keys           key columns (composite keys allowed)
    sequence_by    columns ordering changes per key, most significant first
    tie_break      further ordering columns used when the sequence ties;
                   after these every remaining column decides, so ties are total
    delete_when    SQL predicate marking a change as a delete (None: no deletes)
    except_columns columns removed from the resolved table (change metadata)
    slot_by        key columns by which the stored table is laid out in slots (default: all);
                   rows that share them can be looked up together
    """

    keys: tuple[str, ...]
    sequence_by: tuple[str | Column, ...]
    tie_break: tuple[str | Column, ...] = ()
    delete_when: str | None = DELETE_PREDICATE
    except_columns: tuple[str, ...] = field(default_factory=tuple)
    slot_by: tuple[str, ...] = ()

    @property
    def slot_keys(self) -> tuple[str, ...]:
        return self.slot_by or self.keys

    @staticmethod
    def for_table(spec: TableSpec) -> "ApplySpec":
        """Registry tables: order by seq, then change timestamp, then D over U over I."""
        return ApplySpec(
            keys=tuple(spec.keys),
            sequence_by=tuple(spec.sequence_by),
            tie_break=(TS_COL, oper_rank(OPER_COL).alias("__oper_rank")),
            delete_when=spec.delete_predicate,
            except_columns=tuple(c for c, _ in CHANGE_COLUMNS) + tuple(INGEST_COLUMNS),
        )


def _ranked(columns: Sequence[str], order: Sequence[str | Column]) -> Column:
    """A struct that compares as changes do: the order columns, then the rest of ``columns``; a column is in it once."""
    fields, named = [], []
    for i, c in enumerate(order):
        if isinstance(c, str) and c in columns:
            if c not in named:
                named.append(c)
                fields.append(F.col(c))
        else:
            fields.append(col_of(c).alias(f"__o{i}"))
    return F.struct(*fields, *[F.col(c) for c in columns if c not in named])


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], derived: Sequence[str] = ()) -> DataFrame:
    """The greatest change per key by ``order``, ties broken by the remaining columns.

    Returns ``df``'s columns, one row per distinct key; without the ``derived`` ones,
    which the key determines and which then need not be carried along.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys and c not in derived]
    if not payload:
        return df.select(*keys).distinct()
    reduced = df.groupBy(*keys).agg(F.max(_ranked(payload, order)).alias(_WIN))
    return reduced.select(*keys, *[F.col(f"{_WIN}.{c}").alias(c) for c in payload]).select(*[c for c in df.columns if c not in derived])


def null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    """Join condition on key columns in which a NULL part equals a NULL part, as it does in a grouping."""
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def merge_reduced(base: DataFrame, delta: DataFrame, spec: "ApplySpec", small: bool = False) -> DataFrame:
    """``reduce_changes(base union delta)`` where each side already has one row per key.

    One full outer join on the key text reads each side once and keeps the greater
    row. A base stored in buckets of that text joins in place, without an Exchange.
    ``small`` says that the delta's share of a bucket is known to fit in a task's
    memory: it is then hashed and the base streams past it, unsorted. ``base`` may
    have the storage columns; they stay. A delta that has the key text lies by it already.
    """
    keys = list(spec.keys)
    payload = [c for c in base.columns if c not in (*keys, KEY, SLOT)]
    missing = [c for c in payload if c not in delta.columns]
    delta = delta.withColumns({c: F.lit(None).cast(base.schema[c].dataType) for c in missing}) if missing else delta
    ranked = _ranked(payload, _with_order(spec)) if payload else F.lit(0)
    left = base if KEY in base.columns else base.withColumn(KEY, key_text(base, keys))
    left = left.select(KEY, F.struct(*keys).alias("__old_key"), ranked.alias(_WIN))
    right = delta.select(F.col(KEY) if KEY in delta.columns else key_text(delta, keys).alias(KEY), F.struct(*keys).alias("__new_key"), ranked.alias("__change"))
    # a missing side is null and never the greater one
    joined = left.join(right.hint("shuffle_hash") if small else right, KEY, "full_outer")
    won = joined.select(KEY, F.coalesce("__old_key", "__new_key").alias("__key"), F.greatest(_WIN, "__change").alias(_WIN))
    found = {c: F.col(f"__key.{c}") for c in keys} | {c: F.col(f"{_WIN}.{c}") for c in payload}
    return won.select(*[found.get(c, F.col(c)).alias(c) for c in base.columns if c != SLOT])


def _with_order(spec: ApplySpec) -> list[str | Column]:
    return list(spec.sequence_by) + list(spec.tie_break)


def reduce_changes(changes: DataFrame, spec: ApplySpec, derived: Sequence[str] = ()) -> DataFrame:
    """Per-key winner *including* deletes (tombstones), change columns kept.

    This is what a micro-batch writes to the state folder and what compaction
    keeps: dropping a tombstone early would let a late, lower-sequenced update
    resurrect the key. When and from which file a change was ingested is left to
    the bronze log where the resolved table does not have it either: these columns
    come last in the order, so they never decide between rows that differ elsewhere.
    """
    unseen = [c for c in INGEST_COLUMNS if c in changes.columns and c in spec.except_columns]
    return latest_by_key(changes.drop(*unseen), spec.keys, _with_order(spec), derived)


def mark_deletes(df: DataFrame, spec: ApplySpec) -> DataFrame:
    if spec.delete_when is None:
        return df.withColumn(DELETED_COL, F.lit(False))
    return df.withColumn(DELETED_COL, F.coalesce(F.expr(spec.delete_when), F.lit(False)))


def live_rows(reduced: DataFrame, spec: ApplySpec) -> DataFrame:
    """Drop tombstones and change metadata from a reduced log: the SCD1 table."""
    out = mark_deletes(reduced, spec).where(~F.col(DELETED_COL)).drop(DELETED_COL)
    return out.drop(*[c for c in spec.except_columns if c in out.columns])


def apply_changes(changes: DataFrame, spec: ApplySpec) -> DataFrame:
    """Batch SCD1: resolve a whole change log to current state."""
    return live_rows(reduce_changes(changes, spec), spec)


def tombstones(changes: DataFrame, spec: ApplySpec, order_alias: Sequence[str] = ()) -> DataFrame:
    """Keys whose latest change is a delete, with that delete's ordering columns."""
    reduced = mark_deletes(reduce_changes(changes, spec), spec)
    cols = list(spec.keys) + [c for c in order_alias if c not in spec.keys]
    return reduced.where(F.col(DELETED_COL)).select(*cols)


# ---------------------------------------------------------------------------
# SCD2 history
# ---------------------------------------------------------------------------
START_COL = "__start_at"
END_COL = "__end_at"


def scd2_base(changes: DataFrame, spec: ApplySpec, start_value: str | Column | None = None) -> tuple[DataFrame, list]:
    """A log's rows with the value each opens a version at, and the total order of a key's changes.

    A change delivered twice counts once: when and from which file it was ingested
    is not part of it.
    """
    start = col_of(start_value if start_value is not None else spec.sequence_by[0])
    base = changes.drop(*[c for c in INGEST_COLUMNS if c in changes.columns]).withColumn(START_COL, start)
    return base, _with_order(spec) + [F.struct(*[F.col(c) for c in base.columns if c not in spec.keys])]


def scd2_versions(closed: DataFrame, spec: ApplySpec) -> DataFrame:
    """Versions (no deletes, no change metadata) of rows that carry both interval ends."""
    versions = mark_deletes(closed, spec).where(~F.col(DELETED_COL)).drop(DELETED_COL)
    return versions.drop(*[c for c in spec.except_columns if c in versions.columns])


def scd2_history(changes: DataFrame, spec: ApplySpec, start_value: str | Column | None = None) -> DataFrame:
    """Type-2 history: one version per applied change, closed by the next change.

    A version opens at its change's sequence value (``start_value``, default
    the first ``sequence_by`` column) and ends where the next change of the key
    starts (NULL while current). A delete closes the open version and opens
    none. Late changes simply land in order, since intervals are recomputed from
    the whole ordered log of the key; ``streaming.history`` keeps a stored history
    up to date instead.

    "Next change of the key" is computed skew-safely by ``ordered.next_in_key``:
    a key holding a third of all changes is spread over many range partitions.
    """
    from .ordered import next_in_key

    base, total = scd2_base(changes, spec, start_value)
    return scd2_versions(next_in_key(base, spec.keys, total, START_COL, END_COL, distinct=True), spec)
