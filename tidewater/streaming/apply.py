"""Streaming change apply (SCD1) with ``foreachBatch``, on plain parquet folders.

Per micro-batch: drop rules -> rejects and rule counts -> per-key reduction
(tombstones kept) -> ``state/<table>/batch_id=N``, committed by the next version
of the table's manifest. A batch in the manifest is not applied again, so the flow
is idempotent per ``batch_id``; no key state is held in memory between batches,
and write cost follows the batch. A large batch is stored in the buckets of its key, so
nothing shuffles it again, and reduced in passes that bound what it shuffles at once.

Readers resolve the state with the same reduction (``current_state``), which
never relies on batch order: late, duplicate and out-of-order changes give the
same table. ``compact`` folds the batches into a snapshot stored in buckets of
the key: slots that no batch touched are carried over by reference, the others
are merged bucket by bucket without a shuffle of what is stored. Reads merge the
batches after the snapshot the same way (``merge_on_read``).

The manifest holds each batch's and each slot's rows and bytes, so what a table
consists of and how much of it changed is one listing and one small file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace as replace_fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import cdc, quality
from ..sources import buckets, files
from ..sources.buckets import KEY, SLOT, Layout
from ..sources.manifest import Conflict, Manifest
from ..sources.tables import CODEC, ROW_GROUP
from ..specs import TableSpec
from .ingest import checkpoint_path, read_bronze_stream

# Merges hash the later batches when their share of a bucket is at most this; else both sides are sorted, which spills.
HASHED_BYTES_PER_BUCKET = 20 * 1024**2
# A batch that is read from at least this many bytes is stored in the buckets of its key, so that nothing shuffles it
# again; of a smaller one the files would be tiny. Stored rows take up to twice the bytes of the log that they come from.
BUCKETED_BYTES = 4 * 1024**2
STORED_BYTES = 2
# A batch read from more than this is reduced in passes over its buckets, each of about so much: what it shuffles lies on
# disk at once, some five times these bytes. A batch that is joined on its way reads the other side in each pass: fewer of them.
PASS_BYTES = 1024**3
JOINED_PASS_BYTES = 4 * PASS_BYTES
# Heavy hitters of watched columns: items a batch's sketch tracks, and items of it (and of a table) that are kept.
HOT_TRACKED, HOT_KEPT = 1000, 64
# A lookup of at most this many keys names them to the scan; more are given to it as a range.
LISTED_KEYS = 2000


def state_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/state/{table}"


def snapshots_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/snapshots/{table}"


def rejects_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/rejects/{table}"


def manifest_of(spark: SparkSession, root: str, table: str) -> Manifest:
    return Manifest(spark, f"{root.rstrip('/')}/manifest/{table}")


def _batch_dir(base: str, batch_id: int) -> str:
    return f"{base}/batch_id={batch_id}"


# ---------------------------------------------------------------------------
# what a table consists of
# ---------------------------------------------------------------------------
def empty_table(layout: Layout) -> dict:
    """A manifest's content before the first batch."""
    return {"layout": [layout.buckets, layout.slots], "upto": None, "slots": {}, "schema": None, "batches": [], "rules": {}, "marks": {}, "hot": {}}


def contents(spark: SparkSession, root: str, name: str, version: int | None = None) -> dict | None:
    """The manifest of a table, the newest or that of a version (None if it has no commit)."""
    m = manifest_of(spark, root, name)
    return m.latest() if version is None else m.at(version)


def layout_of(table: dict) -> Layout:
    return Layout(*table["layout"])


def is_done(table: dict | None, batch_id: int) -> bool:
    """Whether the table holds the batch, in its snapshot or as a later batch."""
    if table is None:
        return False
    return (table["upto"] is not None and batch_id <= table["upto"]) or any(b["id"] == batch_id for b in table["batches"])


def stored_bytes(table: dict) -> int:
    """Of the snapshot and the batches after it."""
    return sum(s["bytes"] for s in table["slots"].values()) + sum(b["bytes"] for b in table["batches"])


def snapshot_rows(table: dict) -> int:
    return sum(s["rows"] for s in table["slots"].values())


def changed_rows(table: dict) -> int:
    """Rows of the batches after the snapshot, as counted when they were written."""
    return sum(b["rows"] for b in table["batches"])


def commit(spark: SparkSession, root: str, name: str, change: Callable[[dict | None], dict | None]) -> dict | None:
    """Make ``change`` of the newest content the next version; asked again if another writer came first. None: nothing to do."""
    m = manifest_of(spark, root, name)
    while True:
        before = m.latest()
        after = change(before)
        if after is None:
            return before
        try:
            return m.commit(after, before)
        except Conflict:
            continue


def batch_ids(spark: SparkSession, root: str, name: str) -> list[int]:
    """Committed batches that are not folded into the snapshot, and before them the snapshot's last one if there is any."""
    table = contents(spark, root, name)
    if table is None:
        return []
    folded = [] if table["upto"] is None else [table["upto"]]
    return folded + [b["id"] for b in table["batches"]]


def latest_snapshot(spark: SparkSession, root: str, name: str) -> int | None:
    """Highest batch id folded into the snapshot, if any."""
    table = contents(spark, root, name)
    return None if table is None else table["upto"]


# ---------------------------------------------------------------------------
# writing batches
# ---------------------------------------------------------------------------
def known_bytes(rows: DataFrame) -> int:
    """The bytes of the files that rows are read from, as their plan knows them (0: unknown)."""
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 2**62 else 0


def batch_layout(table: dict | None, layout: Layout, read_bytes: int) -> Layout | None:
    """The buckets of a batch made from so many bytes: the table's, or for a first one as many as it needs. None: too small for any."""
    if read_bytes < BUCKETED_BYTES:
        return None
    return layout_of(table) if table is not None else buckets.grown(layout, STORED_BYTES * read_bytes)


@contextmanager
def _shuffles(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Plans made inside shuffle into so many partitions: an aggregate's then are the buckets that its rows are written to."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def reduced_by_text(rows: DataFrame, apply: cdc.ApplySpec) -> DataFrame:
    """``cdc.reduce_changes`` with ``__k``, by which its rows lie: its one shuffle is the last that a batch in buckets needs.

    A hot key is folded before it as ever. A key that is one text is not carried beside ``__k``.
    """
    keyed = rows if KEY in rows.columns else rows.withColumn(KEY, buckets.key_text(rows, apply.keys))
    derived = buckets.derived_key(rows, apply.keys)
    won = cdc.reduce_changes(keyed, replace_fields(apply, keys=(KEY,) if derived else (KEY, *apply.keys)), derived)
    columns = [c for c in keyed.columns if c in won.columns or c in derived]
    return buckets.with_key(won, derived[0]).select(*columns) if derived else won


def _slot(rows: DataFrame, apply: cdc.ApplySpec, slots: int) -> Column:
    return buckets.slot_of(buckets.key_text(rows, apply.slot_keys), slots)


def batch_hot(items: list, rows: int) -> dict:
    """A batch's heavy hitters as the manifest keeps them: counts by item, and how much any item may be off or missing.

    A count of the sketch is off by 3.5 / HOT_TRACKED of the rows at most; an item
    that is not listed has no more rows than the last one listed.
    """
    counts = {("" if i is None else str(i)): int(n) for i, n in items}
    full = len(counts) >= HOT_KEPT
    error = int(3.5 * rows / HOT_TRACKED) if full else 0  # a list that is not full holds every value, exactly
    return {"rows": rows, "items": counts, "error": error, "unlisted": min(counts.values()) + error if full else 0}


def merge_hot(old: dict | None, new: dict) -> dict:
    """The heavy hitters of two sets of rows together, with the same meaning of ``error`` and ``unlisted``."""
    if old is None:
        return new
    counts = {i: old["items"].get(i, 0) + new["items"].get(i, 0) for i in old["items"].keys() | new["items"].keys()}
    # an item that one side does not list may have as many rows there as that side's unlisted ones
    missing = max([0] + [(0 if i in old["items"] else old["unlisted"]) + (0 if i in new["items"] else new["unlisted"]) for i in counts])
    kept = sorted(counts, key=lambda i: (-counts[i], i))[:HOT_KEPT]
    cut = max([0] + [n for i, n in counts.items() if i not in kept])
    error = old["error"] + new["error"] + missing
    return {"rows": old["rows"] + new["rows"], "items": {i: counts[i] for i in kept}, "error": error, "unlisted": max(old["unlisted"] + new["unlisted"], cut + error if cut else 0)}


def append_reduced(
    spark: SparkSession,
    root: str,
    name: str,
    batch_id: int,
    reduced: DataFrame | Sequence[DataFrame],
    apply: cdc.ApplySpec,
    layout: Layout = Layout(),
    observed: Callable[[], tuple[dict, dict]] = lambda: ({}, {}),
    marks: dict | None = None,
    stored: Layout | None = None,
) -> dict:
    """Write a batch of reduced rows and commit it with its rows, bytes and touched slots.

    ``stored`` names the buckets that rows with ``__k`` lie in; the batch is then stored in them.
    It may come in several parts without a common key, which are written one after the other.
    The counts are observed while the rows are written. ``observed`` gives the batch's
    rule failures and heavy hitters once it is written; the manifest keeps both
    merged. ``marks`` are what the batch makes known of other tables, committed with it.
    """
    table = contents(spark, root, name)
    slots = layout.slots if table is None else layout_of(table).slots
    path = _batch_dir(state_path(root, name), batch_id)
    parts = [reduced] if isinstance(reduced, DataFrame) else list(reduced)
    if stored is not None:
        files.remove(spark, path)  # of a write that was not committed
    rows, touched, passes = 0, set(), []
    for i, part in enumerate(parts):
        seen = Observation(f"rows_{name}_{batch_id}_{uuid.uuid4().hex[:8]}")
        slot = _slot(part, apply, slots)
        counted = part.withColumn(SLOT, slot).observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set(SLOT).alias("slots"))  # at most ``slots`` values
        if stored is not None:
            with _shuffles(spark, stored.buckets):
                buckets.write_batch(counted.drop(SLOT), f"{path}/p{i}", stored)
        else:
            counted.drop(SLOT).write.mode("overwrite").option("compression", CODEC).options(**ROW_GROUP).parquet(path)
        got = seen.get
        if got.get("n"):
            passes.append(f"p{i}")
        rows += int(got.get("n") or 0)
        touched |= set(got.get("slots") or [])
    entry = {"id": int(batch_id), "rows": rows, "slots": sorted(touched)}
    if stored is not None and rows:
        entry |= {"buckets": stored.buckets, "passes": passes}
    elif stored is not None:  # no bucket has a file, which leaves readers without a schema
        spark.createDataFrame([], parts[0].schema).write.mode("overwrite").parquet(path)
    entry["bytes"] = files.total_bytes(spark, path)
    failures, hot = observed()

    def add(before: dict | None) -> dict | None:
        if is_done(before, batch_id):
            return None
        now = dict(before or empty_table(stored or layout))
        now["batches"] = now["batches"] + [entry]
        totals = dict(now["rules"])
        for rule, (action, n) in failures.items():
            totals[rule] = [action, totals.get(rule, [action, 0])[1] + n]
        merged = now["hot"] | {c: merge_hot(now["hot"].get(c), h) for c, h in hot.items()}
        return now | {"rules": totals, "marks": {**now["marks"], **(marks or {})}, "hot": merged}

    return commit(spark, root, name, add)


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    name: str,
    apply: cdc.ApplySpec,
    rules=(),
    delete_when: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    layout: Layout = Layout(),
    marks: dict | None = None,
    watch: Sequence[str] = (),
) -> dict[str, int]:
    """Process one micro-batch of changes into ``state/<name>/batch_id=N``; nothing if it is committed already.

    Rule counts, and the heavy hitters of the columns to ``watch``, are observed while the state is written (``observe``: no extra
    pass over the batch); rejects are written only when a drop rule removed
    rows, before the batch is committed. Returns the failure count per rule.
    """
    spark = batch.sparkSession
    rules = list(rules)
    table = contents(spark, root, name)
    if is_done(table, batch_id):
        return {}
    drops = [r for r in rules if r.action == "drop"]
    obs = None
    measures = [F.count_if(quality.failed(r, delete_when)).alias(f"r{i}") for i, r in enumerate(rules)]
    measures += [F.expr(f"approx_top_k(`{c}`, {HOT_KEPT}, {HOT_TRACKED})").alias(f"h{i}") for i, c in enumerate(watch)]
    if measures:
        obs = Observation(f"batch_{name}_{batch_id}_{uuid.uuid4().hex[:8]}")
    any_drop = F.lit(False)
    for r in drops:
        any_drop = any_drop | quality.failed(r, delete_when)

    def reduced(i: int, passes: int) -> DataFrame:
        """The winners of the batch's keys, in several passes of every so many-th bucket."""
        kept = batch if obs is None or i else batch.observe(obs, *measures, F.count(F.lit(1)).alias("n"))
        kept = kept.where(~any_drop) if drops else kept
        if passes > 1:
            kept = kept.where(F.pmod(F.pmod(F.hash(buckets.key_text(kept, apply.keys)), F.lit(stored.buckets)), F.lit(passes)) == i)
        kept = kept if transform is None else transform(kept)
        return cdc.reduce_changes(kept, apply) if stored is None else reduced_by_text(kept, apply)

    size = known_bytes(batch)
    stored = batch_layout(table, layout, size)
    passes = 1 if stored is None else min(stored.buckets, -(-size // (PASS_BYTES if transform is None else JOINED_PASS_BYTES)))
    counts: dict[str, int] = {}

    def observed() -> tuple[dict, dict]:
        if obs is None:
            return {}, {}
        got = obs.get
        counts.update({r.name: int(got.get(f"r{i}") or 0) for i, r in enumerate(rules)})
        if any(counts[r.name] for r in drops):
            quality.check(batch, rules, delete_when).rejects.write.mode("overwrite").parquet(_batch_dir(rejects_path(root, name), batch_id))
        hot = {c: batch_hot([(x["item"], x["count"]) for x in got.get(f"h{i}") or []], int(got.get("n") or 0)) for i, c in enumerate(watch)}
        return {r.name: (r.action, counts[r.name]) for r in rules}, hot

    parts = [reduced(i, passes) for i in range(passes)]
    append_reduced(spark, root, name, batch_id, parts, apply, layout, observed, marks, stored)
    return counts


def start_silver(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """SCD1 flow for one registry table: bronze stream -> reduced state folders."""
    apply = cdc.ApplySpec.for_table(spec)
    source = read_bronze_stream(spark, root, spec, max_files_per_trigger)

    def run(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, root, spec.name, apply, spec.rules, spec.delete_predicate, layout=spec.layout, watch=spec.watch)

    return (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint_path(root, f"silver_{spec.name}"))
        .queryName(f"silver_{spec.name}_{abs(hash(root)) % 10**8}")
        .trigger(availableNow=True)
        .start()
    )


def start_apply(
    source: DataFrame,
    root: str,
    name: str,
    apply: cdc.ApplySpec,
    rules=(),
    delete_when: str | None = None,
) -> StreamingQuery:
    """Generic SCD1 flow for any change stream (no registry entry needed)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, root, name, apply, rules, delete_when)

    return (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint_path(root, f"apply_{name}"))
        .queryName(f"apply_{name}_{abs(hash(root)) % 10**8}")
        .trigger(availableNow=True)
        .start()
    )


# ---------------------------------------------------------------------------
# reading
# ---------------------------------------------------------------------------
def _batches(spark: SparkSession, root: str, name: str, ids) -> DataFrame:
    """Rows of batches, also of those that were written in passes."""
    return spark.read.option("recursiveFileLookup", "true").parquet(*[_batch_dir(state_path(root, name), b) for b in ids]).drop(KEY)


def _in_buckets(spark: SparkSession, root: str, name: str, table: dict) -> DataFrame | None:
    """The batches' rows with ``__k``, known to Spark as bucketed by it; None if some batch is not stored in the table's buckets."""
    held = [b for b in table["batches"] if b["rows"]]
    if not held or any(b.get("buckets") != table["layout"][0] for b in held):
        return None
    folders = [f"{_batch_dir(state_path(root, name), b['id'])}/{p}" for b in held for p in b["passes"]]
    schema = spark.read.parquet(folders[0]).schema
    return buckets.read(spark, dict(enumerate(folders)), schema, layout_of(table)).drop(SLOT)


def _reduced_batches(spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, table: dict, layout: Layout | None = None) -> DataFrame:
    """Winners of the batches, with ``__k``, each task holding whole buckets (of ``layout``, by default the table's): as they lie if they are stored so, else from one shuffle."""
    layout = layout or layout_of(table)
    rows = _in_buckets(spark, root, name, table) if layout.buckets == table["layout"][0] else None
    if rows is None:
        return _reduced_in_buckets(_batches(spark, root, name, [b["id"] for b in table["batches"]]), apply, layout)
    return rows if len(table["batches"]) == 1 else reduced_by_text(rows, apply)  # a batch has a row a key


def read_state(spark: SparkSession, root: str, name: str, after: int | None = None) -> DataFrame:
    """Per-batch reduced rows of committed batches that no snapshot holds; with ``after``, only those newer than it."""
    table = contents(spark, root, name)
    ids = [b["id"] for b in (table or {"batches": []})["batches"] if after is None or b["id"] > after]
    if not ids:
        raise FileNotFoundError(f"no committed batch of {name!r} after {after}")
    return _batches(spark, root, name, ids)


def stored_rows(spark: SparkSession, table: dict) -> DataFrame:
    """The snapshot's rows with ``__k`` and ``__slot``, known to Spark as bucketed by ``__k``."""
    folders = {s: e["folder"] for s, e in table["slots"].items()}
    return buckets.read(spark, folders, StructType.fromJson(json.loads(table["schema"])), layout_of(table))


def touched_slots(table: dict) -> list[int]:
    return sorted({s for b in table["batches"] for s in b["slots"]})


def merge_on_read(base: DataFrame, delta: DataFrame, apply: cdc.ApplySpec, small: bool = False) -> DataFrame:
    """``reduce(base union delta)`` where ``base`` already holds one row per key: reduce the delta, then join once."""
    return cdc.merge_reduced(base, cdc.reduce_changes(delta, apply), apply, small)


def _reduced_in_buckets(rows: DataFrame, apply: cdc.ApplySpec, layout: Layout) -> DataFrame:
    """Winners of stored rows with ``__k``, each task holding whole buckets: the one shuffle that a merge or a write of buckets needs.

    Batches have a row a key, so a key has no more rows here than there are batches.
    """
    keyed = rows.withColumn(KEY, buckets.key_text(rows, apply.keys)).repartition(layout.buckets, KEY)
    return cdc.reduce_changes(keyed, replace_fields(apply, keys=(KEY, *apply.keys)))


def _merged(spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, table: dict) -> DataFrame:
    """The touched slots' rows (with ``__k``) after the batches; each task holds whole buckets."""
    hit = buckets.only(stored_rows(spark, table), touched_slots(table))
    small = sum(b["bytes"] for b in table["batches"]) <= HASHED_BYTES_PER_BUCKET * table["layout"][0]
    return cdc.merge_reduced(hit, _reduced_batches(spark, root, name, apply, table), apply, small)


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(KEY, SLOT)


def reduced_state(spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, version: int | None = None, keyed: bool = False) -> DataFrame:
    """Per-key winners (tombstones included): the snapshot, with later batches merged into the slots they touch. ``keyed`` leaves ``__k`` on them."""
    rows = _reduced_state(spark, root, name, apply, version)
    if not keyed:
        return _plain(rows)
    return rows.drop(SLOT) if KEY in rows.columns else rows.withColumn(KEY, buckets.key_text(rows, apply.keys))


def _reduced_state(spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, version: int | None) -> DataFrame:
    table = contents(spark, root, name, version)
    if table is None:
        raise FileNotFoundError(f"{name!r} has no committed batch")
    if table["upto"] is None:
        if _in_buckets(spark, root, name, table) is not None:
            return _reduced_batches(spark, root, name, apply, table)
        return cdc.reduce_changes(_batches(spark, root, name, [b["id"] for b in table["batches"]]), apply)
    base = stored_rows(spark, table)
    if not table["batches"]:
        return base
    rest = buckets.without(base, touched_slots(table))
    return _merged(spark, root, name, apply, table).unionByName(rest.drop(SLOT))


def current_state(spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, version: int | None = None) -> DataFrame:
    """The live SCD1 table: snapshot + newer batches, reduced per key, tombstones dropped."""
    return cdc.live_rows(reduced_state(spark, root, name, apply, version), apply)


def current_state_of(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    return current_state(spark, root, spec.name, cdc.ApplySpec.for_table(spec))


def reduced_state_for(
    spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, keys: DataFrame, version: int | None = None, keyed: bool = False
) -> DataFrame | None:
    """Per-key winners of the given keys only: the key filter runs *before* the reduction.

    Because the reduction is per key, filtering the snapshot and the batches to
    ``keys`` first gives the same rows as filtering the full table afterwards.
    ``keys`` has the columns that slots go by (by default the key). One small job
    tells their slots and range, and the keys themselves if they are few: the scan
    then reads just those slots' pages with such a key. ``keyed`` leaves ``__k`` on
    rows that come from the snapshot alone, so that Spark knows them as bucketed.
    """
    table = contents(spark, root, name, version)
    if table is None:
        return None
    kcols, slots, ask = list(apply.slot_keys), layout_of(table).slots, "__asked"
    whole = tuple(kcols) == tuple(apply.keys)  # the asked keys are stored as they are, in ``__k``
    held = _in_buckets(spark, root, name, table) if whole and table["upto"] is None else None
    named = keys.select(*kcols)
    named = named.select(buckets.key_text(named, kcols).alias(ask)).withColumn(SLOT, buckets.slot_of(F.col(ask), slots))
    few = named.limit(LISTED_KEYS + 1).collect()  # bounded, and not yet distinct: many keys need no shuffle to be found many
    if len(few) > LISTED_KEYS:
        asked = named.select(ask).distinct().withColumn(SLOT, buckets.slot_of(F.col(ask), slots))
        low, high, at, n = asked.agg(F.min(ask), F.max(ask), F.collect_set(SLOT), F.count(F.lit(1))).first()
        few = asked.collect() if n <= LISTED_KEYS else None
    if few is not None:
        listed, at = sorted({r[ask] for r in few}), {r[SLOT] for r in few}
        asked = spark.createDataFrame([(k,) for k in listed], f"{ask} string")
        near = F.col(ask).isin(listed)
    else:
        asked, near = asked.drop(SLOT), F.col(ask).between(low, high)
        if whole and (table["upto"] is not None or held is not None):  # the keys go where the stored rows are, not both elsewhere
            asked = asked.repartition(layout_of(table).buckets, ask)

    def of_keys(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn(ask, F.col(KEY) if whole and KEY in rows.columns else buckets.key_text(rows, kcols))
        return rows.where(near).join(asked, ask, "left_semi").drop(ask)

    if held is not None:
        found = reduced_by_text(of_keys(held), apply)
        return found if keyed else _plain(found)
    parts = []
    if table["upto"] is not None:
        stored = of_keys(buckets.only(stored_rows(spark, table), at)).drop(SLOT)
        if not table["batches"]:
            return stored if keyed else _plain(stored)
        parts.append(_plain(stored))
    if table["batches"]:
        parts.append(of_keys(_batches(spark, root, name, [b["id"] for b in table["batches"]])))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return cdc.reduce_changes(rows, apply)


def current_state_for(
    spark: SparkSession, root: str, name: str, apply: cdc.ApplySpec, keys: DataFrame, version: int | None = None, keyed: bool = False
) -> DataFrame | None:
    """Current rows of the given keys only (None if the table has no commit)."""
    rows = reduced_state_for(spark, root, name, apply, keys, version, keyed)
    return None if rows is None else cdc.live_rows(rows, apply)


# ---------------------------------------------------------------------------
# compaction and retention
# ---------------------------------------------------------------------------
def write_slots(spark: SparkSession, rows: DataFrame, folder: str, apply: cdc.ApplySpec, layout: Layout, aligned: bool) -> dict:
    """Write keyed rows as slots below ``folder``; the manifest entries of those that got rows."""
    buckets.write(rows.withColumn(SLOT, _slot(rows, apply, layout.slots)), folder, layout, aligned)
    if not any(n.startswith(f"{SLOT}=") for n in files.children(spark, folder)):
        return {}
    counts = {int(r[SLOT]): r["count"] for r in spark.read.parquet(folder).groupBy(SLOT).count().collect()}  # from the files' footers; a row a slot
    return {str(s): {"folder": f"{folder}/{SLOT}={s}", "rows": n, "bytes": files.total_bytes(spark, f"{folder}/{SLOT}={s}")} for s, n in counts.items()}


def compact(
    spark: SparkSession,
    root: str,
    name: str,
    apply: cdc.ApplySpec,
    cluster_by=(),
    expire_tombstones_below: int | None = None,
    layout: Layout | None = None,
) -> str | None:
    """Fold the batches into a new snapshot (tombstones kept); returns the folder of the slots it wrote.

    Slots without a changed key keep their folders; the others are merged in place
    and written to ``snapshots/<t>/upto=N``. The manifest's next version names
    them all, so readers switch at once. The first snapshot gets the buckets that its
    size needs; ``layout`` rewrites the whole table in other ones. ``cluster_by`` is accepted for callers that name it; rows lie in
    the buckets of their key, which is what merges and lookups go by.

    ``expire_tombstones_below`` (off by default) drops delete markers whose
    first sequence column is below the given value, from all slots. This is an
    explicit trade: it bounds state growth from deletes, but a change that arrives
    later with a lower sequence than the expired delete would bring the key back.
    """
    table = contents(spark, root, name)
    if table is None:
        return None
    if not table["batches"] and layout is None and expire_tombstones_below is None:
        return f"{snapshots_path(root, name)}/upto={table['upto']}"
    upto = table["batches"][-1]["id"] if table["batches"] else table["upto"]
    to = layout or layout_of(table)
    whole = table["upto"] is None or layout is not None or expire_tombstones_below is not None
    first = table["upto"] is None and expire_tombstones_below is None
    if first:
        needed = buckets.grown(to, sum(b["bytes"] for b in table["batches"]))
        if layout is None and (needed.buckets > 2 * to.buckets or _in_buckets(spark, root, name, table) is None):
            to = needed  # batches that lie in buckets stay in them while these are of about the right size
        rows = _reduced_batches(spark, root, name, apply, table, to)
    elif whole:
        reduced = reduced_state(spark, root, name, apply, table["version"])
        if expire_tombstones_below is not None:
            seq = cdc.col_of(apply.sequence_by[0])
            expired = cdc.mark_deletes(reduced, apply)
            reduced = expired.where(~(F.col(cdc.DELETED_COL) & (seq < F.lit(expire_tombstones_below)))).drop(cdc.DELETED_COL)
        rows = reduced.withColumn(KEY, buckets.key_text(reduced, apply.keys))
    else:
        rows = _merged(spark, root, name, apply, table)
    out = f"{snapshots_path(root, name)}/upto={upto}"
    if files.exists(spark, out):  # a compaction that was not committed, or the same batches in another layout
        out = f"{out}-{uuid.uuid4().hex[:8]}"
    entries = write_slots(spark, rows, out, apply, to, aligned=first or not whole)
    schema = json.dumps(json.loads(rows.schema.json()))
    folded = {b["id"] for b in table["batches"]}

    def fold(before: dict | None) -> dict | None:
        if before["upto"] != table["upto"] or before["slots"] != table["slots"]:
            return None  # another compaction came first
        kept = {} if whole else {s: e for s, e in before["slots"].items() if int(s) not in touched_slots(table)}
        left = [b for b in before["batches"] if b["id"] not in folded]
        return before | {"upto": upto, "slots": kept | entries, "schema": schema, "layout": [to.buckets, to.slots], "batches": left}

    commit(spark, root, name, fold)
    return out


def replace(spark: SparkSession, root: str, name: str, rows: DataFrame, apply: cdc.ApplySpec, batch_id: int, layout: Layout | None = None) -> str:
    """Make ``rows`` (one a key) the whole table, as the snapshot up to ``batch_id``; what was there stays readable by version."""
    table = contents(spark, root, name)
    to = layout or (layout_of(table) if table else Layout())
    out = f"{snapshots_path(root, name)}/upto={batch_id}"
    if files.exists(spark, out):
        out = f"{out}-{uuid.uuid4().hex[:8]}"
    keyed = rows.withColumn(KEY, buckets.key_text(rows, apply.keys))
    entries = write_slots(spark, keyed, out, apply, to, aligned=False)
    fresh = empty_table(to) | {"upto": int(batch_id), "slots": entries, "schema": json.dumps(json.loads(keyed.schema.json()))}
    commit(spark, root, name, lambda before: fresh | {k: (before or fresh)[k] for k in ("rules", "marks", "hot")})
    return out


def expire(spark: SparkSession, root: str, name: str, older_than_seconds: float) -> dict[str, int]:
    """Remove what only manifest versions older than the given age refer to; the newest version always stays.

    A reader that started within that age finds every file it planned to read.
    Old versions are forgotten first, so no reader can find one whose files are
    going. Returns how many versions, batch folders and snapshot folders went.
    """
    import time

    m = manifest_of(spark, root, name)
    versions = m.versions()
    if not versions:
        return {"versions": 0, "batches": 0, "folders": 0}
    held = {v: m.at(v) for v in versions}
    # a version is in use until the one after it is older than the limit
    limit = time.time() - older_than_seconds
    gone = [v for v, after in zip(versions, versions[1:]) if held[after]["time"] < limit]
    kept = [held[v] for v in versions if v not in gone]
    needed_batches = {b["id"] for t in kept for b in t["batches"]}
    needed_folders = {e["folder"] for t in kept for e in t["slots"].values()}
    old_batches = {b["id"] for v in gone for b in held[v]["batches"]} - needed_batches
    old_folders = {e["folder"] for v in gone for e in held[v]["slots"].values()} - needed_folders
    m.forget(gone)
    for b in old_batches:
        files.remove(spark, _batch_dir(state_path(root, name), b))
    for f in old_folders:
        files.remove(spark, f)
    return {"versions": len(gone), "batches": len(old_batches), "folders": len(old_folders)}


def rule_counts(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rule failures summed over all batches: ``(rule, action, failed_rows)``."""
    table = contents(spark, root, name)
    rows = [(rule, action, n) for rule, (action, n) in (table or {"rules": {}})["rules"].items()]
    return spark.createDataFrame(rows, "rule string, action string, failed_rows bigint")


def read_rejects(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Rows removed by drop rules, with the failed rule names (None if no batch dropped any)."""
    if not files.children(spark, rejects_path(root, name)):
        return None
    return spark.read.parquet(rejects_path(root, name)).drop("batch_id")
