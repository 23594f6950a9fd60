"""Named queries over the driver's tables: one per operator family.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame. They are what the
oracle check, the bench and the tests run. Streaming queries run their stream
to completion (``availableNow``) below the session's checkpoint folder and
return a batch read of the result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import cdc, quality
from .plans import gold, layers, reconcile, refresh, roles, skew
from .session import work_dir
from .sources.control import CONTROL_SCHEMA, control_path
from .specs import CLAIMS, OPER_COL, RESCUE_COL, SEQ_COL, SOURCE_FILE_COL, Rule, TableSpec
from .sources import schemas
from .streaming import apply as ap
from .streaming import feed, history
from .streaming.ingest import land, landing_path
from .streaming.runner import Runner

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _silver(spark: SparkSession, sf_dir: str, table: str, rm: roles.RoleMap | None = None) -> DataFrame:
    return layers.silver_from_roles(spark, sf_dir, table, rm)


# ---------------------------------------------------------------------------
# change application on the raw driver tables
# ---------------------------------------------------------------------------
@register
def cdc_scd1_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.apply_changes(roles.events_log(spark, sf_dir), roles.EVENTS_APPLY)


@register
def cdc_scd1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite key, out-of-order and tied changes, deletes by predicate."""
    return cdc.apply_changes(roles.line_log(spark, sf_dir), roles.LINE_APPLY)


@register
def cdc_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.tombstones(roles.line_log(spark, sf_dir), roles.LINE_APPLY, order_alias=["l_shipdate"])


# ---------------------------------------------------------------------------
# gold datasets over the claims world (seed + one increment)
# ---------------------------------------------------------------------------
@register
def dim_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_provider(_silver(spark, sf_dir, "provider"))


@register
def dim_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_member(_silver(spark, sf_dir, "member"))


@register
def dim_payer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_payer(_silver(spark, sf_dir, "payer"))


@register
def dim_procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_procedure(_silver(spark, sf_dir, "claim_detail"))


@register
def dim_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_diagnosis(_silver(spark, sf_dir, "claim_diagnosis"))


@register
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar covering whole years of the claims' service dates (bounds from the data)."""
    return gold.dim_date_of(_silver(spark, sf_dir, "claim"))


@register
def fact_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_claim_line(_silver(spark, sf_dir, "claim_detail"), _silver(spark, sf_dir, "claim"))


@register
def fact_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_claim(_silver(spark, sf_dir, "claim"), _silver(spark, sf_dir, "claim_detail"))


@register
def agg_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = gold.fact_claim(_silver(spark, sf_dir, "claim"), _silver(spark, sf_dir, "claim_detail"))
    return gold.daily_kpis(fact)




# ---------------------------------------------------------------------------
# streaming: landing -> bronze -> silver -> twin, run to completion
# ---------------------------------------------------------------------------
def _claims_runner(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], with_twin: bool, name: str):
    """Land the seed, run every layer; land one increment, run again (a restart)."""

    runner = Runner(spark, work_dir(spark, name))
    for run in (roles.SEED, roles.INCREMENT):
        runner.land_roles(sf_dir, run, tables=tables)
        runner.step(tables, with_twin=with_twin)
    return runner


_COMPARED_DETAIL = [c for c in CLAIMS["claim_detail"].business_columns if c != "last_updated"]


@register
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files -> append-only change log with provenance (label from the file path)."""

    runner = _claims_runner(spark, sf_dir, ("claim_detail",), False, "bronze")
    b = runner.bronze("claim_detail")
    label = F.regexp_extract(F.col(SOURCE_FILE_COL), r"/landing/claim_detail/([^/]+)/", 1)
    return b.select(*_COMPARED_DETAIL, OPER_COL, SEQ_COL, label.alias("label"))


@register
def cdc_stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming SCD1 of the line table across two runs of the flow."""
    runner = _claims_runner(spark, sf_dir, ("claim_detail",), False, "silver")
    return runner.current("claim_detail").select(*_COMPARED_DETAIL)


@register
def cdc_replay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuild the line table from its whole bronze log in one batch (replay/audit)."""
    runner = _claims_runner(spark, sf_dir, ("claim_detail",), False, "replay")
    rebuilt = layers.silver(runner.bronze("claim_detail"), CLAIMS["claim_detail"])
    return rebuilt.select(*_COMPARED_DETAIL)


@register
def fact_line_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental twin of the line fact (stream-static join + change apply)."""
    runner = _claims_runner(spark, sf_dir, ("claim", "claim_detail"), True, "twin")
    return runner.twin_table()


@register
def cdc_stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land in three slices, out of sequence order; the flow restarts per slice."""

    root = work_dir(spark, "events")
    events = roles.events_log(spark, sf_dir)
    slice_of = F.pmod(F.xxhash64(F.col("event_id")), F.lit(3))
    for i, s in enumerate((2, 0, 1)):
        land(events.where(slice_of == s), root, "events", f"slice{i}")
        src = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(landing_path(root, "events"))
        ap.start_apply(src, root, "events", roles.EVENTS_APPLY).awaitTermination()
    return ap.current_state(spark, root, "events", roles.EVENTS_APPLY)


# ---------------------------------------------------------------------------
# row-quality rules
# ---------------------------------------------------------------------------
def event_rules():
    """Rules that fail on some driver rows: warn below 10, drop below 1 (noise)."""

    return (
        Rule("value_at_least_10", "value >= 10", "warn"),
        Rule("value_at_least_1", "value >= 1", "drop", applies_to_deletes=True),
    )


@register
def quality_warn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:

    return quality.rule_metrics(roles.events_log(spark, sf_dir), event_rules(), roles.EVENTS_APPLY.delete_when)


@register
def quality_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state after the drop rule removed its rows from the change log."""

    kept = quality.check(roles.events_log(spark, sf_dir), event_rules(), roles.EVENTS_APPLY.delete_when).kept
    return cdc.apply_changes(kept, roles.EVENTS_APPLY)


@register
def quality_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:

    r = quality.check(roles.events_log(spark, sf_dir), event_rules(), roles.EVENTS_APPLY.delete_when).rejects
    return r.select("event_id", "user_id", "event_type", F.concat_ws(",", quality.REJECT_RULES_COL).alias("failed_rules"))


# ---------------------------------------------------------------------------
# history (SCD2)
# ---------------------------------------------------------------------------
@register
def cdc_scd2_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.scd2_history(roles.events_log(spark, sf_dir), roles.EVENTS_APPLY)


@register
def cdc_scd2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History with a composite key and tied sequences, skew-safe ordering."""
    return cdc.scd2_history(roles.line_log(spark, sf_dir), roles.LINE_APPLY)


# ---------------------------------------------------------------------------
# change-batch synthesis
# ---------------------------------------------------------------------------
def _change_cols() -> list[str]:

    return _COMPARED_DETAIL + [OPER_COL, SEQ_COL]


@register
def change_batch_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per (table, operation) in one increment of all nine tables."""

    out = None
    for t in CLAIMS:
        c = roles.changes(spark, sf_dir, t, roles.INCREMENT)
        per = c.groupBy(F.col(OPER_COL).alias("oper")).agg(F.count(F.lit(1)).alias("changes"))
        per = per.select(F.lit(t).alias("table_name"), "oper", "changes")
        out = per if out is None else out.unionByName(per)
    return out


@register
def change_batch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserted and updated line rows of the increment (line multiplication, new amounts)."""

    c = roles.changes(spark, sf_dir, "claim_detail", roles.INCREMENT)
    return c.where(F.col(OPER_COL) != "D").select(*_change_cols())


@register
def change_batch_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-only delete rows of reversed claims (every payload column a typed NULL)."""

    c = roles.changes(spark, sf_dir, "claim_detail", roles.INCREMENT)
    return c.where(F.col(OPER_COL) == "D").select(*_change_cols())


@register
def union_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed and increment header frames unioned by name into one change log."""

    log = roles.change_log(spark, sf_dir, "claim")
    return log.select(
        "claim_id", "member_id", "provider_id", "payer_id", "claim_status", "claim_type",
        "total_charge_amount", "service_from_date", OPER_COL, SEQ_COL,
    )


# ---------------------------------------------------------------------------
# skew: even against 80%-hot increments
# ---------------------------------------------------------------------------
SKEW_SCENARIOS = (("even", 0.0), ("hot", 0.8))
SKEW_KEYS = ("claim_detail_id", "provider_id")


@register
def skew_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-key share of an increment by merge key and by the hot attribute."""

    out = None
    for scenario, hot in SKEW_SCENARIOS:
        inc = roles.changes(spark, sf_dir, "claim_detail", roles.INCREMENT, roles.RoleMap(hot_share=hot))
        for k in SKEW_KEYS:
            p = skew.key_profile(inc, [k]).select(F.lit(scenario).alias("scenario"), F.lit(k).alias("merge_key"), "*")
            out = p if out is None else out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# reconciliation and snapshot difference
# ---------------------------------------------------------------------------
@register
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line table after the seed against after the increment, as an I/U/D log."""

    before = layers.silver_from_roles(spark, sf_dir, "claim_detail", runs=(roles.SEED,))
    after = layers.silver_from_roles(spark, sf_dir, "claim_detail")
    return reconcile.snapshot_diff(before, after, ["claim_detail_id"])


@register
def twin_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full line fact against its incremental twin: only header drift is expected."""

    runner = _claims_runner(spark, sf_dir, ("claim", "claim_detail"), True, "reconcile")
    full = gold.fact_claim_line(runner.current("claim_detail"), runner.current("claim"))
    return reconcile.twin_reconcile(full, runner.twin_table(), "claim_detail_id", gold.HEADER_ORIGIN)


# ---------------------------------------------------------------------------
# incremental refresh and strategy choice (20% of claims change)
# ---------------------------------------------------------------------------
PARTIAL = roles.RoleMap(n_buckets=100, touched=0.2)


@register
def agg_daily_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily KPIs after the increment, recomputing only the groups it touched."""

    header_before = layers.silver_from_roles(spark, sf_dir, "claim", PARTIAL, runs=(roles.SEED,))
    detail_before = layers.silver_from_roles(spark, sf_dir, "claim_detail", PARTIAL, runs=(roles.SEED,))
    previous = gold.daily_kpis(gold.fact_claim(header_before, detail_before))
    header_after = layers.silver_from_roles(spark, sf_dir, "claim", PARTIAL)
    detail_after = layers.silver_from_roles(spark, sf_dir, "claim_detail", PARTIAL)
    changed = (
        roles.changes(spark, sf_dir, "claim", roles.INCREMENT, PARTIAL).select("claim_id")
        .unionByName(roles.changes(spark, sf_dir, "claim_detail", roles.INCREMENT, PARTIAL).select("claim_id"))
        .distinct()
    )
    return refresh.refresh_daily(previous, header_before, header_after, detail_after, changed)


@register
def refresh_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change ratio per table and the refresh strategy it selects (full at >= 20%)."""

    out = None
    for t in ("claim", "claim_detail"):
        changes = roles.changes(spark, sf_dir, t, roles.INCREMENT, PARTIAL)
        base = layers.silver_from_roles(spark, sf_dir, t, PARTIAL, runs=(roles.SEED,))
        r = refresh.choose_refresh(refresh.change_ratio(changes, base)).select(F.lit(t).alias("table_name"), "*")
        out = r if out is None else out.unionByName(r)
    return out


# ---------------------------------------------------------------------------
# drift rescue, JSON landing, all flows, compaction
# ---------------------------------------------------------------------------
def _drifted(spark: SparkSession, sf_dir: str) -> Runner:
    """Plain files, then an increment with a text ``units`` column and an unknown column, then plain files again, through the same flow."""

    table, runner = "claim_detail", Runner(spark, work_dir(spark, "rescue"))
    seed = roles.changes(spark, sf_dir, table, roles.SEED)
    first = F.pmod(F.xxhash64("claim_detail_id"), F.lit(2)) == 0
    runner.land(table, seed.where(first), "seed")
    runner.step((table,), with_twin=False)
    inc = roles.changes(spark, sf_dir, table, roles.INCREMENT)
    drifted = inc.withColumn(
        "units",
        F.when(F.col("line_number") == 1, F.concat(F.col("units").cast("string"), F.lit(" units"))).otherwise(
            F.col("units").cast("string")
        ),
    ).withColumn("source_system", F.lit("legacy"))
    runner.land(table, drifted, "incr0001")
    runner.step((table,), with_twin=False)
    runner.land(table, seed.where(~first), "late")
    runner.step((table,), with_twin=False)
    return runner


@register
def bronze_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log of plain, drifted and again plain files: what does not fit is in the rescue column."""
    return _drifted(spark, sf_dir).bronze("claim_detail").select(*_COMPARED_DETAIL, OPER_COL, SEQ_COL, RESCUE_COL)


@register
def schema_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schemas that the line table's files had, in order, with the run that brought each and how it departs from the registry."""
    runner = _drifted(spark, sf_dir)
    log = schemas.history(spark, runner.root, CLAIMS["claim_detail"])
    drifted = F.col(SOURCE_FILE_COL).contains("/claim_detail/incr0001/")
    counts = runner.bronze("claim_detail").groupBy(drifted.cast("int").alias("version")).agg(F.count(F.lit(1)).alias("n_rows"))
    label = F.regexp_extract("file", r"/landing/claim_detail/([^/]+)/", 1).alias("label")
    return log.select("version", "batch_id", label, "added", "missing", "retyped").join(counts, "version")


MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # JSON text keeps microseconds (default is millis)


@register
def bronze_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON landing through the bronze flow: the same reader with a format argument and the declared schema."""

    events = roles.events_log(spark, sf_dir)
    spec = TableSpec("events", ("user_id",), tuple((f.name, f.dataType.simpleString()) for f in events.schema.fields))
    runner = Runner(spark, work_dir(spark, "json"), {"events": spec})
    half = F.pmod(F.xxhash64(F.col("event_id")), F.lit(2))
    for i in (0, 1):
        events.where(half == i).write.mode("append").option("timestampNTZFormat", MICROS).option("timestampFormat", MICROS).json(
            landing_path(runner.root, "events", f"part{i}")
        )
    runner.ingest(fmt="json")
    return runner.bronze("events").select(*events.columns)


@register
def bronze_json_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with a value that is no number, a field that is not declared, and lines that are no JSON: one parse, nothing lost."""

    events = roles.events_log(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    spec = TableSpec("events", ("user_id",), tuple((f.name, f.dataType.simpleString()) for f in events.schema.fields))
    runner = Runner(spark, work_dir(spark, "json-rescue"), {"events": spec})
    kind = F.pmod("event_id", F.lit(10))
    texts = {
        "event_id": F.col("event_id").cast("string"),
        "user_id": F.col("user_id").cast("string"),
        "event_type": F.col("event_type"),
        "value": F.when(kind == 1, F.concat(F.lit("about "), F.floor("value").cast("string"))).otherwise(F.col("value").cast("string")),
        "origin": F.when(kind.isin(1, 2), F.concat(F.lit("feed "), F.col("user_id").cast("string"))),
    }
    line = F.to_json(F.struct(*[c.alias(n) for n, c in texts.items()]))
    lines = events.select(F.when(kind == 3, F.concat(F.lit("broken "), F.col("event_id").cast("string"))).otherwise(line).alias("value"))
    lines.write.text(landing_path(runner.root, "events", "part0"))
    runner.ingest(fmt="json", suffix="txt")
    return runner.bronze("events").select(*events.columns, RESCUE_COL)


@register
def flows_live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine tables: bronze flows run together, then silver flows together; live rows per table."""
    runner = _claims_runner(spark, sf_dir, tuple(CLAIMS), False, "flows")
    out = None
    for t in CLAIMS:
        c = runner.current(t).agg(F.count(F.lit(1)).alias("live_rows")).select(F.lit(t).alias("table_name"), "live_rows")
        out = c if out is None else out.unionByName(c)
    return out


@register
def cdc_compact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed state compacted into a snapshot; the increment is merged on read (changed keys only)."""

    runner = Runner(spark, work_dir(spark, "compact"))
    runner.land_roles(sf_dir, roles.SEED, tables=("claim_detail",))
    runner.step(("claim_detail",), with_twin=False)
    runner.compact(("claim_detail",))
    runner.land_roles(sf_dir, roles.INCREMENT, tables=("claim_detail",))
    runner.step(("claim_detail",), with_twin=False)
    return runner.current("claim_detail").select(*_COMPARED_DETAIL)


@register
def cdc_compact_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch fails half-way, the state is compacted, the batch is retried: nothing is lost."""

    table, spec = "claim_detail", CLAIMS["claim_detail"]
    root, rule = work_dir(spark, "retry"), cdc.ApplySpec.for_table(CLAIMS["claim_detail"])
    ap.apply_batch(roles.changes(spark, sf_dir, table, roles.SEED), 0, root, table, rule, spec.rules, spec.delete_predicate)
    failed = roles.changes(spark, sf_dir, table, roles.INCREMENT)
    failed.write.parquet(f"{ap.state_path(root, table)}/batch_id=1/_temporary/0")  # what a failed write leaves
    ap.compact(spark, root, table, rule)
    ap.apply_batch(failed, 1, root, table, rule, spec.rules, spec.delete_predicate)
    return ap.current_state(spark, root, table, rule).select(*_COMPARED_DETAIL)


@register
def cdc_compact_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with NULL parts through a snapshot and a later batch: they are keys like any other."""

    kind = F.when(F.col("user_id") % 5 != 0, F.col("event_type"))
    user = F.when(F.col("user_id") % 3 != 0, F.col("user_id"))
    log = roles.events_log(spark, sf_dir).select(user.alias("u"), kind.alias("kind"), "event_id", "value")
    rule = cdc.ApplySpec(keys=("u", "kind"), sequence_by=("event_id",), delete_when=None)
    root, half = work_dir(spark, "null-keys"), F.pmod(F.xxhash64("event_id"), F.lit(2))
    ap.apply_batch(log.where(half == 0), 0, root, "log", rule)
    ap.compact(spark, root, "log", rule)
    ap.apply_batch(log.where(half == 1), 1, root, "log", rule)
    return ap.current_state(spark, root, "log", rule)


@register
def control_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs landed through the control row: high-water mark, next sequence base, run index."""

    runner = Runner(spark, work_dir(spark, "control"))
    for _ in range(3):
        run = runner.land_next_run(sf_dir, tables=("claim", "claim_detail"))
    runner.step(("claim", "claim_detail"), with_twin=False)
    latest = spark.read.schema(CONTROL_SCHEMA).parquet(f"{control_path(runner.root)}/v={run}")
    live = runner.current("claim").agg(F.count(F.lit(1)).alias("live_claims"), F.lit(run).cast("bigint").alias("run_index"))
    return latest.join(live, "run_index").select("max_claim_n", "seq_base", "run_index", "live_claims")


def _published(spark: SparkSession, sf_dir: str) -> Runner:
    runner = _claims_runner(spark, sf_dir, tuple(CLAIMS), False, "gold")
    runner.publish_gold()
    return runner


@register
def gold_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each gold dataset as published from stored silver."""

    runner, out = _published(spark, sf_dir), None
    for name in sorted(runner.gold()):
        n = runner.read_gold(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out


@register
def gold_published_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily KPIs as published, built from the published header fact."""

    return _published(spark, sf_dir).read_gold("agg_claims_daily")


@register
def cdc_scd2_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-2 history of claim headers from their bronze log, the seed delivered twice."""

    registry = {**CLAIMS, "claim": replace(CLAIMS["claim"], scd_type=2)}
    runner = Runner(spark, work_dir(spark, "scd2"), registry)
    for run, label in ((roles.SEED, "seed"), (roles.SEED, "again"), (roles.INCREMENT, "incr0001")):
        runner.land("claim", roles.changes(spark, sf_dir, "claim", run), label)
        runner.ingest(("claim",))
    return runner.table("claim").select("claim_id", "claim_status", "payer_id", cdc.START_COL, cdc.END_COL)


def _increment(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return roles.changes(spark, sf_dir, table, roles.INCREMENT).select(*CLAIMS[table].business_columns, OPER_COL, SEQ_COL)


@register
def change_batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of the increment."""
    return _increment(spark, sf_dir, "claim_audit")


@register
def change_batch_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment rows of the increment."""
    return _increment(spark, sf_dir, "claim_payment")


@register
def change_batch_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute rows of the increment's new claims."""
    return _increment(spark, sf_dir, "claim_attribute")


@register
def change_batch_diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnosis rows of the increment's new claims."""
    return _increment(spark, sf_dir, "claim_diagnosis")


# ---------------------------------------------------------------------------
# stored history, change feed between versions
# ---------------------------------------------------------------------------
@register
def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-2 history of the events, stored and brought up to date by five batches: late ones, one delivered twice, one after a compaction."""

    root, rule = work_dir(spark, "history"), roles.EVENTS_APPLY
    events = roles.events_log(spark, sf_dir)
    slice_of = F.pmod(F.xxhash64(F.col("event_id")), F.lit(4))
    for batch, s in enumerate((2, 0, 0, 3, 1)):
        history.update_history(events.where(slice_of == s), batch, root, "events", rule)
        if batch == 3:
            history.compact_history(spark, root, "events", rule)
    return history.read_history(spark, root, "events", rule)


@register
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line table's changes from its first version to its last, read from the batches between them."""

    runner, rule = Runner(spark, work_dir(spark, "feed")), cdc.ApplySpec.for_table(CLAIMS["claim_detail"])
    runner.land_roles(sf_dir, roles.SEED, tables=("claim_detail",))
    runner.step(("claim_detail",), with_twin=False)
    runner.compact(("claim_detail",))
    first = feed.current_version(spark, runner.root, "claim_detail")
    runner.land_roles(sf_dir, roles.INCREMENT, tables=("claim_detail",))
    runner.step(("claim_detail",), with_twin=False)
    runner.compact(("claim_detail",))
    columns = [c for c in CLAIMS["claim_detail"].business_columns if c != "claim_detail_id"]
    return feed.with_changed_columns(feed.change_feed(spark, runner.root, "claim_detail", rule, first), columns)


@register
def agg_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily KPIs published in full after the seed, then moved by the increment's changes (signed deltas on stored totals)."""

    runner, tables = Runner(spark, work_dir(spark, "rollup")), ("claim", "claim_detail")
    for run in (roles.SEED, roles.INCREMENT):
        runner.land_roles(sf_dir, run, PARTIAL, tables)
        runner.step(tables, with_twin=False)
        runner.publish_gold(names=("fact_claim", "agg_claims_daily"), threshold=1.0)
    return runner.read_gold("agg_claims_daily")


@register
def refresh_choice_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change ratio per table and the strategy it selects, from the rows counted when batches and snapshots were written: no scan."""

    runner, tables = Runner(spark, work_dir(spark, "choice")), ("claim", "claim_detail")
    runner.land_roles(sf_dir, roles.SEED, PARTIAL, tables)
    runner.step(tables, with_twin=False)
    runner.compact(tables)
    runner.land_roles(sf_dir, roles.INCREMENT, PARTIAL, tables)
    runner.step(tables, with_twin=False)
    rows = []
    for t in tables:
        held = ap.contents(spark, runner.root, t)
        changed, base = ap.changed_rows(held), ap.snapshot_rows(held)
        rows.append((t, changed, base, changed * 10000 // base if base else None, refresh.decide(changed, base)))
    return spark.createDataFrame(rows, "table_name string, changed_rows bigint, base_rows bigint, change_ratio_bp bigint, strategy string")


@register
def fact_line_two_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental line fact with lines of changed headers written again: equal to the full build, no drift."""

    runner, tables = Runner(spark, work_dir(spark, "two-sided")), ("claim", "claim_detail")
    for run in (roles.SEED, roles.INCREMENT):
        runner.land_roles(sf_dir, run, tables=tables)
        runner.step(tables, refresh_headers=True)
    return runner.twin_table()


@register
def skew_heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The providers of an 80%-hot increment from the sketch kept with its batch: no pass over the rows."""

    runner = Runner(spark, work_dir(spark, "hitters"))
    runner.land("claim_detail", roles.changes(spark, sf_dir, "claim_detail", roles.INCREMENT, roles.RoleMap(hot_share=0.8)), "incr0001")
    runner.step(("claim_detail",), with_twin=False)
    found = skew.heavy_hitters(spark, ap.contents(spark, runner.root, "claim_detail"), "provider_id", least_share=0.1)
    return found.where("item <> ''").select("item", "n_rows", "rows", "share_bp")


@register
def change_batch_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each pair of drawn attributes comes up over all claims."""
    drawn = roles.drawn_attributes(spark, sf_dir)
    return drawn.groupBy("channel", "reason").agg(F.count(F.lit(1)).alias("claims"), F.min("claim_id").alias("first_claim"))
