"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Besides per-query seconds it records what the baseline publishes (rows touched):
full rebuild against incremental twin of the line fact at several change
ratios, with the records and bytes that each side read and wrote (from Spark's
event log), max/median rows per shuffle partition for an even and an 80%-hot
increment, and bronze-to-current-state rows per second for one change batch.
Queries run with the ``noop`` sink: the whole plan executes, nothing is
collected to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "cdc_scd1_events",
    "cdc_scd1_lines",
    "cdc_tombstones",
    "cdc_scd2_lines",
    "quality_drop",
    "dim_provider",
    "dim_member",
    "dim_payer",
    "dim_procedure",
    "dim_diagnosis",
    "dim_date",
    "fact_line",
    "fact_header",
    "agg_daily",
    "agg_daily_touched",
    "snapshot_diff",
    "change_batch_mix",
    "skew_profile",
    "refresh_choice",
    "fact_line_incremental",
    "gold_published_kpis",
]
RATIOS = [0.001, 0.01, 0.05, 0.2, 0.5]


def _sf_of(path: str) -> float | str:
    base = os.path.basename(path)
    try:
        return float(base.replace("sf", ""))
    except ValueError:
        return base


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def time_queries(spark, names):
    from tidewater import queries as Q

    out = {}
    for name in names:
        t0 = time.time()
        _run(Q.REGISTRY[name](spark, SF_DIR))
        out[name] = round(time.time() - t0, 3)
        print(f"{name}: {out[name]}s", file=sys.stderr, flush=True)
    return out


def measured(spark, label: str, work) -> float:
    """Seconds of ``work``; its jobs carry ``label`` in the event log."""
    spark.sparkContext.setJobGroup(label, label)
    t0 = time.time()
    work()
    spark.sparkContext.setJobGroup("", "")
    return time.time() - t0


def records(folder: str) -> dict[str, dict[str, int]]:
    """Records and bytes read from and written to tables, and shuffled bytes, of each job group, from the event log."""
    out: dict[str, dict[str, int]] = {}
    group: dict[int, str] = {}
    for name in os.listdir(folder):
        with open(os.path.join(folder, name), errors="replace") as f:
            for line in f:
                e = json.loads(line) if line.startswith("{") and line.endswith("}\n") else {}
                if e.get("Event") == "SparkListenerJobStart":
                    label = (e.get("Properties") or {}).get("spark.jobGroup.id") or ""
                    group.update(dict.fromkeys(e["Stage IDs"], label))
                elif e.get("Event") == "SparkListenerTaskEnd" and group.get(e["Stage ID"]):
                    m = e.get("Task Metrics") or {}
                    own = out.setdefault(group[e["Stage ID"]], {})
                    for key, part, field in (
                        ("records_read", "Input Metrics", "Records Read"),
                        ("bytes_read", "Input Metrics", "Bytes Read"),
                        ("records_written", "Output Metrics", "Records Written"),
                        ("bytes_written", "Output Metrics", "Bytes Written"),
                        ("shuffle_bytes", "Shuffle Write Metrics", "Shuffle Bytes Written"),
                    ):
                        own[key] = own.get(key, 0) + int((m.get(part) or {}).get(field, 0))
    return out


def ratio_experiment(spark):
    """Full rebuild against incremental twin of the line fact, per change ratio, both by the library's own path.

    The seed is applied and compacted once. Each ratio's increment lands as files
    and is applied to the silver tables, for both sides, off the clock. Then

    * incremental: the twin's batch, its headers looked up by ``current_state_for``;
    * full: the whole line fact from current state.

    Both write parquet, neither reads anything cached. Between ratios all state
    is compacted, so each starts from a snapshot.
    """
    from tidewater.operators import cdc
    from tidewater.plans import changes as ch
    from tidewater.plans import gold, roles
    from tidewater.session import work_dir
    from tidewater.specs import CLAIMS
    from tidewater.streaming import apply as ap
    from tidewater.streaming import twin

    # No new claims, so every ratio shares the seed: 0.375/0.4375/0.1875 of changes.
    mix = ch.ChangeMix(new=0.0, header_only=0.375, adjustment=0.4375, reversal=0.1875)
    root = work_dir(spark, "bench-ratio")
    rules = {t: cdc.ApplySpec.for_table(CLAIMS[t]) for t in ("claim", "claim_detail")}

    def apply(table, rows, batch):
        spec = CLAIMS[table]
        ap.apply_batch(rows, batch, root, table, rules[table], spec.rules, spec.delete_predicate)

    def apply_twin(rows, batch):
        spec = CLAIMS["claim_detail"]
        lookup = lambda kept: twin.line_changes_with_header(
            kept, twin.headers_for(spark, root, kept)
        )
        ap.apply_batch(rows, batch, root, twin.TWIN, twin.twin_apply(), spec.drop_rules(), spec.delete_predicate, transform=lookup)

    def compact():
        for t, rule, layout in (("claim", rules["claim"], ("claim_id",)), ("claim_detail", rules["claim_detail"], ("claim_detail_id",)), (twin.TWIN, twin.twin_apply(), ("claim_id",))):
            ap.compact(spark, root, t, rule, layout)

    def landed(table, run, rm, label):
        path = f"{root}/landing/{table}/{label}"
        roles.changes(spark, SF_DIR, table, run, rm).write.parquet(path)
        return spark.read.parquet(path)

    seed = roles.RoleMap(mix=mix, n_buckets=80000, touched=0.0, hashed_buckets=True)
    apply("claim", landed("claim", roles.SEED, seed, "seed"), 0)
    lines = landed("claim_detail", roles.SEED, seed, "seed")
    apply("claim_detail", lines, 0)
    apply_twin(lines, 0)
    results = {}
    for i, r in enumerate(RATIOS, 1):
        compact()
        rm = roles.RoleMap(mix=mix, n_buckets=80000, touched=r, hashed_buckets=True, seq_base=i * ch.SEQ_STEP)
        apply("claim", landed("claim", roles.INCREMENT, rm, f"incr{i}"), i)
        changed = landed("claim_detail", roles.INCREMENT, rm, f"incr{i}")
        apply("claim_detail", changed, i)
        incremental = measured(spark, f"incremental {r:g}", lambda: apply_twin(changed, i))
        full = measured(
            spark,
            f"full {r:g}",
            lambda: gold.fact_claim_line(
                ap.current_state(spark, root, "claim_detail", rules["claim_detail"]), ap.current_state(spark, root, "claim", rules["claim"])
            ).write.parquet(f"{root}/full/{i}"),
        )
        results[f"{r:g}"] = {"incremental_sec": round(incremental, 3), "full_sec": round(full, 3)}
        print(f"ratio {r}: {results[f'{r:g}']}", file=sys.stderr, flush=True)
    return results


def rollup_experiment(spark, ratio: float = 0.01):
    """Daily KPIs after a change of ``ratio`` of the claims: moved by signed deltas against rebuilt, both from stored silver to stored gold."""
    from tidewater.operators import cdc
    from tidewater.plans import changes as ch
    from tidewater.plans import roles
    from tidewater.session import work_dir
    from tidewater.specs import CLAIMS
    from tidewater.streaming import apply as ap
    from tidewater.streaming import publish

    mix = ch.ChangeMix(new=0.0, header_only=0.375, adjustment=0.4375, reversal=0.1875)
    root, tables = work_dir(spark, "bench-rollup"), ("claim", "claim_detail")

    def apply(run, touched, batch):
        rm = roles.RoleMap(mix=mix, n_buckets=80000, touched=touched, hashed_buckets=True)
        for t in tables:
            ap.apply_batch(roles.changes(spark, SF_DIR, t, run, rm), batch, root, t, cdc.ApplySpec.for_table(CLAIMS[t]), CLAIMS[t].rules, CLAIMS[t].delete_predicate)

    apply(roles.SEED, 0.0, 0)
    for t in tables:
        ap.compact(spark, root, t, cdc.ApplySpec.for_table(CLAIMS[t]))
    before = publish.silver_versions(spark, root, tables)
    publish.rebuild_header_facts(spark, root, 0, before)
    known = {"sources": before, "version": ap.contents(spark, root, publish.FACT)["version"]}
    apply(roles.INCREMENT, ratio, 1)
    now = publish.silver_versions(spark, root, tables)
    incremental = measured(spark, "rollup incremental", lambda: publish.move_header_facts(spark, root, 1, known, now))
    full = measured(spark, "rollup full", lambda: publish.rebuild_header_facts(spark, root, 2, now))
    return {"change_ratio": ratio, "incremental_sec": round(incremental, 3), "full_sec": round(full, 3)}


def skew_experiment(spark):
    """Max/median rows per shuffle partition of an even and an 80%-hot increment, by merge key and by the hot attribute."""
    from tidewater.plans import roles, skew

    n, out = int(spark.conf.get("spark.sql.shuffle.partitions")), {}
    for scenario, hot in (("even", 0.0), ("hot", 0.8)):
        inc = roles.changes(spark, SF_DIR, "claim_detail", roles.INCREMENT, roles.RoleMap(hot_share=hot))
        for k in ("claim_detail_id", "provider_id"):
            r = skew.partition_profile(inc, [k], n).first()
            worst = r["max_over_median"]
            out[f"{scenario}:{k}"] = {
                "max_rows": int(r["max_rows"]),
                "median_rows": float(r["median_rows"]),
                "max_over_median": None if worst is None else round(float(worst), 2),
            }
    return out


def throughput(spark):
    """Rows per second from landed files to current state, for one change batch."""
    from tidewater.plans import roles
    from tidewater.session import work_dir
    from tidewater.streaming.runner import Runner

    runner = Runner(spark, work_dir(spark, "bench-throughput"))
    runner.land_roles(SF_DIR, roles.SEED, tables=("claim_detail",))
    n = runner.spark.read.option("recursiveFileLookup", "true").parquet(f"{runner.root}/landing/claim_detail").count()
    t0 = time.time()
    runner.step(("claim_detail",), with_twin=False)
    _run(runner.current("claim_detail"))
    dt = time.time() - t0
    return {"rows": int(n), "sec": round(dt, 3), "rows_per_sec": int(n / dt) if dt > 0 else None}


def main():
    import tempfile

    from tidewater.session import local_session

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, int(CPUS) * 2))))
    log = tempfile.mkdtemp(prefix="bench-events-")
    conf = {"enabled": "true", "dir": f"file://{log}", "rolling.enabled": "false", "compress": "false"}
    spark = local_session(CPUS, shuffle, "tidewater-bench", {f"spark.eventLog.{k}": v for k, v in conf.items()})
    t_all = time.time()
    q = time_queries(spark, HEADLINE)
    extra = {}
    for name, experiment in (("full_vs_incremental", ratio_experiment), ("rollup", rollup_experiment), ("skew_partitions", skew_experiment), ("bronze_to_current", throughput)):
        try:
            extra[name] = experiment(spark)
        except Exception as e:  # noqa: BLE001
            extra[f"{name}_error"] = str(e)[:300]
    wall = round(time.time() - t_all, 1)
    spark.stop()  # closes the event log
    touched = records(log)
    for r, row in extra.get("full_vs_incremental", {}).items():
        row |= {side: touched.get(f"{side} {r}", {}) for side in ("incremental", "full")}
        read = [row[side].get("records_read", 0) + row[side].get("records_written", 0) for side in ("full", "incremental")]
        row["row_ratio"] = round(read[0] / max(read[1], 1), 2)
    if "rollup" in extra:
        extra["rollup"] |= {side: touched.get(f"rollup {side}", {}) for side in ("incremental", "full")}
    if "0.01" in extra.get("full_vs_incremental", {}):
        extra["baseline_check"] = {
            "published": {"full_rows": 111_000_000, "incremental_rows": 1_400_000, "row_ratio": 78, "change_ratio": 0.013},
            "ours_at_1pct": extra["full_vs_incremental"]["0.01"]["row_ratio"],
        }
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(q.values()), 3),
        "unit": "sec",
        "queries": q,
        "sf": _sf_of(SF_DIR),
        "cpus": CPUS,
        "shuffle_partitions": shuffle,
        "wall_sec": wall,
        **extra,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
