"""Streaming flows on hand-written landings: twin drift, restart, NULL keys, drift rescue."""

import os
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.operators import cdc
from tidewater.plans import changes as ch
from tidewater.plans import gold, reconcile
from tidewater.session import work_dir
from tidewater.specs import CLAIMS, OPER_COL, RESCUE_COL, SEQ_COL, TS_COL
from tidewater.streaming import apply as ap
from tidewater.streaming.runner import Runner

TS = datetime(2024, 1, 1)


def header_rows(spark, data):
    df = spark.createDataFrame(
        data, f"claim_id STRING, claim_status STRING, total_charge_amount DECIMAL(12,2), service_from_date DATE, {OPER_COL} STRING, {SEQ_COL} BIGINT, {TS_COL} TIMESTAMP"
    )
    return ch.conform(df, CLAIMS["claim"])


def line_rows(spark, data):
    df = spark.createDataFrame(
        data, f"claim_detail_id STRING, claim_id STRING, paid_amount DECIMAL(12,2), {OPER_COL} STRING, {SEQ_COL} BIGINT, {TS_COL} TIMESTAMP"
    )
    return ch.conform(df, CLAIMS["claim_detail"])


def test_header_change_after_line_written_drifts_in_twin_only(spark):
    r = Runner(spark, work_dir(spark, "test-twin"))
    d = date(2024, 1, 5)
    r.land("claim", header_rows(spark, [("C1", "PAID", Decimal("10.00"), d, "I", 1, TS)]), "seed")
    r.land(
        "claim_detail",
        line_rows(spark, [("C1-1", "C1", Decimal("5.00"), "I", 1, TS), (None, "C1", Decimal("1.00"), "I", 1, TS)]),
        "seed",
    )
    r.step(("claim", "claim_detail"))
    r.land("claim", header_rows(spark, [("C1", "DENIED", Decimal("10.00"), d, "U", 2, TS)]), "incr0001")
    r.step(("claim", "claim_detail"))

    full = gold.fact_claim_line(r.current("claim_detail"), r.current("claim"))
    twin = r.twin_table()
    assert [x["claim_status"] for x in full.collect()] == ["DENIED"]
    assert [x["claim_status"] for x in twin.collect()] == ["PAID"]  # NULL-key line never reached the twin
    diff = reconcile.twin_reconcile(full, twin, "claim_detail_id", gold.HEADER_ORIGIN).collect()
    assert [(x["kind"], x["drift_columns"]) for x in diff] == [("header_drift", "claim_status")]
    # the drop rule counted the NULL key in the silver flow
    counts = {x["rule"]: x["failed_rows"] for x in ap.rule_counts(spark, r.root, "claim_detail").collect()}
    assert counts["valid_claim_detail_id"] == 1
    rejects = ap.read_rejects(spark, r.root, "claim_detail").collect()
    assert len(rejects) == 1 and list(rejects[0]["_failed_rules"]) == ["valid_claim_detail_id"]
    assert ap.read_rejects(spark, r.root, "claim") is None  # nothing dropped, nothing written


def test_restart_same_batch_twice_is_identical(spark):
    root = work_dir(spark, "test-restart")
    spec = cdc.ApplySpec.for_table(CLAIMS["claim"])
    batch = header_rows(spark, [("C1", "PAID", Decimal("1.00"), None, "I", 1, TS), ("C2", "PAID", Decimal("2.00"), None, "I", 1, TS)])
    ap.apply_batch(batch, 0, root, "claim", spec)
    once = sorted(tuple(x) for x in ap.current_state(spark, root, "claim", spec).collect())
    ap.apply_batch(batch, 0, root, "claim", spec)  # retried batch replaces its own folder
    twice = sorted(tuple(x) for x in ap.current_state(spark, root, "claim", spec).collect())
    assert once == twice and len(once) == 2


def test_streaming_restart_picks_up_only_new_files(spark):
    r = Runner(spark, work_dir(spark, "test-stream-restart"))
    r.land("claim", header_rows(spark, [("C1", "PAID", Decimal("1.00"), None, "I", 1, TS)]), "seed")
    r.step(("claim",), with_twin=False)
    r.step(("claim",), with_twin=False)  # nothing new: no change
    assert r.bronze("claim").count() == 1
    r.land("claim", header_rows(spark, [("C1", "DENIED", Decimal("1.00"), None, "U", 2, TS)]), "incr0001")
    r.step(("claim",), with_twin=False)
    assert r.bronze("claim").count() == 2
    assert [x["claim_status"] for x in r.current("claim").collect()] == ["DENIED"]


def test_rescue_keeps_mistyped_and_extra_columns(spark):
    r = Runner(spark, work_dir(spark, "test-rescue"))
    good = header_rows(spark, [("C1", "PAID", Decimal("1.00"), None, "I", 1, TS)])
    r.land("claim", good, "seed")
    bad = (
        header_rows(spark, [("C2", "PAID", Decimal("2.00"), None, "I", 1, TS), ("C3", "PAID", Decimal("3.00"), None, "I", 1, TS)])
        .withColumn("total_charge_amount", F.when(F.col("claim_id") == "C2", F.lit("lots")).otherwise(F.lit("3.00")))
        .withColumn("channel", F.lit("fax"))
    )
    r.land("claim", bad, "drift")
    r.ingest(("claim",))
    got = {x["claim_id"]: (x["total_charge_amount"], x[RESCUE_COL]) for x in r.bronze("claim").collect()}
    assert got["C1"] == (Decimal("1.00"), None)
    assert got["C2"] == (None, '{"total_charge_amount":"lots","channel":"fax"}')
    assert got["C3"] == (Decimal("3.00"), '{"channel":"fax"}')


def test_publish_gold_versions(spark):
    r = Runner(spark, work_dir(spark, "test-gold"))
    d = date(2024, 1, 5)
    r.land("claim", header_rows(spark, [("C1", "PAID", Decimal("10.00"), d, "I", 1, TS)]), "seed")
    r.land("claim_detail", line_rows(spark, [("C1-1", "C1", Decimal("5.00"), "I", 1, TS)]), "seed")
    r.step(("claim", "claim_detail"), with_twin=False)
    v0 = r.publish_gold(names=["fact_claim", "agg_claims_daily"])
    r.land("claim", header_rows(spark, [("C1", "REVERSED", Decimal("10.00"), d, "U", 2, TS)]), "incr0001")
    r.step(("claim", "claim_detail"), with_twin=False)
    v1 = r.publish_gold(names=["fact_claim", "agg_claims_daily"])
    assert (v0, v1) == (0, 1)
    assert [x["claim_status"] for x in r.read_gold("fact_claim").collect()] == ["REVERSED"]
    assert r.read_gold("agg_claims_daily").first()["reversal_rate"] == 1.0


def test_files_per_trigger_and_a_batch_done_twice(spark):
    from tidewater.streaming import ingest

    r = Runner(spark, work_dir(spark, "test-limit"), max_files_per_trigger=1)
    rows = header_rows(spark, [(f"C{i}", "PAID", Decimal("1.00"), None, "I", 1, TS) for i in range(40)])
    rows.repartition(4).write.parquet(ingest.landing_path(r.root, "claim", "seed"))
    r.ingest(("claim",))
    folders = [n for n in os.listdir(ingest.bronze_path(r.root, "claim").removeprefix("file:")) if n.startswith("batch_id=")]
    assert len(folders) == 4 and r.bronze("claim").count() == 40
    ingest.append_batch(r.bronze("claim"), r.root, "claim", 3)  # a retry of a batch that is in place
    assert r.bronze("claim").count() == 40


def test_control_row_drives_later_runs(spark, sf):
    r = Runner(spark, work_dir(spark, "test-runs"))
    seen = set()
    for _ in range(3):
        run = r.land_next_run(sf, tables=("claim",))
        landed = spark.read.parquet(f"{r.root}/landing/claim/{'seed' if not run else f'incr{run:04d}'}")
        new = {x["claim_id"] for x in landed.where("header__change_oper = 'I'").collect()}
        assert new and not new & seen
        seen |= new


def test_twin_is_compacted_with_its_lines(spark):
    r = Runner(spark, work_dir(spark, "test-twin-compact"))
    r.land("claim", header_rows(spark, [("C1", "PAID", Decimal("10.00"), date(2024, 1, 5), "I", 1, TS)]), "seed")
    r.land("claim_detail", line_rows(spark, [("C1-1", "C1", Decimal("5.00"), "I", 1, TS)]), "seed")
    r.step(("claim", "claim_detail"))
    before = r.twin_table().collect()
    assert any("fact_claim_line_streaming" in (p or "") for p in r.compact(("claim", "claim_detail")).values())
    assert r.twin_table().collect() == before


def test_refreshed_headers_leave_no_drift(spark):
    from tidewater.streaming import twin

    r = Runner(spark, work_dir(spark, "test-two-sided"))
    d = date(2024, 1, 5)
    r.land("claim", header_rows(spark, [(f"C{i}", "PAID", Decimal("10.00"), d, "I", 1, TS) for i in range(6)]), "seed")
    r.land("claim_detail", line_rows(spark, [(f"C{i}-{j}", f"C{i}", Decimal("5.00"), "I", 1, TS) for i in range(8) for j in range(2)]), "seed")
    r.step(("claim", "claim_detail"), refresh_headers=True)
    # headers alone: changed, deleted, new for lines that were there before
    r.land("claim", header_rows(spark, [("C1", "DENIED", Decimal("10.00"), d, "U", 2, TS), ("C2", None, None, None, "D", 2, TS), ("C7", "PAID", Decimal("1.00"), d, "I", 2, TS)]), "incr0001")
    r.step(("claim", "claim_detail"))

    def drift():
        full = gold.fact_claim_line(r.current("claim_detail"), r.current("claim"))
        return reconcile.twin_reconcile(full, r.twin_table(), "claim_detail_id", gold.HEADER_ORIGIN).count()

    assert drift() == 6
    assert twin.refresh_headers(spark, r.root) == 6 and drift() == 0
    assert twin.refresh_headers(spark, r.root) == 0
    # lines and headers together, a line that goes, then a compaction and a late header
    r.land("claim", header_rows(spark, [("C2", "PAID", Decimal("9.00"), d, "I", 3, TS), ("C3", "DENIED", Decimal("9.00"), d, "U", 3, TS)]), "incr0002")
    r.land("claim_detail", line_rows(spark, [("C3-0", "C3", Decimal("6.00"), "U", 3, TS), ("C1-1", None, None, "D", 3, TS), ("C4-0", "C5", Decimal("1.00"), "U", 3, TS)]), "incr0002")
    r.step(("claim", "claim_detail"), refresh_headers=True)
    assert drift() == 0
    r.compact(("claim", "claim_detail"))
    r.land("claim", header_rows(spark, [("C3", "PAID", Decimal("9.00"), d, "U", 2, TS), ("C5", "DENIED", Decimal("9.00"), d, "U", 4, TS)]), "incr0003")
    r.step(("claim", "claim_detail"), refresh_headers=True)
    assert drift() == 0 and r.twin_table().count() == 15
