"""State folders: snapshot + merge-on-read, keyed lookup, control row, small-input fan-out."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.operators import cdc
from tidewater.plans import changes as ch
from tidewater.session import work_dir
from tidewater.sources.control import advance_control, read_control
from tidewater.specs import CLAIMS, OPER_COL, SEQ_COL, TS_COL
from tidewater.streaming import apply as ap

TS = datetime(2024, 1, 1)


def headers(spark, data):
    df = spark.createDataFrame(
        data, f"claim_id STRING, claim_status STRING, total_charge_amount DECIMAL(12,2), {OPER_COL} STRING, {SEQ_COL} BIGINT, {TS_COL} TIMESTAMP"
    )
    return ch.conform(df, CLAIMS["claim"])


def as_set(df):
    return {(r["claim_id"], r["claim_status"]) for r in df.collect()}


def test_snapshot_plus_later_batches_equals_full_reduction(spark):
    root = work_dir(spark, "test-mor")
    spec = cdc.ApplySpec.for_table(CLAIMS["claim"])
    b0 = headers(spark, [(f"C{i}", "PAID", Decimal("1.00"), "I", 1, TS) for i in range(50)])
    b1 = headers(spark, [("C1", "DENIED", Decimal("1.00"), "U", 2, TS), ("C2", None, None, "D", 2, TS), ("C99", "SUBMITTED", Decimal("9.00"), "I", 2, TS)])
    b2 = headers(spark, [("C1", "ADJUSTED", Decimal("1.00"), "U", 1, TS), ("C2", "PAID", Decimal("1.00"), "U", 1, TS)])  # late, lower seq
    ap.apply_batch(b0, 0, root, "claim", spec)
    ap.apply_batch(b1, 1, root, "claim", spec)
    before = as_set(ap.current_state(spark, root, "claim", spec))
    snap = ap.compact(spark, root, "claim", spec)
    assert snap.endswith("upto=1") and ap.latest_snapshot(spark, root, "claim") == 1
    assert as_set(ap.current_state(spark, root, "claim", spec)) == before
    ap.apply_batch(b2, 2, root, "claim", spec)  # merged on read against the snapshot
    after = as_set(ap.current_state(spark, root, "claim", spec))
    full = as_set(cdc.apply_changes(b0.unionByName(b1).unionByName(b2), spec))
    assert after == full
    assert ("C1", "DENIED") in after and not any(k == "C2" for k, _ in after)  # tombstone survived compaction


def test_keyed_lookup_matches_full_state(spark):
    root = work_dir(spark, "test-keyed")
    spec = cdc.ApplySpec.for_table(CLAIMS["claim"])
    ap.apply_batch(headers(spark, [(f"C{i}", "PAID", Decimal("1.00"), "I", 1, TS) for i in range(20)]), 0, root, "claim", spec)
    ap.compact(spark, root, "claim", spec)
    ap.apply_batch(headers(spark, [("C3", "DENIED", Decimal("1.00"), "U", 2, TS)]), 1, root, "claim", spec)
    keys = spark.createDataFrame([("C3",), ("C4",), ("C3",)], "claim_id STRING")
    got = as_set(ap.current_state_for(spark, root, "claim", spec, keys))
    assert got == {("C3", "DENIED"), ("C4", "PAID")}


def test_control_row_versions(spark):
    root = work_dir(spark, "test-control")
    assert read_control(spark, root) is None
    advance_control(spark, root, 10, 10**12, 0)
    advance_control(spark, root, 25, 2 * 10**12, 1)
    c = read_control(spark, root)
    assert (c["max_claim_n"], c["seq_base"], c["run_index"]) == (25, 2 * 10**12, 1)


def test_reads_and_compaction_stop_before_a_failed_batch(spark):
    spec = cdc.ApplySpec.for_table(CLAIMS["claim"])
    root = work_dir(spark, "test-failed")
    ap.apply_batch(headers(spark, [("C1", "PAID", Decimal("1.00"), "I", 1, TS)]), 0, root, "claim", spec)
    retried = headers(spark, [("C2", "PAID", Decimal("1.00"), "I", 2, TS)])
    retried.write.parquet(f"{ap.state_path(root, 'claim')}/batch_id=1/_temporary/0")
    assert ap.batch_ids(spark, root, "claim") == [0]
    assert ap.compact(spark, root, "claim", spec).endswith("upto=0")
    ap.apply_batch(retried, 1, root, "claim", spec)
    ap.apply_batch(headers(spark, [("C1", "DENIED", Decimal("1.00"), "U", 3, TS)]), 2, root, "claim", spec)
    assert sorted((r["claim_id"], r["claim_status"]) for r in ap.current_state(spark, root, "claim", spec).collect()) == [("C1", "DENIED"), ("C2", "PAID")]
    asked = ap.current_state_for(spark, root, "claim", spec, spark.createDataFrame([("C2",), (None,), ("C9",)], "claim_id string"))
    assert [r["claim_id"] for r in asked.collect()] == ["C2"]


def test_merge_reduced_equals_a_full_reduction(spark):
    spec = cdc.ApplySpec(keys=("a", "b"), sequence_by=("s",), delete_when=None)
    schema = "a int, b string, s int, v string"
    base = spark.createDataFrame([(1, "x", 5, "old"), (None, "x", 5, "old"), (None, None, 5, "old"), (2, None, 5, "tie")], schema)
    delta = spark.createDataFrame([(1, "x", 4, "late"), (None, "x", 6, "new"), (None, None, 7, "new"), (2, None, 5, "tiz"), (3, "y", 1, "first")], schema)
    got = sorted(map(tuple, cdc.merge_reduced(base, delta, spec).collect()), key=str)
    assert got == sorted(map(tuple, cdc.reduce_changes(base.unionByName(delta), spec).collect()), key=str)


def test_no_shared_folder_is_an_error_off_local_masters():
    from types import SimpleNamespace

    import pytest

    from tidewater.session import checkpoint_dir

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: {})
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_runner_compacts_by_change_ratio(spark):
    from tidewater.streaming.runner import Runner

    r = Runner(spark, work_dir(spark, "test-strategy"))
    r.land("claim", headers(spark, [(f"C{i}", "PAID", Decimal("1.00"), "I", 1, TS) for i in range(100)]), "seed")
    r.step(("claim",), with_twin=False)
    assert r.maybe_compact(("claim",)) == {"claim": "full"}  # first snapshot
    r.land("claim", headers(spark, [("C1", "DENIED", Decimal("1.00"), "U", 2, TS)]), "incr0001")
    r.step(("claim",), with_twin=False)
    assert r.refresh_strategy("claim") == "incremental"  # 1% changed: keep merging on read
    r.land("claim", headers(spark, [(f"C{i}", "DENIED", Decimal("1.00"), "U", 3, TS) for i in range(40)]), "incr0002")
    r.step(("claim",), with_twin=False)
    assert r.maybe_compact(("claim",)) == {"claim": "full"}
    assert ap.latest_snapshot(spark, r.root, "claim") == 2
    assert sum(1 for x in r.current("claim").collect() if x["claim_status"] == "DENIED") == 40


def test_recommended_conf_scales_with_input():
    from tidewater.session import recommended_conf

    big = int(recommended_conf(100 * 2**40, 8000)["spark.sql.shuffle.partitions"])
    small = int(recommended_conf(10 * 2**20, 8)["spark.sql.shuffle.partitions"])
    assert big == 100 * 2**40 // 2**30 + 1  # ~100k partitions of 1 GiB for 100 TB
    assert small == 16  # two waves on 8 cores


def test_command_line_workflow(spark, sf):
    from tidewater.__main__ import main

    root = work_dir(spark, "test-cli")
    assert main(["land", "--root", root, "--source", sf, "--tables", "claim,claim_detail"], spark)["run"] == 0
    main(["step", "--root", root, "--tables", "claim,claim_detail"], spark)
    assert main(["land", "--root", root, "--source", sf, "--tables", "claim,claim_detail"], spark)["run"] == 1
    main(["step", "--root", root, "--tables", "claim,claim_detail"], spark)
    status = main(["status", "--root", root], spark)
    orders = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert status["live_rows"]["claim"] == orders and status["control"]["run_index"] == "1"
    assert main(["compact", "--root", root, "--force", "--tables", "claim"], spark)["snapshots"]["claim"]


def test_tombstone_expiry_is_explicit(spark):
    spec = cdc.ApplySpec.for_table(CLAIMS["claim"])
    root = work_dir(spark, "test-expiry")
    ap.apply_batch(headers(spark, [("C1", "PAID", Decimal("1.00"), "I", 1, TS), ("C2", "PAID", Decimal("1.00"), "I", 1, TS)]), 0, root, "claim", spec)
    ap.apply_batch(headers(spark, [("C1", None, None, "D", 5, TS)]), 1, root, "claim", spec)
    kept = spark.read.parquet(ap.compact(spark, root, "claim", spec))
    assert kept.count() == 2  # default: the tombstone stays
    ap.apply_batch(headers(spark, [("C3", "PAID", Decimal("1.00"), "I", 6, TS)]), 2, root, "claim", spec)
    snap = spark.read.parquet(ap.compact(spark, root, "claim", spec, expire_tombstones_below=10))
    assert sorted(r["claim_id"] for r in snap.collect()) == ["C2", "C3"]


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") + df._jdf.queryExecution().executedPlan().toString().count("Exchange rangepartitioning")


def test_a_winner_carries_each_column_once_and_no_provenance(spark):
    """What a reduction shuffles: order columns are not repeated, and the ingest columns stay in the bronze log."""
    import re

    from tidewater.specs import INGEST_COLUMNS
    from tidewater.streaming import ingest, twin

    spec = CLAIMS["claim_detail"]
    rows = spark.createDataFrame([], ingest.bronze_schema(spec))
    reduced = cdc.reduce_changes(rows, cdc.ApplySpec.for_table(spec))
    assert not set(INGEST_COLUMNS) & set(reduced.columns)
    assert reduced.columns == spec.all_columns
    fields = re.search(r"max\(struct\((.*)\)\) AS __win", reduced._jdf.queryExecution().analyzed().toString()).group(1)
    assert fields.count(f"{SEQ_COL}#") == fields.count(f"{TS_COL}#") == 1
    head = spark.createDataFrame([], CLAIMS["claim"].business_schema())
    joined = twin.line_changes_with_header(rows, head)
    assert not any(t.startswith("struct") for _, t in joined.dtypes)
    assert len(joined.columns) == len(set(joined.columns)) and not set(INGEST_COLUMNS) & set(joined.columns)


def test_reduction_keeps_the_order_of_changes(spark):
    """Order columns first, then the rest as they stand, whether an order column is named twice, is a key or comes last."""
    df = spark.createDataFrame([("k", 9, "a", 1), ("k", 0, "b", 2), ("k", 5, "b", 2), (None, 1, "z", 0)], "k string, v int, t string, s int")
    got = cdc.latest_by_key(df, ["k"], ["s", "t", "s", "k", F.col("v") * 0])
    assert got.columns == ["k", "v", "t", "s"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("k", 5, "b", 2), (None, 1, "z", 0)], key=str)


def test_merge_and_first_snapshot_shuffle_the_batches_once(spark):
    """Batches are reduced where their buckets are: one Exchange on the key text, none on the stored side."""
    from tidewater.sources import buckets

    spec, root = cdc.ApplySpec.for_table(CLAIMS["claim"]), work_dir(spark, "test-once")
    ap.apply_batch(headers(spark, [(f"C{i}", "PAID", Decimal("1.00"), "I", 1, TS) for i in range(50)]), 0, root, "claim", spec)
    table = ap.contents(spark, root, "claim")
    rows = ap._reduced_in_buckets(ap.read_state(spark, root, "claim"), spec, ap.layout_of(table))
    assert _exchanges(rows) == 1 and buckets.KEY in rows.columns
    assert rows.rdd.getNumPartitions() == table["layout"][0]
    ap.compact(spark, root, "claim", spec)
    ap.apply_batch(headers(spark, [(f"C{i}", "DENIED", Decimal("2.00"), "U", 2, TS) for i in range(25, 75)]), 1, root, "claim", spec)
    assert _exchanges(ap._merged(spark, root, "claim", spec, ap.contents(spark, root, "claim"))) == 1
    ap.compact(spark, root, "claim", spec)
    got = {r["claim_id"]: r["claim_status"] for r in ap.current_state(spark, root, "claim", spec).collect()}
    assert got == {f"C{i}": "DENIED" if i >= 25 else "PAID" for i in range(75)}


def test_a_runner_frees_shuffle_files_unless_told_otherwise(spark):
    from tidewater.session import RUNNER_CONF
    from tidewater.streaming.runner import Runner

    (name, wanted), = RUNNER_CONF.items()
    spark.conf.unset(name)
    Runner(spark, work_dir(spark, "test-conf"))
    assert spark.conf.get(name) == wanted
    spark.conf.set(name, "false")
    Runner(spark, work_dir(spark, "test-conf"))
    assert spark.conf.get(name) == "false"
    spark.conf.unset(name)


def test_layers_write_a_dense_codec(spark):
    import glob

    root = work_dir(spark, "test-codec")
    ap.apply_batch(headers(spark, [("C1", "PAID", Decimal("1.00"), "I", 1, TS)]), 0, root, "claim", cdc.ApplySpec.for_table(CLAIMS["claim"]))
    files = glob.glob(ap.state_path(root, "claim").removeprefix("file:") + "/batch_id=0/*.parquet")
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_first_snapshot_gets_the_buckets_its_size_needs(spark, monkeypatch):
    from tidewater.sources import buckets

    spec, root = cdc.ApplySpec.for_table(CLAIMS["claim"]), work_dir(spark, "test-grown")
    ap.apply_batch(headers(spark, [(f"C{i}", "PAID", Decimal("1.00"), "I", 1, TS) for i in range(300)]), 0, root, "claim", spec)
    size = ap.contents(spark, root, "claim")["batches"][0]["bytes"]
    monkeypatch.setattr(buckets, "SORTED_BYTES", size // 40)
    ap.compact(spark, root, "claim", spec)
    n, slots = ap.contents(spark, root, "claim")["layout"]
    assert n >= 40 and slots == 8 and n % slots == 0
    ap.apply_batch(headers(spark, [(f"C{i}", "DENIED", Decimal("2.00"), "U", 2, TS) for i in range(290, 310)]), 1, root, "claim", spec)
    assert _exchanges(ap._merged(spark, root, "claim", spec, ap.contents(spark, root, "claim"))) == 1
    ap.compact(spark, root, "claim", spec)
    got = {r["claim_id"]: r["claim_status"] for r in ap.current_state(spark, root, "claim", spec).collect()}
    assert got == {f"C{i}": "DENIED" if i >= 290 else "PAID" for i in range(310)}
    assert ap.current_state_for(spark, root, "claim", spec, spark.createDataFrame([("C5",), ("C305",)], "claim_id string")).count() == 2
