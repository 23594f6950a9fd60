"""Keyed change apply: the hand-written cases and the order-independence property."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewater.operators import cdc, quality
from tidewater.specs import Rule, TableSpec

SCHEMA = "k STRING, v STRING, amt INT, header__change_oper STRING, header__change_seq BIGINT, header__change_ts TIMESTAMP"
TS = datetime(2024, 1, 1)

SPEC = TableSpec(
    name="t",
    keys=("k",),
    columns=(("k", "STRING"), ("v", "STRING"), ("amt", "INT")),
    rules=(Rule("amt_non_negative", "amt >= 0", "warn"), Rule("valid_k", "k IS NOT NULL", "drop", applies_to_deletes=True)),
)


def apply_spec():
    return cdc.ApplySpec.for_table(SPEC)


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def current(spark, *batches):
    """Reduce each batch on its own, then reduce the union: the streaming path."""
    reduced = [cdc.reduce_changes(rows(spark, b), apply_spec()) for b in batches]
    union = reduced[0]
    for r in reduced[1:]:
        union = union.unionByName(r)
    out = cdc.live_rows(cdc.reduce_changes(union, apply_spec()), apply_spec())
    return {r["k"]: (r["v"], r["amt"]) for r in out.collect()}


def test_out_of_order_within_batch(spark):
    got = current(spark, [("k1", "new", 5, "U", 5, TS), ("k1", "old", 3, "I", 3, TS)])
    assert got == {"k1": ("new", 5)}


def test_late_update_after_delete_stays_deleted(spark):
    got = current(spark, [("k2", None, None, "D", 9, TS)], [("k2", "late", 1, "U", 8, TS)])
    assert got == {}


def test_reinsert_after_delete(spark):
    got = current(spark, [("k3", None, None, "D", 9, TS)], [("k3", "back", 1, "I", 10, TS)])
    assert got == {"k3": ("back", 1)}


def test_delete_of_unknown_key_keeps_tombstone(spark):
    log = rows(spark, [("k4", None, None, "D", 1, TS)])
    assert cdc.apply_changes(log, apply_spec()).count() == 0
    assert [r["k"] for r in cdc.tombstones(log, apply_spec()).collect()] == ["k4"]


def test_update_of_unknown_key_inserts(spark):
    assert current(spark, [("k5", "u", 1, "U", 1, TS)]) == {"k5": ("u", 1)}


def test_exact_duplicate_applied_once(spark):
    r = ("k6", "x", 1, "I", 1, TS)
    out = cdc.apply_changes(rows(spark, [r, r]), apply_spec())
    assert out.count() == 1


def test_same_seq_tie_is_deterministic(spark):
    a = ("k7", "a", 1, "U", 4, TS)
    b = ("k7", "b", 2, "U", 4, TS)
    first = current(spark, [a, b])
    second = current(spark, [b], [a])
    assert first == second == {"k7": ("b", 2)}  # remaining columns decide: 'b' > 'a'


def test_delete_wins_a_sequence_tie(spark):
    got = current(spark, [("k8", "u", 1, "U", 4, TS), ("k8", None, None, "D", 4, TS)])
    assert got == {}


def test_later_change_timestamp_wins_a_sequence_tie(spark):
    later = datetime(2024, 1, 2)
    got = current(spark, [("k9", "late", 1, "U", 4, later), ("k9", "early", 9, "U", 4, TS)])
    assert got == {"k9": ("late", 1)}


def test_null_in_update_overwrites(spark):
    got = current(spark, [("k10", "x", 1, "I", 1, TS)], [("k10", None, 2, "U", 2, TS)])
    assert got == {"k10": (None, 2)}


def test_null_key_dropped_and_counted(spark):
    log = rows(spark, [(None, "x", 1, "I", 1, TS), ("k11", "y", 1, "I", 1, TS)])
    q = quality.check(log, SPEC.rules, SPEC.delete_predicate)
    assert q.kept.count() == 1
    rej = q.rejects.collect()
    assert len(rej) == 1 and list(rej[0][quality.REJECT_RULES_COL]) == ["valid_k"]
    counts = {r["rule"]: r["failed_rows"] for r in q.metrics.collect()}
    assert counts == {"amt_non_negative": 0, "valid_k": 1}


def test_reversal_row_not_a_warn_failure_and_negative_amount_warns(spark):
    log = rows(spark, [("k12", None, None, "D", 2, TS), ("k13", "neg", -1, "I", 1, TS)])
    counts = {r["rule"]: r["failed_rows"] for r in quality.rule_metrics(log, SPEC.rules, SPEC.delete_predicate).collect()}
    assert counts["amt_non_negative"] == 1  # only the negative amount; the delete is exempt
    q = quality.check(log, SPEC.rules, SPEC.delete_predicate)
    assert q.kept.count() == 2  # warn keeps the row


def test_order_independence_property(spark):
    """Any split into batches and any arrival order give the same table."""
    rnd = random.Random(7)
    log = []
    for i in range(300):
        k = f"k{rnd.randrange(25)}"
        op = rnd.choice("IUUD")
        seq = rnd.randrange(40)
        log.append((k, None if op == "D" else f"v{rnd.randrange(5)}", None if op == "D" else rnd.randrange(-2, 9), op, seq, TS))
    expected = current(spark, log)
    for trial in range(3):
        shuffled = log[:]
        rnd.shuffle(shuffled)
        cuts = sorted(rnd.sample(range(1, len(log)), 3))
        batches = [shuffled[a:b] for a, b in zip([0] + cuts, cuts + [len(log)])]
        assert current(spark, *batches) == expected, f"trial {trial}"


def test_replay_equals_streaming_reduction_with_doubled_state(spark):
    """The reduction is idempotent: every state row doubled gives the same table."""
    data = [("a", "1", 1, "I", 1, TS), ("a", "2", 2, "U", 2, TS), ("b", "x", 1, "I", 1, TS), ("b", None, None, "D", 3, TS)]
    red = cdc.reduce_changes(rows(spark, data), apply_spec())
    doubled = cdc.live_rows(cdc.reduce_changes(red.unionByName(red), apply_spec()), apply_spec())
    assert {r["k"] for r in doubled.collect()} == {"a"}


def test_composite_keys(spark):
    df = spark.createDataFrame(
        [(1, 1, 5, "x"), (1, 1, 7, "y"), (1, 2, 1, "z")], "a INT, b INT, s INT, v STRING"
    )
    spec = cdc.ApplySpec(keys=("a", "b"), sequence_by=("s",), delete_when=None)
    got = {(r["a"], r["b"]): r["v"] for r in cdc.apply_changes(df, spec).collect()}
    assert got == {(1, 1): "y", (1, 2): "z"}


def test_hot_key_reduces_map_side(spark):
    """A third of all rows on one key: the plan folds it before the shuffle (partial aggregate)."""
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("s"),
    )
    spec = cdc.ApplySpec(keys=("k",), sequence_by=("s",), delete_when=None)
    out = cdc.apply_changes(df, spec)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert out.where("k = 'hot'").first()["s"] == 2997


@pytest.mark.parametrize("bad", ["no_tombstone"])
def test_mutation_dropping_tombstones_early_breaks_late_update(spark, bad):
    """If batches dropped their deletes, a late lower-sequenced update would resurrect the key."""
    b1 = rows(spark, [("m", None, None, "D", 9, TS)])
    b2 = rows(spark, [("m", "late", 1, "U", 8, TS)])
    wrong = cdc.live_rows(cdc.reduce_changes(b1, apply_spec()), apply_spec())  # tombstone dropped
    resurrected = cdc.live_rows(cdc.reduce_changes(wrong.unionByName(b2, allowMissingColumns=True), apply_spec()), apply_spec())
    assert resurrected.count() == 1  # the defect the design avoids
    assert current(spark, [("m", None, None, "D", 9, TS)], [("m", "late", 1, "U", 8, TS)]) == {}
