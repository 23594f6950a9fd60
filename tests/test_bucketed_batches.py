"""Batches that are large enough lie in the buckets of their key: nothing shuffles them again, and the rows are the same."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater import queries as Q
from tidewater.operators import cdc
from tidewater.session import work_dir
from tidewater.sources import buckets
from tidewater.streaming import apply as ap
from tidewater.streaming import feed

RULE = cdc.ApplySpec(keys=("k",), sequence_by=("s",), delete_when="v = 'gone'")


@pytest.fixture
def all_large(monkeypatch):
    monkeypatch.setattr(ap, "BUCKETED_BYTES", 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("== Initial Plan ==") :] if "== Initial Plan ==" in plan else plan
    return plan.count("Exchange hashpartitioning")


def from_file(spark, tmp_path, data, schema, name):
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/{name}")


def batches(seed, n=3, size=80):
    pick = random.Random(seed)
    keys = [f"K{i}" for i in range(30)] + ["=", "~", "", None]
    return [[(pick.choice(keys), pick.randrange(5), pick.choice(["a", "b", "gone", None])) for _ in range(size)] for _ in range(n)]


def test_batches_in_buckets_are_not_shuffled_again(spark, tmp_path, all_large):
    root, schema = work_dir(spark, "test-in-buckets"), "k string, s int, v string"
    data = batches(1)
    for i in (0, 1):
        ap.apply_batch(from_file(spark, tmp_path, data[i], schema, i), i, root, "t", RULE)
    table = ap.contents(spark, root, "t")
    assert [b["buckets"] for b in table["batches"]] == [table["layout"][0]] * 2
    assert [b["rows"] for b in table["batches"]] == [len({k for k, _, _ in d}) for d in data[:2]]
    whole = cdc.reduce_changes(spark.createDataFrame(data[0] + data[1], schema), RULE)
    state = ap.reduced_state(spark, root, "t", RULE)
    assert state.columns == ["k", "s", "v"] and exchanges(state) == 0 and rows(state) == rows(whole)
    assert rows(ap.read_state(spark, root, "t", after=0)) == rows(cdc.reduce_changes(spark.createDataFrame(data[1], schema), RULE))
    ap.compact(spark, root, "t", RULE)
    assert rows(ap.reduced_state(spark, root, "t", RULE)) == rows(whole)
    ap.apply_batch(from_file(spark, tmp_path, data[2], schema, 2), 2, root, "t", RULE)
    assert exchanges(ap._merged(spark, root, "t", RULE, ap.contents(spark, root, "t"))) == 0
    whole = cdc.reduce_changes(spark.createDataFrame(sum(data, []), schema), RULE)
    assert rows(ap.reduced_state(spark, root, "t", RULE)) == rows(whole)
    ap.compact(spark, root, "t", RULE)
    assert rows(ap.reduced_state(spark, root, "t", RULE)) == rows(whole)


def test_large_and_small_batches_together(spark, tmp_path, monkeypatch):
    root, schema, data = work_dir(spark, "test-mixed"), "k string, s int, v string", batches(2)
    for i, least in enumerate((1, 2**40, 1)):
        monkeypatch.setattr(ap, "BUCKETED_BYTES", least)
        ap.apply_batch(from_file(spark, tmp_path, data[i], schema, i), i, root, "t", RULE)
    assert ["buckets" in b for b in ap.contents(spark, root, "t")["batches"]] == [True, False, True]
    whole = cdc.reduce_changes(spark.createDataFrame(sum(data, []), schema), RULE)
    assert rows(ap.reduced_state(spark, root, "t", RULE)) == rows(whole)
    ap.compact(spark, root, "t", RULE)
    assert rows(ap.reduced_state(spark, root, "t", RULE)) == rows(whole)


def test_lookups_in_batches_in_buckets(spark, tmp_path, all_large, monkeypatch):
    root, schema, data = work_dir(spark, "test-asked"), "k string, s int, v string", batches(3)
    for i in (0, 1):
        ap.apply_batch(from_file(spark, tmp_path, data[i], schema, i), i, root, "t", RULE)
    keys = spark.createDataFrame([(f"K{i % 10}",) for i in range(20)] + [(None,), ("~",)], "k string")
    wanted = [r for r in rows(cdc.reduce_changes(spark.createDataFrame(data[0] + data[1], schema), RULE)) if r[0] in {f"K{i}" for i in range(10)} | {None, "~"}]
    for listed in (2000, 3):
        monkeypatch.setattr(ap, "LISTED_KEYS", listed)
        assert rows(ap.reduced_state_for(spark, root, "t", RULE, keys)) == wanted
    changed = feed.change_feed(spark, root, "t", RULE, 0)
    assert changed.columns == ["k", "oper", "before", "after"] and changed.count() > 0


def test_keys_of_several_parts_and_zeros(spark, tmp_path, all_large):
    rule = cdc.ApplySpec(keys=("d", "n"), sequence_by=("s",), tie_break=(F.col("n") * 0,), delete_when=None)
    schema = "d double, n int, s int, v string"
    data = [[(0.0, 1, 1, "a"), (-0.0, 1, 2, "b"), (None, 1, 1, "c"), (None, None, 1, "d")], [(0.0, 1, 3, "e"), (None, 1, 0, "late"), (1.5, 2, 1, "f")]]
    root = work_dir(spark, "test-parts")
    for i in (0, 1):
        ap.apply_batch(from_file(spark, tmp_path, data[i], schema, i), i, root, "t", rule)
    state = ap.reduced_state(spark, root, "t", rule)
    assert exchanges(state) == 0
    assert rows(state) == rows(cdc.reduce_changes(spark.createDataFrame(data[0] + data[1], schema), rule))


def test_an_order_may_use_the_key_itself(spark, tmp_path, all_large):
    rule = cdc.ApplySpec(keys=("k",), sequence_by=(F.length("k"), "s"), delete_when=None)
    batch = from_file(spark, tmp_path, [("x", 1, "a"), ("x", 2, "b"), (None, 1, "c")], "k string, s int, v string", "own")
    assert rows(ap.reduced_by_text(batch, rule).drop(buckets.KEY)) == rows(cdc.reduce_changes(batch, rule))


def test_a_hot_key_is_folded_before_the_shuffle(spark, tmp_path, all_large):
    batch = from_file(spark, tmp_path, [("hot", i, "v") for i in range(50)], "k string, s int, v string", "hot")
    plan = ap.reduced_by_text(batch, RULE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(__k") == 1 and "partial_max" in plan[plan.index("Exchange hashpartitioning") :]


def test_a_batch_in_passes_is_the_same_batch(spark, tmp_path, all_large, monkeypatch):
    """A large batch shuffles a share of its keys at a time; rows, counts, rejects and reads are those of one pass."""
    from tidewater.specs import Rule

    schema, data = "k string, s int, v string", batches(4)
    rules = (Rule("has_v", "v IS NOT NULL", "drop", applies_to_deletes=True), Rule("late", "s > 1", "warn"))
    held = []
    for share in (2**40, 1):
        monkeypatch.setattr(ap, "PASS_BYTES", share)
        root = work_dir(spark, "test-passes")
        shuffles = []
        plain = buckets.write_batch
        monkeypatch.setattr(buckets, "write_batch", lambda df, path, to: shuffles.append(path) or plain(df, path, to))
        failed = [ap.apply_batch(from_file(spark, tmp_path, data[i], schema, f"{share}-{i}"), i, root, "t", RULE, rules, RULE.delete_when, watch=("v",)) for i in (0, 1)]
        monkeypatch.setattr(buckets, "write_batch", plain)
        table = ap.contents(spark, root, "t")
        assert len(shuffles) == (2 if share > 1 else 2 * table["layout"][0])
        assert exchanges(ap.reduced_state(spark, root, "t", RULE)) == 0
        rejects = ap.read_rejects(spark, root, "t").count()
        state, keys = rows(ap.reduced_state(spark, root, "t", RULE)), rows(feed.touched_keys(spark, root, "t", RULE, None, 1))
        ap.compact(spark, root, "t", RULE)
        held.append((failed, rejects, state, keys, table["rules"], table["hot"], [(b["rows"], b["slots"]) for b in table["batches"]], rows(ap.reduced_state(spark, root, "t", RULE))))
    assert held[0] == held[1] and held[0][2] == held[0][7]


def test_a_failed_write_is_replaced(spark, tmp_path, all_large):
    root, schema = work_dir(spark, "test-replaced"), "k string, s int, v string"
    batch = from_file(spark, tmp_path, [("a", 1, "x")], schema, "b")
    spark.createDataFrame([("b", 1, "left")], schema).write.parquet(f"{ap.state_path(root, 't')}/batch_id=0")
    ap.apply_batch(batch, 0, root, "t", RULE)
    assert rows(ap.current_state(spark, root, "t", RULE)) == [("a", 1, "x")]


def test_an_empty_batch_and_a_layout_for_the_size(spark, tmp_path, all_large):
    root = work_dir(spark, "test-size")
    assert ap.batch_layout(None, buckets.Layout(), 0) is None
    assert ap.batch_layout(None, buckets.Layout(), 100 * buckets.SORTED_BYTES).buckets >= 200
    empty = from_file(spark, tmp_path, [("a", 1, "x")], "k string, s int, v string", "e").where("s > 5")
    ap.apply_batch(empty, 0, root, "t", RULE)
    assert rows(ap.current_state(spark, root, "t", RULE)) == []


def test_two_sided_twin_of_large_batches_equals_the_full_build(spark, sf, all_large):
    twin, full = Q.fact_line_two_sided(spark, sf), Q.fact_line(spark, sf)
    assert rows(twin) == rows(full.select(*twin.columns))


def test_refresh_shuffles_keys_and_header_columns_only(spark, sf, all_large, monkeypatch):
    """The lines of changed headers stay in the buckets that they are stored in."""
    written = []
    plain = ap.append_reduced

    def seen(spark, root, name, batch_id, reduced, *args, **kw):
        if kw.get("marks") and not batch_id % 1_000_000 == 0:
            plan = reduced._jdf.queryExecution().executedPlan().toString()
            written.append([line for line in plan.splitlines() if "Exchange hashpartitioning(__k" in line])
        return plain(spark, root, name, batch_id, reduced, *args, **kw)

    monkeypatch.setattr(ap, "append_reduced", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        Q.fact_line_two_sided(spark, sf)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert written and all(len(lines) == 1 for lines in written)  # what the headers say, on its way back
