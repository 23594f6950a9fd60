"""Bucketed storage, manifests, retention, stored history and the change feed."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F


from tidewater.operators import cdc
from tidewater.session import work_dir
from tidewater.sources import buckets, files
from tidewater.sources.buckets import Layout
from tidewater.sources.manifest import Conflict, Manifest
from tidewater.sources.tables import write_table
from tidewater.streaming import apply as ap
from tidewater.streaming import feed, history

RULE = cdc.ApplySpec(keys=("k",), sequence_by=("s",), delete_when="v = 'gone'")
SCHEMA = "k string, s int, v string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def values(df):
    return sorted(map(tuple, df.select("k", "s", "v").collect()), key=str)


def filled(spark, n=200, layout=Layout(16, 8)):
    root = work_dir(spark, "test-storage")
    ap.apply_batch(rows(spark, [(f"K{i}", 1, "first") for i in range(n)]), 0, root, "t", RULE, layout=layout)
    return root


def test_manifest_versions_and_conflicts(spark):
    m = Manifest(spark, work_dir(spark, "test-manifest"))
    assert m.latest() is None
    first = m.commit({"a": 1}, None)
    second = m.commit({"a": 2}, first)
    assert m.latest()["a"] == 2 and m.at(0)["a"] == 1 and m.versions() == [0, 1]
    with pytest.raises(Conflict):
        m.commit({"a": 3}, first)
    assert m.latest()["commit"] == second["commit"]
    assert sorted(n for n in files.children(spark, m.path) if n.endswith(".json")) == ["000000000000.json", "000000000001.json"]


def test_key_text_is_total_and_one_to_one(spark):
    data = [(None, None), ("", ""), ("~", None), ("=", ","), ("a,", "b"), ("a", ",b"), ("a\\", ",b"), ("a\\,", "b"), (None, "a"), ("a", None)]
    df = spark.createDataFrame(data, "a string, b string")
    texts = [r[0] for r in df.select(buckets.key_text(df, ["a", "b"])).collect()]
    assert None not in texts and len(set(texts)) == len(data)
    numbers = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "x double")
    assert len({r[0] for r in numbers.select(buckets.key_text(numbers, ["x"])).collect()}) == 2


def test_only_touched_slots_are_rewritten_and_the_rest_is_carried_over(spark):
    root = filled(spark)
    ap.compact(spark, root, "t", RULE)
    before = ap.contents(spark, root, "t")
    ap.apply_batch(rows(spark, [("K7", 2, "second"), ("K7", 1, "late")]), 1, root, "t", RULE)
    touched = ap.contents(spark, root, "t")["batches"][0]["slots"]
    assert len(touched) == 1
    out = ap.compact(spark, root, "t", RULE)
    after = ap.contents(spark, root, "t")
    changed = {s for s in after["slots"] if after["slots"][s]["folder"] != before["slots"][s]["folder"]}
    assert changed == {str(touched[0])} and after["slots"].keys() == before["slots"].keys()
    assert files.children(spark, out) and ap.snapshot_rows(after) == 200
    assert ("K7", 2, "second") in values(ap.current_state(spark, root, "t", RULE))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_does_not_shuffle_or_sort_the_stored_side(spark):
    root = filled(spark)
    ap.compact(spark, root, "t", RULE)
    ap.apply_batch(rows(spark, [(f"K{i}", 2, "second") for i in range(50)]), 1, root, "t", RULE)
    table = ap.contents(spark, root, "t")
    text = plan(ap._merged(spark, root, "t", RULE, table))
    join = next(i for i, line in enumerate(text.splitlines()) if "FullOuter" in line)
    lines = text.splitlines()
    left = [line for line in lines[join + 1 :] if ":" in line.split("FileScan")[0] or "FileScan" in line]
    first_scan = next(line for line in lines[join + 1 :] if "FileScan" in line)
    between = lines[join + 1 : lines.index(first_scan)]
    assert left and "Bucketed: true" in first_scan and not any("Exchange" in line or "Sort " in line for line in between)
    # a delta too large to be hashed is sorted on both sides, still without a shuffle of the base
    big = plan(ap.merge_on_read(ap.stored_rows(spark, table), ap.read_state(spark, root, "t", after=0), RULE, small=False))
    assert big.count("Exchange hashpartitioning(__k") == 1


def test_random_batches_equal_one_reduction(spark):
    r, root, log = random.Random(4), work_dir(spark, "test-random"), []
    for batch in range(7):
        data = [(r.choice([f"K{i}" for i in range(40)] + [None]), r.randrange(12), r.choice(["a", "b", "gone"])) for _ in range(30)]
        log += data
        ap.apply_batch(rows(spark, data), batch, root, "t", RULE, layout=Layout(4, 4))
        if batch in (1, 4):
            ap.compact(spark, root, "t", RULE)
    assert values(ap.current_state(spark, root, "t", RULE)) == values(cdc.apply_changes(rows(spark, log), RULE))
    ap.compact(spark, root, "t", RULE, layout=Layout(8, 2))  # other buckets, same rows
    assert ap.contents(spark, root, "t")["layout"] == [8, 2]
    assert values(ap.current_state(spark, root, "t", RULE)) == values(cdc.apply_changes(rows(spark, log), RULE))
    some = spark.createDataFrame([("K1",), ("K2",), (None,), ("nobody",)], "k string")
    whole = [v for v in values(ap.current_state(spark, root, "t", RULE)) if v[0] in ("K1", "K2", None)]
    assert values(ap.current_state_for(spark, root, "t", RULE, some)) == whole


def test_lookup_by_range_equals_lookup_by_list(spark, monkeypatch):
    root = filled(spark)
    ap.compact(spark, root, "t", RULE)
    ap.apply_batch(rows(spark, [("K3", 2, "gone"), ("K4", 2, "x")]), 1, root, "t", RULE)
    keys = spark.createDataFrame([(f"K{i}",) for i in range(0, 60, 2)] + [("K3",)], "k string")
    listed = values(ap.current_state_for(spark, root, "t", RULE, keys))
    monkeypatch.setattr(ap, "LISTED_KEYS", 5)
    assert values(ap.current_state_for(spark, root, "t", RULE, keys)) == listed and len(listed) == 30


def test_a_batch_in_the_manifest_is_not_applied_again(spark):
    root = filled(spark, 5)
    version = ap.contents(spark, root, "t")["version"]
    ap.apply_batch(rows(spark, [("K1", 9, "other content")]), 0, root, "t", RULE)
    assert ap.contents(spark, root, "t")["version"] == version
    ap.compact(spark, root, "t", RULE)
    ap.apply_batch(rows(spark, [("K1", 9, "other content")]), 0, root, "t", RULE)  # folded, known all the same
    assert ("K1", 1, "first") in values(ap.current_state(spark, root, "t", RULE))


def test_fifty_batches_are_one_listing_and_expire(spark, monkeypatch):
    root = work_dir(spark, "test-fifty")
    for b in range(50):
        ap.append_reduced(spark, root, "t", b, rows(spark, [(f"K{b % 7}", b, "v")]).coalesce(1), RULE)
    listings = []
    plain = files.children
    monkeypatch.setattr(files, "children", lambda s, p: listings.append(p) or plain(s, p))
    state = ap.reduced_state(spark, root, "t", RULE)
    assert listings == [f"{root}/manifest/t"]
    assert sorted(r["s"] for r in state.collect()) == list(range(43, 50))
    ap.compact(spark, root, "t", RULE)
    assert ap.expire(spark, root, "t", older_than_seconds=3600) == {"versions": 0, "batches": 0, "folders": 0}
    gone = ap.expire(spark, root, "t", older_than_seconds=-1)
    assert gone["batches"] == 50 and gone["versions"] == 50
    assert not [n for n in plain(spark, ap.state_path(root, "t")) if n.startswith("batch_id=")]
    assert sorted(r["s"] for r in ap.reduced_state(spark, root, "t", RULE).collect()) == list(range(43, 50))
    assert len(Manifest(spark, f"{root}/manifest/t").versions()) == 1


def test_expiry_removes_replaced_slots_only(spark):
    root = filled(spark)
    ap.compact(spark, root, "t", RULE)
    ap.apply_batch(rows(spark, [("K7", 2, "second")]), 1, root, "t", RULE)
    ap.compact(spark, root, "t", RULE)
    assert ap.expire(spark, root, "t", older_than_seconds=-1)["folders"] == 1
    assert ap.current_state(spark, root, "t", RULE).count() == 200


def test_reads_as_of_a_version(spark):
    root = filled(spark, 10)
    ap.compact(spark, root, "t", RULE)
    then = ap.contents(spark, root, "t")["version"]
    ap.apply_batch(rows(spark, [("K1", 2, "gone"), ("K2", 2, "new")]), 1, root, "t", RULE)
    ap.compact(spark, root, "t", RULE)
    assert ap.current_state(spark, root, "t", RULE, then).count() == 10
    assert ap.current_state(spark, root, "t", RULE).count() == 9


def test_change_feed_has_both_images_and_only_real_changes(spark):
    root = filled(spark, 20)
    ap.compact(spark, root, "t", RULE)
    then = feed.current_version(spark, root, "t")
    ap.apply_batch(rows(spark, [("K1", 2, "gone"), ("K2", 2, "new"), ("K3", 0, "too late"), ("K99", 2, "born"), (None, 2, "null key")]), 1, root, "t", RULE)
    ap.compact(spark, root, "t", RULE)
    ap.apply_batch(rows(spark, [("K99", 3, "gone"), ("K98", 3, "born")]), 2, root, "t", RULE)
    found = {(r.k, r.oper, r.before and r.before.v, r.after and r.after.v) for r in feed.change_feed(spark, root, "t", RULE, then).collect()}
    assert found == {("K1", "D", "first", None), ("K2", "U", "first", "new"), ("K98", "I", None, "born"), (None, "I", None, "null key")}
    now = feed.current_version(spark, root, "t")
    assert feed.change_feed(spark, root, "t", RULE, now) is None
    assert feed.change_feed(spark, root, "t", RULE, None, now).count() == 21  # from nothing: all live rows


HISTORY = cdc.ApplySpec(keys=("k",), sequence_by=("s",), tie_break=("at",), delete_when="v = 'gone'")


def changes(spark, data):
    return spark.createDataFrame([(k, s, v, datetime(2024, 1, 1 + s)) for k, s, v in data], "k string, s int, v string, at timestamp")


def versions(df):
    return sorted((str(r.k), r.s, r.v, r[cdc.START_COL], r[cdc.END_COL] if r[cdc.END_COL] is not None else 99) for r in df.collect())


def test_stored_history_equals_a_rebuild_whatever_the_order(spark):
    r = random.Random(9)
    log = [(r.choice(["a", "b", "hot", "hot", "hot", None]), r.randrange(25), r.choice(["x", "y", "gone"])) for _ in range(120)]
    root = work_dir(spark, "test-history")
    for batch, part in enumerate((log[80:], log[:40], log[:10], log[40:80], log[75:85])):
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo" if batch == 2 else "UTC")  # identities don't depend on it
        history.update_history(changes(spark, part).repartition(3), batch, root, "t", HISTORY)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        if batch == 2:
            history.compact_history(spark, root, "t", HISTORY)
    assert versions(history.read_history(spark, root, "t", HISTORY)) == versions(cdc.scd2_history(changes(spark, log), HISTORY))


def test_a_late_change_splits_one_interval_and_a_duplicate_none(spark):
    root = work_dir(spark, "test-split")
    history.update_history(changes(spark, [("a", s, "x") for s in range(0, 20, 2)] + [(f"k{i}", 1, "x") for i in range(50)]), 0, root, "t", HISTORY)
    history.update_history(changes(spark, [("a", 7, "late")]), 1, root, "t", HISTORY)
    written = ap.contents(spark, root, history.history_name("t"))["batches"][1]
    assert written["rows"] == 2 and len(written["slots"]) == 1  # the change, and the version it closes
    history.update_history(changes(spark, [("a", 7, "late"), ("a", 8, "x")]), 2, root, "t", HISTORY)
    assert ap.contents(spark, root, history.history_name("t"))["batches"][2]["rows"] == 0
    stored = history.read_history(spark, root, "t", HISTORY)
    assert [(s, e) for k, s, _, _, e in versions(stored) if k == "a"][3:5] == [(6, 7), (7, 8)]
    assert sorted(r.v for r in history.history_as_of(stored, 7).where("k = 'a'").collect()) == ["late"]
    history.update_history(changes(spark, [("a", 30, "gone")]), 3, root, "t", HISTORY)
    assert history.history_as_of(history.read_history(spark, root, "t", HISTORY), 31).where("k = 'a'").count() == 0


def test_rows_that_share_a_key_are_spread_over_buckets_of_one_slot(spark):
    root = work_dir(spark, "test-hot-history")
    history.update_history(changes(spark, [("hot", s % 27, f"v{s}") for s in range(400)]), 0, root, "t", HISTORY)
    history.compact_history(spark, root, "t", HISTORY)
    table = ap.contents(spark, root, history.history_name("t"))
    assert len(table["slots"]) == 1
    names = [n for n in files.children(spark, next(iter(table["slots"].values()))["folder"]) if n.endswith(".parquet")]
    assert len(names) > 8


def test_schema_log_keeps_each_schema_once_with_what_brought_it(spark):
    from tidewater.sources import schemas
    from tidewater.specs import CLAIMS

    root, spec = work_dir(spark, "test-schemas"), CLAIMS["payer"]
    plain = spark.createDataFrame([], spec.change_schema())
    plain.coalesce(1).write.parquet(f"{root}/a")
    plain.withColumn("extra", F.lit("x")).drop("state").coalesce(1).write.parquet(f"{root}/b")
    plain.withColumn("payer_name", F.lit(1)).coalesce(1).write.parquet(f"{root}/c")

    def files_of(*folders):
        return [f"{root}/{f}/{n}" for f in folders for n in files.children(spark, f"{root}/{f}") if n.endswith(".parquet")]

    groups = schemas.group_files(spark, root, "payer", files_of("a", "b"), 0)
    assert sorted(len(g) for _, g in groups) == [1, 1]
    assert len(schemas.group_files(spark, root, "payer", files_of("a", "c", "b"), 1)) == 3
    schemas.group_files(spark, root, "payer", files_of("c"), 2)
    seen = [(r.version, r.batch_id, r.added, r.missing, r.retyped) for r in schemas.history(spark, root, spec).orderBy("version").collect()]
    assert seen == [(0, 0, "", "", ""), (1, 0, "extra", "state", ""), (2, 1, "", "", "payer_name: int")]
    assert schemas.schema_log(spark, root, "payer").versions() == [0, 1]  # a batch of known schemas commits nothing


def test_json_lines_are_parsed_once_and_nothing_is_lost(spark):
    from tidewater.sources.rescue import read_rescued
    from tidewater.specs import RESCUE_COL, TableSpec

    path = work_dir(spark, "test-json")
    lines = [
        '{"id": 1, "amount": "2.50", "at": "2024-01-01T00:00:00.123456", "note": "plain"}',
        '{"id": "two", "amount": 3, "tags": ["a", {"b": 1}]}',
        '{"id": 3, "amount": "lots", "note": null}',
        "not json at all",
        '{"id": 4, "amount": 1.25',
        "",
        '["an", "array"]',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    spec = TableSpec("t", ("id",), (("id", "INT"), ("amount", "DECIMAL(9,2)"), ("at", "TIMESTAMP"), ("note", "STRING")))
    df = read_rescued(spark, [(None, [path])], spec, "json")
    assert plan(df).count("FileScan") == 1
    got = {(r.id, str(r.amount), r.note, r[RESCUE_COL]) for r in df.collect()}
    assert got == {
        (1, "2.50", "plain", None),
        (None, "3.00", None, '{"id":"two","tags":"[\\"a\\",{\\"b\\":1}]"}'),
        (3, "None", None, '{"amount":"lots"}'),
        (None, "None", None, '{"_corrupt_record":"not json at all"}'),
        (None, "None", None, '{"_corrupt_record":"{\\"id\\": 4, \\"amount\\": 1.25"}'),
        (None, "None", None, '{"_corrupt_record":"[\\"an\\", \\"array\\"]"}'),
    }


def test_heavy_hitters_stay_within_their_error_when_batches_are_merged(spark):
    from collections import Counter

    from tidewater.plans import skew

    r, root, true = random.Random(6), work_dir(spark, "test-hot"), Counter()
    rule = cdc.ApplySpec(keys=("k",), sequence_by=("s",), delete_when=None)
    for batch in range(4):
        data = [(f"b{batch}-{i}", batch, "hot" if r.random() < 0.33 else f"v{r.randrange(3000)}") for i in range(2000)]
        true.update(v for _, _, v in data)
        ap.apply_batch(rows(spark, data), batch, root, "t", rule, watch=("v",))
    held = ap.contents(spark, root, "t")
    found = {x.item: x for x in skew.heavy_hitters(spark, held, "v").collect()}
    assert len(found) <= ap.HOT_KEPT and found["hot"].rows == 8000
    for item, x in found.items():
        assert abs(true[item] - x.n_rows) <= held["hot"]["v"]["error"]
    assert all(n <= held["hot"]["v"]["unlisted"] for item, n in true.items() if item not in found)
    ap.compact(spark, root, "t", rule)
    assert ap.contents(spark, root, "t")["hot"] == held["hot"]


def test_merging_heavy_hitters_of_short_lists_is_exact():
    a, b = ap.batch_hot([("x", 5), ("y", 2)], 7), ap.batch_hot([("y", 4), (None, 1)], 5)
    assert ap.merge_hot(a, b) == {"rows": 12, "items": {"x": 5, "y": 6, "": 1}, "error": 0, "unlisted": 0}
    assert ap.merge_hot(None, a) == a


def test_change_feed_joins_versions_in_their_buckets(spark, monkeypatch):
    """Between two snapshots only the touched keys are shuffled; the rows of both versions are joined where they lie."""
    monkeypatch.setattr(ap, "LISTED_KEYS", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        root = filled(spark)
        ap.compact(spark, root, "t", RULE)
        first = feed.current_version(spark, root, "t")
        ap.apply_batch(rows(spark, [(f"K{i}", 2, "gone" if i % 2 else "second") for i in range(0, 60)] + [("new", 2, "x")]), 1, root, "t", RULE)
        ap.compact(spark, root, "t", RULE)
        found = feed.change_feed(spark, root, "t", RULE, first)
        assert found.columns == ["k", "oper", "before", "after"]
        got = sorted((r["k"], r["oper"]) for r in found.collect())
        assert got == sorted([(f"K{i}", "D" if i % 2 else "U") for i in range(60)] + [("new", "I")])
        plan = found._jdf.queryExecution().executedPlan().toString()
        plan = plan[plan.index("== Initial Plan ==") :] if "== Initial Plan ==" in plan else plan
        shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert shuffled and all("__asked" in line for line in shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_of_many_repeated_keys_is_still_a_list(spark, monkeypatch):
    root = filled(spark)
    ap.compact(spark, root, "t", RULE)
    keys = spark.createDataFrame([(f"K{i % 4}",) for i in range(40)] + [(None,)], "k string")
    monkeypatch.setattr(ap, "LISTED_KEYS", 6)
    found = ap.current_state_for(spark, root, "t", RULE, keys)
    assert sorted(r["k"] for r in found.collect()) == ["K0", "K1", "K2", "K3"]


def test_splits_are_sized_unless_the_caller_said_so(spark, sf):
    from tidewater.session import SPLIT_CONF
    from tidewater.sources.tables import read_table

    (name, wanted), = SPLIT_CONF.items()
    spark.conf.unset(name)
    read_table(spark, sf, "orders")
    assert spark.conf.get(name) == wanted
    spark.conf.set(name, "64m")
    read_table(spark, sf, "orders")
    assert spark.conf.get(name) == "64m"
    spark.conf.unset(name)


def test_layers_write_row_groups_that_splits_can_tell_apart(spark, tmp_path):
    import pyarrow.parquet as pq

    # 24 MB that do not compress: one row group of Spark's default size, which no split divides
    rows = spark.range(0, 3_000_000, 1, 1).select(F.rand(7).alias("x"))
    path = write_table(rows, f"{tmp_path}/landing")
    (name,) = [n for n in os.listdir(path) if n.endswith(".parquet")]
    held = pq.ParquetFile(os.path.join(path, name)).metadata
    sizes = [held.row_group(i).total_byte_size for i in range(held.num_row_groups)]
    assert held.num_rows == 3_000_000 and len(sizes) >= 2 and max(sizes) <= 20 * 1024**2
