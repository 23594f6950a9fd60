"""Publications: signed-delta rollups, incremental header facts, carried-over datasets, repeated attempts."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.plans import changes as ch
from tidewater.plans import gold
from tidewater.session import work_dir
from tidewater.specs import CLAIMS, OPER_COL, SEQ_COL, TS_COL
from tidewater.streaming import apply as ap
from tidewater.streaming import publish, rollup
from tidewater.streaming.runner import Runner

TS = datetime(2024, 1, 1)
TABLES = ("claim", "claim_detail")
NAMES = ("fact_claim", "agg_claims_daily")


def sums(name="r"):
    return rollup.Rollup(name, ("g", "h"), (("total", "x", "bigint"), ("odd", "x % 2", "bigint")))


def brute(rows):
    out = {}
    for g, h, x in rows:
        t = out.setdefault((g, h), [0, 0, 0])
        t[0] += x or 0
        t[1] += (x or 0) % 2
        t[2] += 1
    return {k: tuple(v) for k, v in out.items()}


def held(spark, root):
    return {(r.g, r.h): (r.total, r.odd, r[rollup.ROWS]) for r in rollup.totals(spark, root, sums()).collect()}


def test_signed_rows_keep_totals_equal_to_a_rebuild(spark):
    r, root = random.Random(2), work_dir(spark, "test-rollup")
    schema = "g string, h int, x int"
    rows = [(r.choice(["a", "b", None]), r.choice([1, None]), r.choice([None, 0, 1, 2, 7])) for _ in range(60)]
    rollup.rebuild(spark, root, sums(), 0, spark.createDataFrame(rows, schema))
    assert held(spark, root) == brute(rows)
    for batch in range(1, 6):
        went = [rows.pop(r.randrange(len(rows))) for _ in range(8)]
        came = [(r.choice(["a", "b", "c", None]), r.choice([1, 2, None]), r.randrange(9)) for _ in range(r.randrange(8))]
        rows += came
        args = [spark.createDataFrame(x, schema) for x in (came, went)]
        rollup.move(spark, root, sums(), batch, *args)
        rollup.move(spark, root, sums(), batch, *args)  # a second attempt moves nothing
        if batch == 3:
            ap.compact(spark, root, "r", sums().spec)
        assert held(spark, root) == brute(rows)
    rollup.move(spark, root, sums(), 9, None, spark.createDataFrame(rows, schema))
    assert held(spark, root) == {}  # groups without rows are gone


def test_rows_that_change_nothing_are_not_written(spark):
    root = work_dir(spark, "test-rollup-still")
    df = spark.createDataFrame([("a", 1, 5), ("b", 1, 6)], "g string, h int, x int")
    rollup.rebuild(spark, root, sums(), 0, df)
    rollup.move(spark, root, sums(), 1, df.where("g = 'a'"), df.where("g = 'a'"))
    assert ap.contents(spark, root, "r")["batches"][0]["rows"] == 0


class Source:
    """A small claims source that keeps what it sent, to compare publications with a full build."""

    def __init__(self, spark, seed=0):
        self.spark, self.random, self.seq = spark, random.Random(seed), 0
        self.runner = Runner(spark, work_dir(spark, "test-publish"))

    def header(self, n, oper="U"):
        r = self.random
        gone = oper == "D"
        return (f"C{n}", None if gone else r.choice(["P1", "P2", None]), None if gone else r.choice(["Y1", None]), None if gone else r.choice(["PAID", "REVERSED", "ADJUSTED"]),
                None if gone else date(2024, 5, 1) + timedelta(days=r.randrange(2)), None if gone else Decimal(r.choice(["0.00", "10.00", "33.33"])), oper)

    def line(self, n, i, oper="U", claim=None):
        r = self.random
        gone = oper == "D"
        return (f"C{n}-{i}", None if gone else claim or f"C{n}", None if gone else Decimal(r.randrange(1000)) / 100, None if gone else Decimal(r.randrange(100)) / 100, oper)

    def send(self, headers, lines, label):
        self.seq += 1
        stamp = (self.seq, TS)
        if headers:
            df = self.spark.createDataFrame(
                [h + stamp for h in headers],
                f"claim_id STRING, provider_id STRING, payer_id STRING, claim_status STRING, service_from_date DATE, total_charge_amount DECIMAL(12,2), {OPER_COL} STRING, {SEQ_COL} BIGINT, {TS_COL} TIMESTAMP",
            )
            self.runner.land("claim", ch.conform(df, CLAIMS["claim"]), label)
        if lines:
            df = self.spark.createDataFrame(
                [x + stamp for x in lines],
                f"claim_detail_id STRING, claim_id STRING, paid_amount DECIMAL(12,2), adjustment_amount DECIMAL(12,2), {OPER_COL} STRING, {SEQ_COL} BIGINT, {TS_COL} TIMESTAMP",
            )
            self.runner.land("claim_detail", ch.conform(df, CLAIMS["claim_detail"]), label)
        self.runner.step(TABLES, with_twin=False)

    def check(self):
        fact = gold.fact_claim(self.runner.current("claim"), self.runner.current("claim_detail"))
        for name, want in (("fact_claim", fact), ("agg_claims_daily", gold.daily_kpis(fact))):
            got = self.runner.read_gold(name)
            assert sorted(got.columns) == sorted(want.columns)
            assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str), name


def strategy(source):
    return publish.gold_manifest(source.spark, source.runner.root).latest()["datasets"]["fact_claim"]["strategy"]


def test_publications_moved_by_changes_equal_full_builds(spark):
    s = Source(spark)
    s.send([s.header(n, "I") for n in range(12)], [s.line(n, i, "I") for n in range(12) for i in range(3)] + [s.line(99, 0, "I")], "seed")
    s.runner.publish_gold(names=NAMES)
    s.check()
    assert strategy(s) == "full"
    # a changed header, a deleted one, a changed line, a deleted one, a line that moves to another claim
    s.send([s.header(1), s.header(2, "D")], [s.line(3, 0), s.line(4, 1, "D"), s.line(5, 0, claim="C6")], "one")
    s.runner.publish_gold(names=NAMES, threshold=2.0)
    s.check()
    assert strategy(s) == "incremental"
    # the header of a line that came first, all lines of a claim gone, only lines, only headers
    s.send([s.header(99, "I")], [s.line(7, i, "D") for i in range(3)], "two")
    s.runner.publish_gold(names=NAMES, threshold=2.0)
    s.check()
    s.send([], [s.line(8, 0), s.line(200, 0, "I")], "three")
    s.send([s.header(8)], [], "four")
    s.runner.compact(TABLES)  # the feed reads across compactions
    s.runner.publish_gold(names=NAMES, threshold=2.0)
    s.check()
    first = s.runner.read_gold("agg_claims_daily", 0).agg(F.sum("claim_count")).first()[0]
    assert first == 12  # earlier publications stay readable


def test_nothing_changed_is_carried_over(spark):
    s = Source(spark, 1)
    s.send([s.header(n, "I") for n in range(5)], [s.line(n, 0, "I") for n in range(5)], "seed")
    s.runner.publish_gold()
    before = publish.gold_manifest(spark, s.runner.root).latest()
    s.runner.publish_gold()
    after = publish.gold_manifest(spark, s.runner.root).latest()
    assert after["version"] == before["version"] + 1 and after["datasets"] == before["datasets"]
    s.send([], [s.line(1, 0)], "lines only")
    s.runner.publish_gold(threshold=2.0)
    last = publish.gold_manifest(spark, s.runner.root).latest()["datasets"]
    assert last["dim_date"] == before["datasets"]["dim_date"] and last["dim_procedure"] != before["datasets"]["dim_procedure"]
    s.check()


@pytest.mark.parametrize("fails", [LookupError])
def test_a_publication_that_failed_half_way_is_repeated_from_the_same_versions(spark, monkeypatch, fails):
    s = Source(spark, 3)
    s.send([s.header(n, "I") for n in range(8)], [s.line(n, 0, "I") for n in range(8)], "seed")
    s.runner.publish_gold(names=NAMES)
    s.send([s.header(1)], [s.line(2, 0), s.line(3, 0, "D")], "one")

    move, calls = rollup.move, []

    def second_move_fails(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:  # the sums are moved and the facts written, the daily totals are not
            raise fails("lost")
        return move(*args, **kwargs)

    monkeypatch.setattr(rollup, "move", second_move_fails)
    with pytest.raises(fails):
        s.runner.publish_gold(names=NAMES, threshold=2.0)
    monkeypatch.setattr(rollup, "move", move)
    s.send([s.header(1), s.header(5)], [s.line(2, 0)], "came in between")
    s.runner.publish_gold(names=NAMES, threshold=2.0)  # finishes the first attempt
    s.runner.publish_gold(names=NAMES, threshold=2.0)  # and this one takes in what came
    s.check()


def test_a_silver_table_is_compacted_only_when_much_changed(spark):
    s = Source(spark, 4)
    s.send([s.header(n, "I") for n in range(40)], [s.line(n, 0, "I") for n in range(40)], "seed")
    s.runner.publish_gold(names=NAMES)
    s.send([s.header(1)], [s.line(n, 0) for n in range(30)], "one")
    s.runner.publish_gold(names=NAMES)
    assert len(ap.contents(spark, s.runner.root, "claim")["batches"]) == 1
    assert ap.contents(spark, s.runner.root, "claim_detail")["batches"] == []
    s.check()
    s.send([s.header(2)], [], "two")
    s.runner.compact(TABLES)
    assert set(s.runner.expire(-1)) >= {"claim", "claim_detail"}
    assert s.runner.read_gold("fact_claim").count() == 40  # what is published stays readable
    s.runner.publish_gold(names=NAMES, threshold=2.0)  # the versions to start from are gone
    assert strategy(s) == "full"
    s.check()
