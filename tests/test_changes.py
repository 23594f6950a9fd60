"""Change-batch synthesis: mix validation, disjoint buckets, exact counts."""

import pytest
from pyspark.sql import functions as F

from tidewater.plans import changes as ch
from tidewater.plans import roles


def test_mix_must_sum_to_one():
    with pytest.raises(ValueError):
        ch.ChangeMix(0.5, 0.5, 0.5, 0.0)
    with pytest.raises(ValueError):
        ch.ChangeMix(-0.1, 0.5, 0.5, 0.1)


def test_bucket_bounds_default_and_partial():
    assert ch.ChangeMix().bucket_bounds(20) == [("new", 0, 4), ("header_only", 4, 10), ("adjustment", 10, 17), ("reversal", 17, 20)]
    assert ch.ChangeMix().bucket_bounds(100, touched=0.2)[-1] == ("reversal", 17, 20)
    with pytest.raises(ValueError):
        ch.ChangeMix().bucket_bounds(10)  # 0.35 of 10 buckets is not whole


def test_increment_counts_are_exact_and_disjoint(spark, sf):
    inc = roles.changes(spark, sf, "claim", roles.INCREMENT)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    n = orders.count()
    by_status = {r["claim_status"]: r["count"] for r in inc.groupBy("claim_status").count().collect()}
    keys = orders.select((F.col("o_orderkey") % 20).alias("b"))
    want = {
        "SUBMITTED": keys.where("b < 4").count(),
        "DENIED": keys.where("b >= 4 AND b < 10").count(),
        "ADJUSTED": keys.where("b >= 10 AND b < 17").count(),
        "REVERSED": keys.where("b >= 17").count(),
    }
    assert by_status == want and sum(want.values()) == n
    assert inc.select("claim_id").distinct().count() == n  # each claim gets one change


def test_sequences_unique_per_run_and_below_next_base(spark, sf):
    inc = roles.changes(spark, sf, "claim_detail", roles.INCREMENT)
    seq = inc.agg(F.min("header__change_seq").alias("lo"), F.max("header__change_seq").alias("hi")).first()
    assert ch.SEQ_STEP <= seq["lo"] and seq["hi"] < 2 * ch.SEQ_STEP


def test_audit_keys_do_not_collide_across_runs(spark, sf):
    a0 = roles.changes(spark, sf, "claim_audit", roles.SEED).select("claim_audit_id")
    a1 = roles.changes(spark, sf, "claim_audit", roles.INCREMENT).select("claim_audit_id")
    assert a0.join(a1, "claim_audit_id").count() == 0


def test_draws_are_even_repeatable_and_independent(spark):
    from collections import Counter

    from tidewater.functions.columns import draw

    df = spark.range(6000).select(draw("abc", "id").alias("x"), draw("abcd", "id", salt=5).alias("y"))
    rows = [(r.x, r.y) for r in df.collect()]
    assert rows == [(r.x, r.y) for r in df.collect()]
    assert all(abs(n - 500) < 100 for n in Counter(rows).values()) and len(set(rows)) == 12
    huge = spark.createDataFrame([(2**62,), (-(2**62),)], "id bigint")
    assert {r[0] for r in huge.select(draw("ab", "id")).collect()} <= {"a", "b"}
