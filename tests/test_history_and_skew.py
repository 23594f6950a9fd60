"""SCD2 history and the skew-safe ordered operator."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import cdc, ordered
from tidewater.plans import skew


def test_next_in_key_matches_window_with_a_hot_key(spark):
    # One key holds a third of the rows and spans many range partitions.
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        ((F.col("id") * 7919) % 6007).alias("s"),
    )
    got = ordered.next_in_key(df, ["k"], ["s", "s"], "s", "nxt", num_partitions=16)
    want = df.withColumn("nxt", F.lead("s").over(Window.partitionBy("k").orderBy("s")))
    a = sorted((r["k"], r["s"], r["nxt"]) for r in got.collect())
    b = sorted((r["k"], r["s"], r["nxt"]) for r in want.collect())
    assert a == b


def test_scd2_intervals_delete_and_late_arrival(spark):
    log = spark.createDataFrame(
        [
            ("a", "v1", "I", 1),
            ("a", "v3", "U", 5),
            ("a", None, "D", 9),
            ("a", "v2", "U", 3),  # arrives late, lands between 1 and 5
            ("b", "w1", "I", 2),
        ],
        "k STRING, v STRING, header__change_oper STRING, header__change_seq BIGINT",
    )
    spec = cdc.ApplySpec(keys=("k",), sequence_by=("header__change_seq",), except_columns=("header__change_oper",))
    h = {(r["k"], r["v"]): (r[cdc.START_COL], r[cdc.END_COL]) for r in cdc.scd2_history(log, spec).collect()}
    assert h == {("a", "v1"): (1, 3), ("a", "v2"): (3, 5), ("a", "v3"): (5, 9), ("b", "w1"): (2, None)}


def test_skew_profiles(spark):
    df = spark.range(1000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 10 < 8, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("p")
    )
    kp = skew.key_profile(df, ["p"]).first()
    assert kp["top_key_rows"] == 800 and kp["top_key_share_bp"] == 8000
    even = skew.partition_profile(df, ["k"], 8).first()
    hot = skew.partition_profile(df, ["p"], 8).first()
    assert even["max_over_median"] < 2.0
    assert hot["max_rows"] >= 800


def test_ordered_rows_are_stored_as_their_own_columns(spark):
    """What passes from the range partitions to the window is parquet without the key and order structs, not serialised rows."""
    df = spark.range(300).select((F.col("id") % 7).alias("k"), F.col("id").alias("s"))
    got = ordered.next_in_key(df, ["k"], ["s"], "s", "nxt", num_partitions=4)
    scans = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in line or "RDD" in line]
    assert scans and all("parquet" in line and "__ord_order" not in line and "__ord_key" not in line for line in scans)
