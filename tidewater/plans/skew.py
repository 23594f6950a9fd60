"""Key-skew profile: how rows spread over keys and over shuffle partitions.

For a merge on key ``k`` with ``n`` shuffle partitions, rows land in partition
``pmod(hash(k), n)`` (Spark's own hash partitioning). The profile reports the
heaviest key and the max/median rows per partition, for the merge key and for a
hot attribute. Counting is a partial + final aggregate, so a hot key is folded
map-side; only ``n`` partition counts ever meet in one place.

``heavy_hitters`` needs no pass at all: each batch's sketch of a watched column is
taken while the batch is written and kept, merged, in the table's manifest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct_keys, top_key_rows, top_key_share_bp (basis points)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    agg = counts.agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.max("n").alias("top_key_rows"),
    )
    return agg.withColumn("top_key_share_bp", F.expr("(top_key_rows * 10000) div rows"))


def partition_profile(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """One row: partitions, max_rows, median_rows, max_over_median for a hash shuffle on ``keys``."""
    part = F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(n))
    per = df.groupBy(part.cast("int").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # Every partition, empty ones as zero rows: at most n rows meet here.
    allp = df.sparkSession.range(n).select(F.col("id").cast("int").alias("p"))
    full = allp.join(per, "p", "left").select(F.coalesce(F.col("n"), F.lit(0)).alias("n"))
    agg = full.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.max("n").alias("max_rows"),
        F.sum("n").cast("bigint").alias("rows"),
        F.percentile("n", 0.5).alias("median_rows"),
    )
    return agg.withColumn("max_over_median", F.when(F.col("median_rows") > 0, F.col("max_rows") / F.col("median_rows")))


def heavy_hitters(spark: SparkSession, table: dict, column: str, least_share: float = 0.0) -> DataFrame:
    """``(item, n_rows, rows, share_bp, error_bp)`` of a watched column from a table's manifest, heaviest first.

    An item's share lies within ``error_bp`` basis points of what is given; every
    item with a larger share than the unlisted ones can have is listed.
    """
    held = table["hot"].get(column, {"rows": 0, "items": {}, "error": 0})
    rows = held["rows"]
    data = [(item, n, rows, n * 10000 // rows, held["error"] * 10000 // rows) for item, n in held["items"].items() if n >= least_share * rows]
    data.sort(key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(data, "item string, n_rows bigint, rows bigint, share_bp bigint, error_bp bigint")
