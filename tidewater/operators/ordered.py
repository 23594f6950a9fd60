"""Ordered operators that stay balanced when one key holds a large share of rows.

``Window.partitionBy(key)`` sends every row of a key to one task. For a key
holding a third of a 100 TB log that task never finishes. ``next_in_key``
instead range-partitions on ``(key, order)``: the range sampler splits a hot key
over as many partitions as its size needs. The ``lead`` is then taken inside
each (range partition, key) slice, and the last row of a slice looks up the
first row of the next non-empty range partition. That lookup table has one row
per range partition, so its size is bounded by the partition count, not the data.
The range-partitioned rows are stored once, as parquet with nothing but their own
columns and the partition's number, so both uses agree on the layout (and a lost
executor re-reads them instead of re-sampling bounds).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.columns import col_of
from ..session import work_dir
from ..sources.tables import CODEC

_K = "__ord_key"
_O = "__ord_order"
_PID = "__ord_pid"
_LAST = "__ord_is_last"


def next_in_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value_col: str,
    out_col: str,
    num_partitions: int | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Add ``out_col`` = ``value_col`` of the next row of the same key by ``order``.

    NULL for the last row of each key. Rows are compared by the whole
    ``order`` tuple; give a total order (append a payload struct) for
    deterministic results. With ``distinct``, rows equal in key and order are one
    row: a range partition holds all of them side by side, so dropping them
    needs no shuffle of its own.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    rank = F.struct(*[col_of(c).alias(f"o{i}") for i, c in enumerate(order)])
    # Range bounds come from a sample of the input, whose order after a shuffle
    # is not fixed: two evaluations could disagree on which partition holds a
    # row. Write the partitioned rows once (in the shared folder) so the window and
    # the boundary table see one layout; key and order are made of them again.
    path = work_dir(spark, "ordered")
    df.repartitionByRange(n, key, rank).withColumn(_PID, F.spark_partition_id()).write.option("compression", CODEC).parquet(path)
    ranged = spark.read.schema(StructType([*df.schema.fields, StructField(_PID, IntegerType())])).parquet(path).withColumn(_K, key).withColumn(_O, rank)

    w = Window.partitionBy(_PID, _K).orderBy(_O)
    rows = ranged
    if distinct:
        before = F.lag(_O).over(w)
        rows = rows.withColumn("__before", before).where(F.col("__before").isNull() | (F.col("__before") != F.col(_O))).drop("__before")
    with_lead = rows.withColumn(out_col, F.lead(F.col(value_col)).over(w)).withColumn(
        _LAST, F.lead(F.lit(1)).over(w).isNull()
    )

    # One row per non-empty range partition: the key and value of its first row. The
    # order columns (which may hold the whole record) are left behind before the broadcast.
    firsts = ranged.groupBy(_PID).agg(F.min(F.struct(_K, _O, F.col(value_col).alias("v"))).alias("first"))
    firsts = firsts.select(_PID, F.struct(F.col(f"first.{_K}").alias(_K), F.col("first.v").alias("v")).alias("first"))
    by_pid = Window.orderBy(_PID)  # at most n rows
    boundary = firsts.select(F.col(_PID), F.lead("first").over(by_pid).alias("__next_first"))

    joined = with_lead.join(F.broadcast(boundary), _PID, "left")
    carried = F.when(
        F.col(_LAST) & (F.col("__next_first." + _K) == F.col(_K)), F.col("__next_first.v")
    ).otherwise(F.col(out_col))
    return joined.withColumn(out_col, carried).drop(_K, _O, _PID, _LAST, "__next_first")
