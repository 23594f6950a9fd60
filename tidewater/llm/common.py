"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ARROW_CONF, apply_conf, work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage at a file that survives lost executors; every later reader
    sees the same rows, so generated ids and sampled seeds stay fixed. ``options``
    go to the writer.
    """
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once for each application.

    Functions that run there are named by module; on a cluster the package need
    not be installed. ``addPyFile`` hands the archive out from the driver.
    """
    sc = spark.sparkContext
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if getattr(sc, "_tidewater_shipped", False) or not os.path.isdir(home):
        return
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tidewater-")), "tidewater.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(home)))
    sc.addPyFile(archive)
    sc._tidewater_shipped = True


def whole_texts(spark: SparkSession) -> None:
    """Make ready for Python functions that get whole texts: the package and batches of few rows."""
    ship(spark)
    apply_conf(spark, ARROW_CONF)


def release() -> None:
    """Give memory that Arrow holds but doesn't use back: workers live on beside those of the next stage."""
    pa.default_memory_pool().release_unused()


def text_key(text: Column) -> Column:
    """128-bit identity of a text: copies share it, whatever their ids."""
    return F.unhex(F.md5(text.cast("binary")))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other scripts keep their case."""
    return F.translate(text, UPPER, UPPER.lower())


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


_MAPS, _BITS = 1024, 32768  # 1024 bitmaps of 4 KB: 4 MB to broadcast, whatever the number of members


def flag_members(rows: DataFrame, key: Column, members: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: false only where ``key`` is not in the one column of ``members``.

    A filter of fixed size made of the members' hashes, so that rows that can't
    match need no shuffle. It lets more through the more members there are; what
    it lets through still has to be joined.
    """
    name = members.columns[0]

    def at(c: Column) -> tuple[Column, Column]:
        h = F.xxhash64(c)
        return F.pmod(h, F.lit(_MAPS)), F.pmod(F.shiftright(h, 20), F.lit(_BITS))

    number, bit = at(F.col(name))
    maps = members.select(number.alias("_map"), bit.alias("_bit")).groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    number, bit = at(key)
    found = rows.withColumns({"_map": number, "_bit": bit}).join(F.broadcast(maps), "_map", "left")
    byte = F.conv(F.hex(F.col("_bits").substr((F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (F.col("_bit") % 8 + 1).cast("int"))
    return found.withColumn("_maybe", F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))).drop("_map", "_bit", "_bits")
