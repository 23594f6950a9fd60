"""Bucketed storage of keyed tables, in slots that a commit rewrites or carries over.

Rows are hashed by their key into ``buckets``, Spark's own bucketed parquet, so a
join or aggregate on the key reads the stored side bucket by bucket, without an
Exchange. They lie in folders (slots) by the hash of the key or of its leading
part; each slot's folder is named by the table's manifest, so a new version of a
table is new folders for the slots that changed and the old ones for the rest.
A slot by the whole key holds ``buckets / slots`` buckets. A slot by a part of it
holds a piece of every bucket, so rows that share the part are found in one slot
and still spread over all tasks of a merge, however many they are.

``__k`` is the key as one text that is never null, in which NULL parts are parts
like any other. Inside a bucket rows are sorted by it and pages are small, so a
lookup of listed keys reads pages, not files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType, TimestampNTZType, TimestampType

from .tables import CODEC, ROW_GROUP

KEY = "__k"
SLOT = "__slot"
SORTED_BYTES = 16 * 1024**2  # of stored rows: a task that sorts them holds some twelve times as much
PAGE_ROWS = 256  # rows of a parquet page: what a lookup of one key reads


@dataclass(frozen=True)
class Layout:
    """``buckets`` sizes the files (a bucket is one task of a merge), ``slots`` what a commit rewrites at least."""

    buckets: int = 16
    slots: int = 8

    def __post_init__(self):
        if self.slots < 1 or self.buckets % self.slots:
            raise ValueError("buckets must be a multiple of slots")


def layout_for(total_bytes: int, bucket_bytes: int = 512 * 1024**2, slot_buckets: int = 8, least: Layout = Layout()) -> Layout:
    """Buckets of about ``bucket_bytes`` for a table of ``total_bytes``, ``slot_buckets`` of them in a slot."""
    slots = max(least.slots, -(-total_bytes // (bucket_bytes * slot_buckets)))
    return Layout(max(least.buckets, slots * slot_buckets) if slots > least.slots else least.buckets, slots)


def grown(layout: Layout, total_bytes: int) -> Layout:
    """``layout`` with as many buckets as ``total_bytes`` need for a task to sort one in memory; the slots stay."""
    return Layout(max(layout.buckets, layout.slots * -(-total_bytes // (SORTED_BYTES * layout.slots))), layout.slots)


def key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """One text per key, the same for equal keys only; NULL parts equal NULL parts."""
    parts = []
    for k in keys:
        c, kind = F.col(f"`{k}`"), df.schema[k].dataType
        if isinstance(kind, TimestampType):
            c = F.unix_micros(c)  # not its text, which depends on the session's time zone
        elif isinstance(kind, TimestampNTZType):
            c = c.cast("string")
        elif isinstance(kind, (DoubleType, FloatType)):
            c = F.when(c == 0, F.lit(0.0)).otherwise(c)  # both zeros are one key
        text = c.cast("string")
        if len(keys) > 1:
            text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(","), F.lit("\\,"))
        parts.append(F.coalesce(F.concat(F.lit("="), text), F.lit("~")))
    return F.concat_ws(",", *parts) if len(parts) > 1 else parts[0]


def derived_key(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The key columns that ``with_key`` can make from ``__k``: a key that is one text."""
    return list(keys) if len(keys) == 1 and df.schema[keys[0]].dataType == StringType() else []


def with_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the text that its ``__k`` was made from."""
    return df.withColumn(key, F.when(F.col(KEY) != "~", F.substring(KEY, 2, 2**31 - 1)))


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key text; Spark hashes buckets the same way, and slots divide buckets."""
    return F.pmod(F.hash(key), F.lit(slots)).cast("int")


def write(df: DataFrame, path: str, layout: Layout, aligned: bool = False) -> None:
    """Write keyed rows as bucketed files below ``path/__slot=N``.

    ``aligned``: each task of ``df`` holds whole buckets already (it was read from
    buckets and joined in place), so nothing is shuffled.
    """
    spark = df.sparkSession
    rows = df if aligned else df.repartition(layout.buckets, KEY)
    name = "tidewater_write_" + hashlib.md5(path.encode()).hexdigest()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = rows.write.format("parquet").mode("overwrite").partitionBy(SLOT).bucketBy(layout.buckets, KEY).sortBy(KEY)
    writer = writer.option("compression", CODEC).option("parquet.page.row.count.limit", PAGE_ROWS).option("path", path)
    try:
        writer.saveAsTable(name)  # the catalogue entry only serves to name the buckets; the files stay
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_batch(df: DataFrame, path: str, layout: Layout) -> None:
    """Write keyed rows that lie by ``__k`` as files of its buckets in one folder.

    The rows of a bucket stay in the order they have in their task.
    """
    spark = df.sparkSession
    name = "tidewater_batch_" + hashlib.md5(path.encode()).hexdigest()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.format("parquet").mode("overwrite").bucketBy(layout.buckets, KEY)
    writer = writer.option("compression", CODEC).options(**ROW_GROUP).option("path", path)
    try:
        writer.saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read(spark: SparkSession, folders: dict[int, str], schema: StructType, layout: Layout) -> DataFrame:
    """The stored rows (with ``__k`` and ``__slot``) of the slots' folders, known to Spark as bucketed by ``__k``.

    The entry in the session's catalogue is named after what it refers to, so
    reading a version again finds it there.
    """
    listed = sorted((int(s), f) for s, f in folders.items())
    name = "tidewater_read_" + hashlib.md5(repr((listed, layout, schema.json())).encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != SLOT)
        home = listed[0][1] if listed else "/"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {SLOT} INT) USING parquet PARTITIONED BY ({SLOT}) "
            f"CLUSTERED BY ({KEY}) INTO {layout.buckets} BUCKETS LOCATION '{home}'"
        )
        parts = " ".join(f"PARTITION ({SLOT}={s}) LOCATION '{f}'" for s, f in listed)
        if parts:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    # the filter makes Spark take the table's size from its files
    return spark.table(name).where(F.col(SLOT) >= 0)


def only(df: DataFrame, slots: Iterable[int]) -> DataFrame:
    """The rows of some slots; the others' folders are not read."""
    return df.where(F.col(SLOT).isin([int(s) for s in slots]))


def without(df: DataFrame, slots: Iterable[int]) -> DataFrame:
    return df.where(~F.col(SLOT).isin([int(s) for s in slots]))
