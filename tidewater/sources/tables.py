"""Batch reads and writes of named tables (plain parquet folders).

``read_table`` is the one catalogue helper: every layer names a table, and the
helper maps it to a folder. Writes are overwrite-by-new-folder so readers never
see a half-written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import SPLIT_CONF, apply_conf

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table_path(root: str, name: str) -> str:
    root = root.rstrip("/")
    if name in DRIVER_TABLES:
        return f"{root}/{name}.parquet"
    return f"{root}/{name}"


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (file-system metadata, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


# Codec of what the layers write: change logs hold long keys and few different values, which it halves.
CODEC = "zstd"
# Row groups of what the layers write: a split takes whole row groups, so one of 128 MB, the default, would give a task some seven million rows to sort, however small the splits.
ROW_GROUP = {"parquet.block.size": str(16 * 1024**2)}
TARGET_FILE_BYTES = 256 * 1024 * 1024


def read_table(spark: SparkSession, root: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """A named table; how a scan is split is the session's setting, by default one whose rows a task can sort (``SPLIT_CONF``)."""
    apply_conf(spark, SPLIT_CONF)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table_path(root, name))


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    cluster_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    num_files: int | None = None,
) -> str:
    """Write ``df`` as parquet; optionally clustered on ``cluster_by``.

    Clustering range-partitions on the columns and sorts each file, so parquet
    row-group min/max statistics let a keyed read skip most of the table. The
    number of files is ``num_files``, or the session's shuffle partitions less
    what adaptive execution merges by their measured size.
    """
    out = df
    if cluster_by:
        out = out.repartitionByRange(num_files, *cluster_by) if num_files else out.repartitionByRange(*cluster_by)
        out = out.sortWithinPartitions(*cluster_by)
    writer = out.write.mode(mode).option("compression", CODEC).options(**ROW_GROUP)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    return write_table(df, path, mode="append", partition_by=partition_by)


def rows(spark: SparkSession, data: list[tuple], schema: StructType | str) -> DataFrame:
    """A small DataFrame from Python values (control rows, test fixtures)."""
    return spark.createDataFrame(data, schema)
