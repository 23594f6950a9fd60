"""Landing and bronze: change files -> append-only, provenance-stamped change logs.

``land`` writes one run's change rows below ``landing/<table>/<label>/``.
``start_bronze`` takes the *new* files under ``landing/<table>`` (nested label
folders included), conforms them to the registry with everything that does not
fit kept in the rescue column, stamps ingest time and source file, and adds them
to ``bronze/<table>`` as one folder per batch. A batch is written aside and moved
into place whole, and a batch already in place is not written again, so a file's
rows are in the log exactly once however often the job restarts, and readers of
the log never see a file that a retry replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import schemas
from ..sources.files import exists, move
from ..sources.rescue import read_rescued
from ..sources.tables import CODEC, ROW_GROUP, append_table
from ..specs import INGESTED_AT_COL, RESCUE_COL, SOURCE_FILE_COL, TableSpec

# Files of one micro-batch: bounds the paths the driver holds and what a retry repeats.
MAX_FILES_PER_TRIGGER = 1000


def landing_path(root: str, table: str, label: str | None = None) -> str:
    base = f"{root.rstrip('/')}/landing/{table}"
    return f"{base}/{label}" if label else base


def bronze_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/bronze/{table}"


def checkpoint_path(root: str, flow: str) -> str:
    return f"{root.rstrip('/')}/_checkpoints/{flow}"


def land(df: DataFrame, root: str, table: str, label: str, num_files: int | None = None) -> str:
    """Append one run's change rows as parquet below its label folder.

    ``num_files`` sizes the output (round-robin ``repartition``) so a large run
    lands as evenly sized files for the stream to pick up.
    """
    if num_files:
        df = df.repartition(num_files)
    return append_table(df, landing_path(root, table, label))


def landed_files(spark: SparkSession, root: str, table: str, fmt: str = "parquet", max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Paths of one table's new landed files as a stream (contents are not read).

    ``recursiveFileLookup`` is required: files sit in nested label folders, and
    without it they are silently skipped.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{fmt}")
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
        .load(landing_path(root, table))
        .select("path")
    )


def append_batch(rows: DataFrame, root: str, table: str, batch_id: int) -> None:
    """Add a batch to the log: written aside, then moved into place in one step; nothing if it is there already."""
    spark = rows.sparkSession
    final = f"{bronze_path(root, table)}/batch_id={batch_id}"
    if exists(spark, final):
        return
    aside = f"{bronze_path(root, table)}/_aside/batch_id={batch_id}"
    rows.write.mode("overwrite").option("compression", CODEC).options(**ROW_GROUP).parquet(aside)
    move(spark, aside, final)


def start_bronze(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    fmt: str = "parquet",
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    suffix: str | None = None,
) -> StreamingQuery:
    """Append new landed files of ``spec`` to its bronze log; runs what is there, then stops. ``suffix``: of the files' names, if not the format's."""

    def run(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.collect()]  # at most max_files_per_trigger
        if not paths or exists(spark, f"{bronze_path(root, spec.name)}/batch_id={batch_id}"):
            return
        groups = schemas.group_files(spark, root, spec.name, paths, batch_id) if fmt == "parquet" else [(None, paths)]
        append_batch(read_rescued(batch.sparkSession, groups, spec, fmt), root, spec.name, batch_id)

    return (
        landed_files(spark, root, spec.name, suffix or fmt, max_files_per_trigger)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint_path(root, f"bronze_{spec.name}"))
        .queryName(f"bronze_{spec.name}_{abs(hash(root)) % 10**8}")
        .trigger(availableNow=True)
        .start()
    )


def bronze_schema(spec: TableSpec):
    from pyspark.sql.types import StringType, StructField, StructType, TimestampType

    fields = list(spec.change_schema().fields) + [
        StructField(INGESTED_AT_COL, TimestampType(), True),
        StructField(SOURCE_FILE_COL, StringType(), True),
        StructField(RESCUE_COL, StringType(), True),
    ]
    return StructType(fields)


def read_bronze(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """Batch read of a bronze log; the folder column is not part of the log."""
    return spark.read.schema(bronze_schema(spec)).option("recursiveFileLookup", "true").parquet(bronze_path(root, spec.name))


def read_bronze_stream(spark: SparkSession, root: str, spec: TableSpec, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of rows appended to a bronze log since the reading query's last run."""
    r = spark.readStream.schema(bronze_schema(spec)).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(bronze_path(root, spec.name))
