"""Session helpers: a sane local session for tests/bench, and the shared work folder.

On a cluster the caller owns the session; nothing here overrides settings that
are already present. The work folder (landing files, change-log state, stream
checkpoints, materialised tables) lives below ``spark.checkpoint.dir``, which a
cluster points at shared storage. Only when that setting is absent (local tests)
do we pick a scratch folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for this engine. Applied only when not already set.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A lookup of listed keys reaches the parquet pages as the list, not as its range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "2000",
    # Streaming file sinks/sources: one transactional log per folder.
    "spark.sql.streaming.schemaInference": "false",
}

# Set by a runner where the caller left it unset: a run is many jobs, and the shuffle files of
# one that has ended would else lie on disk until the driver happens to collect its plan.
RUNNER_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Set by runners and readers of tables where the caller left it unset. A reduction sorts a split's
# rows before it folds them, and there they take 12 (change logs) to 30 times (source tables, whose
# numbers become texts) their stored bytes: of a split of 128 MB, Spark's default, most would spill.
SPLIT_CONF = {"spark.sql.files.maxPartitionBytes": str(16 * 1024**2)}

# Set by operators that give whole texts to Python where the caller left it unset: with Spark's 10,000
# rows, a task holds tens of MB of text several times over, outside the heap and in its worker.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewater", conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a local session with the UI off, as tests and bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Independent table flows run side by side; FAIR keeps one from starving the rest.
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "16g"))
    )
    for k, v in (DEFAULT_CONF | (conf or {})).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidewater/{name or 'run'}-{uuid.uuid4().hex[:12]}"


def recommended_conf(
    input_bytes: int,
    total_cores: int,
    shuffle_partition_bytes: int = 1024**3,
    split_bytes: int = 512 * 1024**2,
    max_partitions: int = 200_000,
) -> dict[str, str]:
    """SQL settings sized for a job reading ``input_bytes`` on ``total_cores`` cores.

    Shuffle partitions: about ``shuffle_partition_bytes`` of shuffled data each
    (change logs shuffle roughly their input size), at least two waves of tasks,
    at most ``max_partitions`` so map x reduce shuffle blocks stay manageable at
    100 TB. Scan splits of ``split_bytes`` keep the map-task count sane while a
    split still decodes well inside executor memory. AQE then coalesces small
    partitions and splits skewed join partitions at run time.
    """
    by_size = input_bytes // shuffle_partition_bytes + 1
    partitions = min(max(2 * total_cores, by_size), max(max_partitions, 2 * total_cores))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024**2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str], override: bool = False) -> dict[str, str]:
    """Set runtime SQL settings, by default only those the cluster left unset."""
    applied = {}
    for k, v in conf.items():
        if override or spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
            applied[k] = v
    return applied
