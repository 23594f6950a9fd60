"""Control row: the landing job's high-water mark, sequence base and run index.

One row, read with ``head()``. It is advanced only after a run has landed, and
by writing a *new* version folder (``_control/v=N``) that readers pick up once
its ``_SUCCESS`` marker exists: an overwrite in place is not atomic, and a
crash mid-write must leave the previous row readable.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Row, SparkSession

from . import files

CONTROL_SCHEMA = "max_claim_n BIGINT, seq_base BIGINT, run_index BIGINT, updated_at TIMESTAMP"


def control_path(root: str) -> str:
    return f"{root.rstrip('/')}/_control"


def _versions(spark: SparkSession, root: str) -> list[int]:
    path = control_path(root)
    return [n for n in files.numbered(spark, path, "v=") if files.exists(spark, f"{path}/v={n}/_SUCCESS")]


def read_control(spark: SparkSession, root: str) -> Row | None:
    """The current control row, or None before the first run."""
    v = _versions(spark, root)
    if not v:
        return None
    return spark.read.schema(CONTROL_SCHEMA).parquet(f"{control_path(root)}/v={v[-1]}").head()


def advance_control(spark: SparkSession, root: str, max_claim_n: int, seq_base: int, run_index: int) -> str:
    """Write the next control row as a new committed version (write-new-then-swap)."""
    row = [(int(max_claim_n), int(seq_base), int(run_index), _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))]
    out = f"{control_path(root)}/v={int(run_index)}"
    spark.createDataFrame(row, CONTROL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(out)
    return out
