"""Schema history: a stored, versioned log of the schemas that a table's landed files had.

Each parquet file says its schema in its footer. The footers of a batch's files
are read side by side (metadata only; a batch has a bounded number of files), and
each file's schema text is looked up in the table's log. A known one needs
nothing more; a new one is resolved by Spark once, from that one file, and goes
into the log with the batch and the file that brought it. So a batch without
drift starts no job of its own, and a batch with drift is split exactly.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..specs import TableSpec
from .files import hadoop
from .manifest import Conflict, Manifest

READERS = 16  # footers read at a time
HISTORY_SCHEMA = "version INT, batch_id BIGINT, file STRING, columns STRING, added STRING, missing STRING, retyped STRING"


def schema_log(spark: SparkSession, root: str, table: str) -> Manifest:
    return Manifest(spark, f"{root.rstrip('/')}/schemas/{table}")


def _fingerprint(spark: SparkSession, path: str) -> str:
    """Identity of the schema in a parquet file's footer."""
    parquet = spark.sparkContext._jvm.org.apache.parquet
    source = parquet.hadoop.util.HadoopInputFile.fromPath(hadoop(spark, path)[1], spark.sparkContext._jsc.hadoopConfiguration())
    reader = parquet.hadoop.ParquetFileReader.open(source)
    try:
        text = reader.getFooter().getFileMetaData().getSchema().toString()
    finally:
        reader.close()
    return hashlib.md5(text.encode()).hexdigest()


def seen(spark: SparkSession, root: str, table: str) -> list[dict]:
    """The log's entries in the order in which they came."""
    held = schema_log(spark, root, table).latest()
    return held["schemas"] if held else []


def group_files(spark: SparkSession, root: str, table: str, paths: Sequence[str], batch_id: int) -> list[tuple[StructType, list[str]]]:
    """The files in groups of one schema, each with it; new schemas are added to the table's log."""
    paths = sorted(paths)
    with ThreadPoolExecutor(READERS) as pool:
        prints = list(pool.map(lambda p: _fingerprint(spark, p), paths))
    groups: dict[str, list[str]] = {}
    for path, print_ in zip(paths, prints):
        groups.setdefault(print_, []).append(path)
    log = schema_log(spark, root, table)
    while True:
        held = log.latest()
        entries = list(held["schemas"]) if held else []
        known = {e["fingerprint"]: e for e in entries}
        for print_, files in groups.items():
            if print_ not in known:
                schema = spark.read.parquet(files[0]).schema
                known[print_] = {"fingerprint": print_, "schema": json.loads(schema.json()), "batch": int(batch_id), "file": files[0]}
                entries.append(known[print_])
        if held is None or len(entries) > len(held["schemas"]):
            try:
                log.commit({"schemas": entries}, held)
            except Conflict:
                continue  # another flow added to it
        return [(StructType.fromJson(known[p]["schema"]), files) for p, files in groups.items()]


def differences(schema: StructType, declared: StructType) -> dict[str, list[str]]:
    """How a file's schema departs from the declared one: columns it adds, lacks, or has with another type."""
    have, want = ({f.name: f.dataType for f in s.fields} for s in (schema, declared))
    return {
        "added": [c for c in have if c not in want],
        "missing": [c for c in want if c not in have],
        "retyped": [f"{c}: {have[c].simpleString()}" for c in have if c in want and have[c] != want[c]],
    }


def history(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The table's schema log: a row for each schema, in order, with what brought it and how it departs from the registry."""
    rows = []
    for version, e in enumerate(seen(spark, root, spec.name)):
        schema = StructType.fromJson(e["schema"])
        d = differences(schema, spec.change_schema())
        rows.append((version, e["batch"], e["file"], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields), *(", ".join(d[k]) for k in ("added", "missing", "retyped"))))
    return spark.createDataFrame(rows, HISTORY_SCHEMA)
