"""Schema-drift rescue for landed files.

A declared-schema read fails outright when a file stores a column with another
type, and silently ignores columns the registry does not know. Here the files of
a batch are read with the schema they have and conformed to the registry:

* a declared column stored with another type is ``try_cast``; a value that
  does not fit becomes NULL in the column and is kept, as text, in the rescue
  column;
* a column the registry does not declare goes to the rescue column;
* a declared column missing from the file is NULL.

The rescue column is ``to_json`` of the misfits, NULL when nothing was rescued.
Parquet files come in groups of one schema (``sources.schemas``). JSON lines are
parsed once, each as a map of texts whatever fields it has; a line that is no JSON
object is kept whole, under ``_corrupt_record``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..specs import INGESTED_AT_COL, RESCUE_COL, SOURCE_FILE_COL, TableSpec

CORRUPT = "_corrupt_record"


def conform(df: DataFrame, declared: StructType) -> DataFrame:
    """Cast ``df`` to ``declared``; misfits and unknown columns into the rescue column."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols: list[Column] = []
    misfits: list[Column] = []
    for f in declared.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            cols.append(F.col(f.name))
        else:
            casted = F.col(f.name).try_cast(f.dataType)
            cols.append(casted.alias(f.name))
            misfits.append(F.when(F.col(f.name).isNotNull() & casted.isNull(), F.col(f.name).cast("string")).alias(f.name))
    declared_names = {f.name for f in declared.fields}
    for c in df.columns:
        if c not in declared_names and c != "_metadata":
            misfits.append(F.col(c).cast("string").alias(c))
    if misfits:
        js = F.to_json(F.struct(*misfits))
        rescue = F.when(js != F.lit("{}"), js)
    else:
        rescue = F.lit(None).cast("string")
    return df.select(*cols, rescue.alias(RESCUE_COL), F.col("_metadata.file_path").alias(SOURCE_FILE_COL))


def conform_json(lines: DataFrame, declared: StructType) -> DataFrame:
    """Lines of JSON text (``value``) cast to ``declared``, from one parse; the rest into the rescue column."""
    rows = lines.where(F.trim("value") != "").withColumn("__m", F.from_json("value", "map<string,string>"))
    names = [f.name for f in declared.fields]
    columns, misfits = [], []
    for f in declared.fields:
        text = F.try_element_at("__m", F.lit(f.name))
        value = text.try_cast(f.dataType)
        columns.append(value.alias(f.name))
        misfits.append(F.when(text.isNotNull() & value.isNull(), F.lit(f.name)))
    wrong = F.array_compact(F.array(*misfits))
    rest = F.map_filter("__m", lambda k, _: ~k.isin(names) | F.array_contains(wrong, k))
    rescue = F.when(F.col("__m").isNull(), F.to_json(F.create_map(F.lit(CORRUPT), F.col("value")))).when(F.size(rest) > 0, F.to_json(rest))
    return rows.select(*columns, rescue.alias(RESCUE_COL), F.col(SOURCE_FILE_COL))


def read_rescued(spark: SparkSession, groups: Sequence[tuple[StructType | None, list[str]]], spec: TableSpec, fmt: str = "parquet") -> DataFrame | None:
    """Bronze rows (declared columns + provenance + rescue) of files in groups of one schema (JSON: of any)."""
    declared = spec.change_schema()
    out = None
    for schema, paths in groups:
        if fmt == "parquet":
            part = conform(spark.read.schema(schema).parquet(*paths), declared)
        elif fmt == "json":
            part = conform_json(spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias(SOURCE_FILE_COL)), declared)
        else:
            raise ValueError(f"no rescue reader for {fmt!r}")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return None
    return out.withColumn(INGESTED_AT_COL, F.current_timestamp()).select(
        *[f.name for f in declared.fields], INGESTED_AT_COL, SOURCE_FILE_COL, RESCUE_COL
    )
