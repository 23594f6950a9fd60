"""Small file-system helpers on the cluster's own file system (driver side, metadata and tiny files only)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """(file system, path object) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below ``path``, from one listing (empty if it does not exist)."""
    fs, p = hadoop(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return bool(fs.exists(p))


def total_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below ``path``."""
    fs, p = hadoop(spark, path)
    return int(fs.getContentSummary(p).getLength())


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; an existing one is an error."""
    fs, p = hadoop(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename in one step; an existing target is an error."""
    fs, p = hadoop(spark, target)
    if fs.exists(p) or not fs.rename(hadoop(spark, source)[1], p):
        raise FileExistsError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def numbered(spark: SparkSession, path: str, prefix: str, suffix: str = "") -> list[int]:
    """The numbers of children named ``<prefix><number><suffix>``, ascending, from one listing."""
    out = []
    for name in children(spark, path):
        middle = name[len(prefix) : len(name) - len(suffix)]
        if name.startswith(prefix) and name.endswith(suffix) and middle.isdigit():
            out.append(int(middle))
    return sorted(out)
