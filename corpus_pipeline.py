"""From raw documents to training sequences: five stages, each calling one operator of ``tidewater.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and hands the reread table to the next stage.
All stages but the last return the columns of ``documents``, whatever further
columns it has; the operators see those under names of their own.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import common, decontaminate, langid, linededup, nearup, packing

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# No SQL can state language ID by a trained model; tests hold the run against brute force.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shielded(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but doc_id and text under neutral names, and those names by the old ones."""
    names = {c: c if c in ("doc_id", "text") else f"_own_{i}" for i, c in enumerate(docs.columns)}
    return docs.select([F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def _restored(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select([F.col(n).alias(c) for c, n in names.items()])


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or with no language that holds half of their letters, go."""
    return langid.accepted(docs, langid.fit(docs.select("doc_id", "text", "lang")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of equal or nearly equal lines only the first stays; documents that lose all their text go."""
    rows, names = _shielded(docs)
    return _restored(linededup.drop_repeated_lines(rows, names.get("n_chars")), names)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id stays."""
    rows, names = _shielded(docs)
    return _restored(nearup.one_of_each_class(rows), names)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold any phrase of a benchmark item go."""
    rows, names = _shielded(docs)
    found = decontaminate.contamination(rows, common.table(spark, sf_dir, "benchmark"))
    return _restored(found.where("n_hit = 0"), names)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.packed(packing.tokenised_pieces(docs.select("doc_id", "text"), TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("language id", in_a_language),
    ("line dedup", without_repeated_lines),
    ("near dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
