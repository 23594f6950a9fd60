"""The registered queries of this package: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, extract, langid, linededup, mixing, nearup, packing, pii, ppm, ranked, topk, variants
from .common import stored, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each distinct line of the corpus: its copies, its links and its class."""
    lines = linededup.line_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = stored(lines.withColumn("line_md5", F.lower(F.hex("line_key"))), "line-classes")
    names = lines.where("n_links > 0").groupBy("comp").agg(F.min("line_md5").alias("class_md5"))
    return lines.join(names, "comp", "left").select(
        "line_md5", "doc_id", F.col("copies").alias("n_copies"), "n_links", F.coalesce("class_md5", "line_md5").alias("class_md5")
    )


@register
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its offset there."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(packing.tokenised_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


@register
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest document of its class of near copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return nearup.with_classes(docs).select("doc_id", "class_id", (~F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("duplicate"))


@register
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language; learned from the other folds."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


@register
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows by inner product for every row whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@register
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by the byte model and by the word counts of the training fold."""
    return ppm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], rows.schema))
    return chat.read_back(chat.formatted(chat.turns_of_table(rows, "conv_id")))


@register
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    found = extract.extracted(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@register
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: base matches and what the trees add."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.found(docs, pii.learn(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


@register
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with its form, its root and the number of its near words."""
    words = variants.counted_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return variants.variant_forms(words).select("word", "form", "root", "n", "n_near", "form_n")


@register
def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what a mix of its source's weight takes of it."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        "source",
        mixing.word_count(F.col("text")).alias("size"),
        mixing.letter_share(F.col("text")).alias("quality"),
        mixing.row_digest(F.col("doc_id"), F.col("text")).alias("digest"),
    )
    found = mixing.mixed(rows, F.col("source"), F.col("size"), F.col("quality"), F.col("digest"))
    return found.select("row.doc_id", "size", "source_size", "target", "taken")


@register
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked.ranked(docs, table(spark, sf_dir, "benchmark").select("item_id", "text")).select("item_id", "rank", "doc_id", "score")
