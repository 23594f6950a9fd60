"""Spelling variants by pivotal grams.

Two words are near when exactly one character is inserted, deleted or replaced
between them. Bigrams are ordered from rare to frequent; a word's prefix is its
rarest bigrams, ``PREFIX`` at least (with all that tie with the last), and its two
pivots are the pair of disjoint bigrams in the prefix that the fewest words are
expected to share, by dynamic programming. One edit spoils one of two disjoint bigrams at most, and of two near
words, the one whose prefix ends first has a pivot in the prefix of the other. So
pivots are indexed, and prefixes look them up.

Position limits make the keys selective. The edit lies either before the second
pivot or behind the first, so either all from the second pivot on is equal in both
words (same place from the end), or all up to the first one is (same place from
the start). The key is that equal part, with the side and the word's length.
Words that share a key are verified within the join: by the letters that occur an
odd number of times, two of which may differ at most, then by their edit distance.

Defined cases: a null text has no words; repeated texts count again; a null id is
written as the empty text; no words, or none near another, give no forms; words
of any length are compared whole; ties go to the word that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, ship, stored

LEAST_CHARS = 7
LEAST_COUNT = 2
DOMINANCE = 10  # a form occurs at least this many times as often as its variant
SLIP = 31  # of so many runs one loses a character
PREFIX = 5  # three (bigram length x one edit + 1) would do; more give the pivots a choice
NARROWING = 8  # about how many times fewer words share a part that is one character longer
CLASSES = 1 << 16  # frequencies are kept for this many classes of bigrams, so their table has a fixed size


def runs_of_letters(docs: DataFrame, least: int = LEAST_CHARS, slip: int = SLIP) -> DataFrame:
    """(word): every run of letters, lower-cased in A-Z, one of ``slip`` (by its document and spelling) without one character."""
    if least < 4:
        raise ValueError("words of fewer than four characters have no three bigrams")
    # a run of fewer characters can't give a word, and no such part of a longer run starts a match
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))).alias("run"))
    runs = runs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), ascii_lower(F.col("run")).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return runs.select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run")).alias("word"))


def counted_words(docs: DataFrame, least: int = LEAST_CHARS, least_count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): the distinct words of at least ``least`` characters that occur ``least_count`` times or more."""
    words = runs_of_letters(docs, least, slip).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return stored(words.where((F.char_length("word") >= least) & (F.col("n") >= least_count)), "variant-words")


def _class_of(gram):
    return F.pmod(F.xxhash64(gram), F.lit(CLASSES)).cast("int")


def gram_frequencies(words: DataFrame) -> np.ndarray:
    """How many words' places hold a bigram of each class: ``CLASSES`` numbers, whatever the number of words."""
    at = F.explode(F.sequence(F.lit(1), F.char_length("word") - 1)).alias("at")
    classes = words.select("word", at).select(_class_of(F.substring("word", F.col("at"), F.lit(2))).alias("class"))
    counts = np.zeros(CLASSES, dtype=np.int64)
    for r in classes.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect():  # at most CLASSES rows
        counts[r["class"]] = r["n"]
    return counts


def prefix_of(order: list) -> list[int]:
    """Places of the rarest bigrams, ``PREFIX`` at least, with all that tie with the last; ``order`` has a rank for each place."""
    if len(order) <= PREFIX:
        return list(range(len(order)))
    last = sorted(order)[PREFIX - 1]
    return [p for p, rank in enumerate(order) if rank <= last]


def pivots_of(prefix: list[int], costs: list[list[float]]) -> list[int]:
    """As many disjoint bigrams among the places ``prefix`` (ascending) as there are ``costs``, whose costs add up to the least.

    ``costs[k][p]`` is what place p costs as the k-th pivot. best[k] holds, over the
    places walked so far, the cheapest choice of k disjoint bigrams; a place two or
    more behind the last one chosen may follow it.
    """
    best: list[list[tuple[float, tuple[int, ...]]]] = []  # for each place, its best choices of 0, 1, ... bigrams
    for i, p in enumerate(prefix):
        row: list[tuple[float, tuple[int, ...]]] = [(0, ())]
        j = next((j for j in range(i - 1, -1, -1) if prefix[j] <= p - 2), None)
        for k in range(1, len(costs) + 1):
            options = [best[i - 1][k]] if i and len(best[i - 1]) > k else []
            base = (0, ()) if k == 1 else best[j][k - 1] if j is not None and len(best[j]) > k - 1 else None
            if base is not None:
                options.append((base[0] + costs[k - 1][p], base[1] + (p,)))
            if not options:
                break
            row.append(min(options))
        best.append(row)
    return list(best[-1][-1][1]) if best and len(best[-1]) > len(costs) else []


def pivot_costs(counts: list[int]) -> list[list[float]]:
    """What a bigram costs as first and as second pivot: how often it occurs, less the longer the part that its key compares."""
    last = len(counts) - 1
    return [[c / NARROWING**p for p, c in enumerate(counts)], [c / NARROWING ** (last - p) for p, c in enumerate(counts)]]


def odd_letters(word: str) -> int:
    """Which characters (modulo 64) occur an odd number of times, as 64 signed bits: one edit alters two of them at most."""
    bits = 0
    for c in word:
        bits ^= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def with_grams(words: DataFrame) -> DataFrame:
    """(word, n, letters, prefix, first, second): odd letters, places of the prefix bigrams and of the two pivots, from 0."""
    ship(words.sparkSession)
    counts = gram_frequencies(words)
    classes = F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda p: _class_of(F.substring("word", p, F.lit(2))))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, prefixes, first, second = [], [], [], []
            for word, of in zip(batch["word"].to_pylist(), batch["classes"].to_pylist()):
                often = counts[of].tolist()
                prefix = prefix_of([(c, word[p : p + 2]) for p, c in enumerate(often)])
                a, b = pivots_of(prefix, pivot_costs(often))
                letters.append(odd_letters(word))
                prefixes.append(prefix)
                first.append(a)
                second.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch["word"], batch["n"], pa.array(letters, pa.int64()), pa.array(prefixes, pa.list_(pa.int32())), pa.array(first, pa.int32()), pa.array(second, pa.int32())],
                names=["word", "n", "letters", "prefix", "first", "second"],
            )

    chosen = words.select("word", "n", classes.alias("classes")).mapInArrow(choose, "word string, n long, letters long, prefix array<int>, first int, second int")
    return stored(chosen, "variant-grams")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of near words, once. ``words`` are distinct and have four characters or more."""
    grams = with_grams(words)
    chars = F.char_length("word")

    def upto(p):
        return F.struct(F.lit(0).alias("side"), F.substring(F.col("word"), F.lit(1), p + 2).alias("part"))

    def onward(p):
        return F.struct(F.lit(1).alias("side"), F.substring(F.col("word"), p + 1, chars).alias("part"))

    index = grams.select("word", "n", "letters", chars.alias("chars"), F.explode(F.array(upto(F.col("first")), onward(F.col("second")))).alias("k"))
    index = index.select(F.xxhash64("k.side", "k.part", "chars").alias("key"), "word", "n", "letters")
    sides = F.explode(F.concat(F.transform("prefix", upto), F.transform("prefix", onward))).alias("k")
    probes = grams.select("word", "n", "letters", sides, F.array(chars - 1, chars, chars + 1).alias("lengths"))
    probes = probes.select("k", "word", "n", "letters", F.explode("lengths").alias("chars"))
    probes = probes.select(F.xxhash64("k.side", "k.part", "chars").alias("p_key"), F.col("word").alias("p_word"), F.col("n").alias("p_n"), F.col("letters").alias("p_letters"))
    alike = F.bit_count(F.col("letters").bitwiseXOR(F.col("p_letters"))) <= 2
    one_edit = F.when(alike, (F.col("word") != F.col("p_word")) & (F.levenshtein("word", "p_word", 1) == 1)).otherwise(F.lit(False))
    met = index.join(probes, (F.col("key") == F.col("p_key")) & one_edit)
    both = F.explode(
        F.array(
            F.struct(F.col("word").alias("word"), F.col("p_word").alias("near"), F.col("p_n").alias("near_n")),
            F.struct(F.col("p_word").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
        )
    ).alias("pair")
    return met.select(both).select("pair.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): for each (word, form), the last word on the way from form to form.

    A form is at least ``DOMINANCE`` times as frequent as its word, so the way ends;
    each round doubles the steps taken and is written to the shared folder.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        then = now.join(further, now["root"] == further["at"], "left")
        then = stored(then.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        if not then.where("moved").head(1):
            return then.select("word", "root")
        now = then.select("word", "root")


def variant_forms(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``words`` (word, n) with form, root, n_near and form_n.

    A word's form is its most frequent near word, if that occurs at least
    ``dominance`` times as often; its root is the form's form, and so on.
    """
    if dominance <= 1:
        raise ValueError("a form must occur more often than its word")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    found = words.join(near, "word", "left")
    dominant = -F.col("best.less") >= F.col("n") * dominance
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(dominant, F.col("best.near")).alias("form"),
        F.when(dominant, -F.col("best.less")).alias("form_n"),
    )
    found = stored(found, "variant-forms")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
