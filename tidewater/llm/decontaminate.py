"""Benchmark decontamination with a distributed positional inverted index.

The index holds one posting (text, term, position) for every place of the terms
that can decide a match. A test item's phrases are found by shifting the posting
lists of their rarest terms by the terms' offsets and intersecting them: hits of
one item on the same shift (document position minus item position) line up.
Shifts on which the two rarest terms of some phrase line up are then compared
with the document's words, so results are exact.

All of it is DataFrame operations.

Defined cases: a null text has no words; a null item id is written as the empty
string; rows with the same item id are one item with several texts; repeated
documents each get their own row; an empty table of items leaves all documents
clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, flag_members, stored, text_key

WINDOW = 10
# Terms whose keys are broadcast at a time: 16 bytes each, so some tens of MB in memory.
TERMS_PER_PASS = 200_000

# Fixed by the contract: everything but digits, letters and non-ASCII separates words.
_SPLIT_LOWER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPLIT_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _raw_words(text: Column) -> Column:
    """Words in their own case, with empty strings where a separator opens or ends the text."""
    return F.split(F.coalesce(text, F.lit("")), _SPLIT_ANY)


def lower_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _SPLIT_LOWER), "")


def test_items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words): the distinct texts with at least one word; ``item`` numbers them."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), lower_words(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0).distinct()
    return stored(items.withColumn("item", F.monotonically_increasing_id()), "items")


def term_counts(docs: DataFrame) -> DataFrame:
    """(raw, term, n): how often each written form occurs in all documents, and its lower-case term."""
    raw = docs.select(F.explode(_raw_words(F.col("text"))).alias("raw")).where("raw <> ''")
    forms = raw.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    return stored(forms.withColumn("term", ascii_lower(F.col("raw"))), "terms")


def anchors(items: DataFrame, forms: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The two rarest places of every phrase.

    Returns (item, place, term) for all such places, and (item, pairs), the
    phrases of an item as pairs of places (twice the same in a one-word phrase).
    A phrase with a word that no document has can't occur and is left out.
    """
    words = items.select("item", "item_id", F.size("words").alias("len"), F.posexplode("words").alias("place", "term"))
    counts = forms.groupBy("term").agg(F.sum("n").alias("n"))
    words = words.join(counts, "term")
    first = F.greatest(F.col("place") - F.lit(width - 1), F.lit(0))
    last = F.least(F.col("place"), F.greatest(F.col("len") - F.lit(width), F.lit(0)))
    spread = words.select("item", "len", "place", "n", F.explode(F.sequence(first, F.greatest(first, last))).alias("start"))
    phrases = spread.groupBy("item", "len", "start").agg(F.sort_array(F.collect_list(F.struct("n", "place"))).alias("by_rarity"))
    phrases = phrases.where(F.size("by_rarity") == F.least(F.col("len"), F.lit(width)))
    second = F.least(F.size("by_rarity"), F.lit(2))
    phrases = stored(
        phrases.select("item", F.col("by_rarity")[0]["place"].alias("a"), F.element_at("by_rarity", second)["place"].alias("b")).distinct(), "phrases"
    )
    places = phrases.select("item", F.explode(F.array("a", "b")).alias("place")).distinct()
    places = places.join(words.select("item", "place", "term"), ["item", "place"])
    return places, phrases.groupBy("item").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))


def postings(docs: DataFrame, forms: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, term, pos): the positional index of ``terms`` over all documents, written to the shared folder.

    The corpus is read once for every ``TERMS_PER_PASS`` written forms; only
    that many keys of fixed size are broadcast. A key is a 64-bit hash, so a
    posting may be wrong once in a great while; matches are compared by word.
    """
    chosen = stored(forms.join(terms.select("term").distinct(), "term").select(F.xxhash64("raw").alias("form"), "term"), "chosen")
    passes = chosen.count() // TERMS_PER_PASS + 1
    places = docs.select(text_key(F.col("text")).alias("key"), F.posexplode(_raw_words(F.col("text"))).alias("pos", "raw"))
    places = places.select("key", "pos", F.xxhash64("raw").alias("form"))
    parts = []
    for i in range(passes):
        part = chosen.where(F.pmod("form", F.lit(passes)) == i)
        parts.append(stored(places.join(F.broadcast(part), "form").select("key", "term", "pos"), "postings"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def aligned_hits(index: DataFrame, places: DataFrame) -> DataFrame:
    """(key, item, shift, hits): posting lists moved by their place in the item and gathered by shift."""
    moved = index.join(places, "term").select("key", "item", (F.col("pos") - F.col("place")).alias("shift"), "place")
    return moved.groupBy("key", "item", "shift").agg(F.collect_set("place").alias("hits"))


def phrase_candidates(hits: DataFrame, pairs: DataFrame) -> DataFrame:
    """The shifts on which both rarest words of some phrase of the item line up."""
    both = F.exists("pairs", lambda p: F.array_contains("hits", p["a"]) & F.array_contains("hits", p["b"]))
    return hits.join(pairs, "item").where(both).select("key", "item", "shift")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slack: int = 5, width: int = WINDOW) -> DataFrame:
    """(key, item_id, places): texts in which at least two rare words of an item keep their distance up to ``slack`` words.

    ``key`` is the text's identity (``text_key``), ``places`` the number of rare
    places of the item found together. Shifts are compared in overlapping bins of
    twice the slack, so any two hits within it meet in some bin.
    """
    items = test_items(benchmark)
    forms = term_counts(docs)
    places, _ = anchors(items, forms, width)
    hits = postings(docs, forms, places).join(places, "term").select("key", "item", (F.col("pos") - F.col("place")).alias("shift"), "place")
    size = max(1, slack)
    cell = F.floor(F.col("shift") / F.lit(size))
    near = hits.select("key", "item", "place", F.explode(F.array(cell, cell + 1)).alias("cell")).distinct()
    near = near.groupBy("key", "item", "cell").agg(F.count(F.lit(1)).alias("places")).where("places > 1")
    best = near.groupBy("key", "item").agg(F.max("places").alias("places"))
    return best.join(items.select("item", "item_id"), "item").groupBy("key", "item_id").agg(F.max("places").alias("places"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` with n_words, n_hit, item_ids (sorted strings of the items found).

    A word is hit when it lies in an occurrence of ``width`` consecutive words of
    an item (of the whole item, if that is shorter).
    """
    items = test_items(benchmark)
    forms = term_counts(docs)
    places, pairs = anchors(items, forms, width)
    found = phrase_candidates(aligned_hits(postings(docs, forms, places), places), pairs)
    found = found.join(items, "item").groupBy("key").agg(F.collect_list(F.struct("item_id", "shift", "words")).alias("_found"))
    found = stored(found, "found")
    # only documents that may hold something are shuffled to meet it
    flagged = flag_members(docs.withColumn("_key", text_key(F.col("text"))), F.col("_key"), found.select("key"))
    n_words = (F.size(_raw_words(F.col("text"))) - _blank_ends(F.col("text"))).cast("long").alias("n_words")
    clean = flagged.where("NOT _maybe").select(*docs.columns, n_words, F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"))
    rows = flagged.where("_maybe").join(found, F.col("_key") == F.col("key"), "left")
    # places count from the array that the index was built on, empty strings included
    has = F.col("_found").isNotNull()
    rows = rows.withColumn("_split", F.split(F.when(has, ascii_lower(F.coalesce("text", F.lit("")))), _SPLIT_LOWER))

    def starts(c):
        n = F.size(c["words"])
        size = F.least(n, F.lit(width))
        inside = F.filter(
            F.sequence(F.lit(0), n - size),
            lambda s: (s + c["shift"] >= 0) & (F.slice(F.col("_split"), F.greatest(s + c["shift"], F.lit(0)) + 1, size) == F.slice(c["words"], s + 1, size)),
        )
        return F.struct(c["item_id"].alias("item_id"), F.transform(inside, lambda s: s + c["shift"]).alias("at"), size.alias("size"))

    rows = rows.withColumn("_runs", F.filter(F.transform(F.coalesce("_found", F.array().cast(found.schema["_found"].dataType)), starts), lambda r: F.size(r["at"]) > 0))
    covered = F.flatten(F.transform("_runs", lambda r: F.flatten(F.transform(r["at"], lambda s: F.sequence(s, s + r["size"] - 1)))))
    return clean.unionByName(rows.select(
        *docs.columns,
        n_words,
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform("_runs", lambda r: r["item_id"]))).alias("item_ids"),
    ))


def _blank_ends(text: Column) -> Column:
    words = _raw_words(text)
    return F.when(F.size(words) == 1, (words[0] == "").cast("int")).otherwise(
        (words[0] == "").cast("int") + (F.element_at(words, -1) == "").cast("int")
    )
