"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a target number of words: its weight's share of the mix, but no
more than a multiple of what it holds; what goes beyond that is shared out again
by weight. A source whose target is one or more times its size gives whole epochs
of all its rows first. The rest is a sample without replacement: each row gets an
exponential key, -ln(u) / quality, rows are sorted by it within their source, and
the running sum of their sizes is cut at the budget; the row that the budget ends
in gives the words that are left of it, so a source meets its target to the word.

All of it is DataFrame operations. No source lies in one task: rows are range
partitioned by (source, key), summed inside the partitions, and the partitions'
sums (one row for each partition and each source in it) are summed in turn. u
comes from a digest of the row, so reruns agree.

Defined cases: a null source is a source of its own, the last one; rows without
words give none; a null, negative or unusable quality counts as the least one;
equal rows are rows of their own with equal keys, of which any may be the one cut;
an empty table, or one without words, gives targets of 0. The given columns come
back as one struct, so their names clash with nothing. A source with very many
rows of one digest is spread over several partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Fixed by the contract: source weights in order of the sources' names, the mix's share of all words, most epochs.
SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
LEAST_QUALITY = 1e-6

_PART = ["_part", "_none", "_source"]
_SOURCE = ["_none", "_source"]


def word_count(text: Column) -> Column:
    """Runs of anything but blank, tab, line and page breaks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Quality of a text between 0 and 1: the share of its characters that are basic letters."""
    text = F.coalesce(text, F.lit(""))
    chars = F.char_length(text)
    others = F.char_length(F.regexp_replace(text, "[A-Za-z]+", ""))
    return (chars - others + 1).cast("double") / (chars + 1).cast("double")


def row_digest(*columns: Column) -> Column:
    """128 bits that tell rows apart, as hex digits; nulls count as empty texts."""
    return F.md5(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]).cast("binary"))


def exponential_key(digest: Column, quality: Column) -> Column:
    """-ln(u) / quality with u strictly between 0 and 1 from the first 52 bits of ``digest``."""
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    usable = F.when((quality > LEAST_QUALITY) & (quality < float("inf")), quality).otherwise(F.lit(LEAST_QUALITY))
    return -F.log(u) / usable


def _ranged(rows: DataFrame, source: Column, size: Column, quality: Column, digest: Column) -> DataFrame:
    """Rows in range partitions by source and key, each with its partition's number, in the shared folder.

    Range bounds are sampled; the first write keeps that from evaluating the sizes
    twice, the second fixes which partition a row is in.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select(
        F.struct("*").alias("row"),
        source.isNull().alias("_none"),
        F.coalesce(source.cast("string"), F.lit("")).alias("_source"),
        F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("_size"),
        exponential_key(digest, quality.cast("double")).alias("_key"),
        digest.alias("_digest"),
        F.monotonically_increasing_id().alias("_spread"),  # splits rows of one digest, which may come in any order
    )
    keyed = stored(keyed, "mix-keys")
    ranged = keyed.repartitionByRange(n, "_none", "_source", "_key", "_digest", "_spread")
    return stored(ranged.withColumn("_part", F.spark_partition_id()), "mix-ranges")


def _in_order(sources: DataFrame) -> DataFrame:
    """``sources`` (_none, _source, first: the partition it starts in) with ``place``, from 0, null source last.

    Partitions are in order of source, so a source's place is the number of sources
    that start in earlier partitions and before it in its own.
    """
    starts = sources.groupBy("first").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1))  # a row a partition
    starts = starts.select("first", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy("first").orderBy("_none", "_source"))
    return sources.withColumn("inside", inside).join(starts, "first").withColumn("place", F.col("earlier") + F.col("inside") - 1)


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``sources`` (place, source_size) with ``target``: ``share`` of all sizes, by weight, none above ``most`` times its size.

    The targets are least(most * size, level * weight) for the one level at which
    they add up. Each round caps what the level lifts too high and shares the rest
    among the others; the level only rises, and the rounds end when no source is
    capped anew. The driver sees two sums a round.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    planned = stored(sources.withColumns({"weight": weight, "cap": F.col("source_size") * most}), "mix-sources")
    goal = share * float(planned.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        above = F.col("cap") <= F.col("weight") * level
        full, n, free = planned.agg(F.sum(F.when(above, F.col("cap"))), F.count_if(above), F.sum(F.when(~above, F.col("weight")))).first()
        if not free:
            level = float("inf")  # all sources are capped
        if not free or n == capped:
            break
        level, capped = (goal - (full or 0)) / free, n
    return planned.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)))


def mixed(
    rows: DataFrame,
    source: Column,
    size: Column,
    quality: Column,
    digest: Column,
    weights: Sequence[int] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
) -> DataFrame:
    """(row, size, source_size, target, taken): each of ``rows``, as a struct, with what the mix takes of it.

    ``taken`` counts words with repeats: a row of ``size`` words is given whole
    ``taken div size`` times, and its first ``taken mod size`` words once more.
    Rows travel whole through two shuffles: hand in the columns that are needed.
    """
    ranged = _ranged(rows, source, size, quality, digest)
    held = stored(ranged.groupBy(*_PART).agg(F.sum("_size").alias("held")), "mix-sums")
    sources = held.groupBy(*_SOURCE).agg(F.sum("held").alias("source_size"), F.min("_part").alias("first"))
    targets = source_targets(_in_order(sources), weights, share, most).select(*_SOURCE, "source_size", "target")
    words = F.floor(F.col("target") + 0.5).cast("long")
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(F.lit(0)))
    targets = targets.withColumn("budget", words - F.col("epochs") * F.col("source_size"))
    before = F.sum("held").over(Window.partitionBy(*_SOURCE).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    places = held.withColumn("before", F.coalesce(before, F.lit(0))).drop("held").join(targets, _SOURCE)
    inside = Window.partitionBy(*_PART).orderBy("_key", "_digest", "_spread").rowsBetween(Window.unboundedPreceding, -1)
    found = ranged.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(places, _PART)
    left = F.col("budget") - F.col("before") - F.col("_inside")
    taken = F.col("epochs") * F.col("_size") + F.greatest(F.least(left, F.col("_size")), F.lit(0))
    return found.select("row", F.col("_size").alias("size"), "source_size", "target", taken.alias("taken"))
