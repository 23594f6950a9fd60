"""Near-duplicate documents by Order MinHash and alignment.

A document is the sequence of its five-word shingles, each labelled with its
occurrence number, so repeats count. A sketch hashes all labelled shingles,
takes the smallest few and keeps them *in text order*: two documents share it
only if those shingles are common to both and stand in the same order, which
follows edit similarity and not just the overlap of sets. Documents that share
one of several sketches are candidates; a banded alignment of the two shingle
sequences then tells how many shingles they share in order, and a pair is linked
when those are at least 0.8 of all shingles of the two (shared ones counted once).
The band is exact: a linked pair lacks so few shingles on either side that its best
alignment never leaves it.

Copies of a text are folded first. In every bucket of a sketch all members are
compared with one of them, and after the components of those links only pairs
whose members are still in different components: a group of near copies costs
its size, not its square, and no link between components is lost. Fingerprints of
fixed size keep pairs that can't be similar out of the joins: up to ``PARITY_MOST``
shingles a bitmap of parities, whose differing bits are at most the shingles that
differ, which loses no pair; for longer texts bits of the smallest shingles of bins.

Defined cases: a null text, or one without a word, is like no other; a text of
fewer than five words is one shingle; the class id is the smallest doc_id of the
class (null only if all are); rows with the same text share a class; an empty table
has no classes; columns other than ``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flag_members, ship, stored, text_key, union_all
from .graph import components

SHINGLE = 5
SIMILARITY = 0.8
# (from so many shingles on, shingles kept in a sketch, sketches): at a similarity of 0.8 a pair
# of any length misses all of them with a probability below 0.00001; see ``tiers`` and the test
TIERS = ((40, 8, 80), (12, 4, 28), (1, 1, 8))
BINS = 1024  # bits of a print
# texts of so many shingles have signs of bins, and of so many parities; similar texts have one of them in common
SIGNS_LEAST, PARITY_MOST = 1000, 1250
# just similar texts differ in a tenth of their signs (every fifth bin, every other time by chance); more than
# so many is four and a half standard deviations away, a probability below 0.00001
MOST_SIGNS = 146

_M = np.uint64(0x9E3779B97F4A7C15)
_CACHE_WORDS = 300_000
_MOST_BITS = 400_000_000


class _WordHash(dict):
    """64-bit hashes of words, emptied when it has grown large."""

    def __missing__(self, word):
        if len(self) > _CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHash()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` lower-case words, in order; one hash for a shorter text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    k = min(size, n)
    out = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        out = out * _M + w[j : n - k + 1 + j]
    return _mixed(out)


def labelled(sh: np.ndarray) -> np.ndarray:
    """Each shingle's hash together with how often it occurred before."""
    order = np.argsort(sh, kind="stable")
    run = sh[order]
    new = np.empty(len(run), bool)
    new[:1] = True
    np.not_equal(run[1:], run[:-1], out=new[1:])
    if new.all():
        return sh
    at = np.arange(len(run))
    before = np.empty(len(run), np.uint64)
    before[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.where(before == 0, sh, _mixed(sh + before * _M))  # a first one looks the same in a text without repeats


def tiers(n: int) -> list[tuple[int, int]]:
    """(picked, sketches) of a text with ``n`` shingles: those of every length that a similar text can have."""
    low, high = int(SIMILARITY * n), int(n / SIMILARITY) + 1
    out, above = [], 1 << 62
    for least, picked, sketches in TIERS:
        if high >= least and low < above:
            out.append((picked, sketches))
        above = least
    return out


def all_sketches(sh: np.ndarray) -> np.ndarray:
    """A text's sketches of all its tiers."""
    return np.concatenate([order_minhash(sh, sketches, picked) for picked, sketches in tiers(len(sh))])


def order_minhash(sh: np.ndarray, sketches: int, picked: int) -> np.ndarray:
    """One hash per sketch: the ``picked`` labelled shingles that come first in its permutation, in text order."""
    x = labelled(sh)
    n, k = len(x), min(picked, len(x))
    seeds = _mixed(np.arange(1, sketches + 1, dtype=np.uint64) * _M + np.uint64(picked))
    out = np.empty(sketches, np.uint64)
    step = max(1, 1_000_000 // n)
    for lo in range(0, sketches, step):
        s = seeds[lo : lo + step, None]
        if k < n:
            y = (x[None, :] ^ s) * (s | np.uint64(1))
            y ^= y >> np.uint64(32)
            y *= np.uint64(0xD6E8FEB86659FD93)
            first = np.sort(np.argpartition(y, k - 1, axis=1)[:, :k], axis=1)
        else:
            first = np.broadcast_to(np.arange(n), (len(s), n))
        h = s[:, 0].copy()
        for j in range(k):
            h = _mixed(h + x[first[:, j]])
        out[lo : lo + step] = h
    return out


def _bits(odd: np.ndarray) -> np.ndarray:
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def signs(sh: np.ndarray) -> np.ndarray:
    """1024 bits in sixteen numbers: of each bin by hash, a bit of its smallest shingle, 0 if it is empty."""
    h = np.sort(_mixed(labelled(sh) ^ _M))
    numbers = np.arange(BINS, dtype=np.uint64)
    least = h[np.minimum(np.searchsorted(h, numbers << np.uint64(54)), len(h) - 1)]
    return _bits((least >> np.uint64(54) == numbers) & (least >> np.uint64(8) & np.uint64(1) == 1))


def parities(sh: np.ndarray) -> np.ndarray:
    """1024 bits in sixteen numbers: of each bin by hash, whether its number of labelled shingles is odd."""
    return _bits(np.bincount((labelled(sh) >> np.uint64(54)).astype(np.int64), minlength=BINS) & 1)


def may_be_similar(a: Column, b: Column) -> Column:
    """Whether two texts' prints (n, parities, signs) allow that they are similar.

    A shingle that only one text has turns one bit of its parities, so the bits that
    differ never outnumber the shingles that differ. A bin has another sign only if its
    smallest shingle is not in both texts. The expression is short on purpose: inside
    a join it has to fit into one compiled method.
    """

    def differing(name: str) -> Column:
        return sum((F.bit_count(F.get(a[name], F.lit(i)).bitwiseXOR(F.get(b[name], F.lit(i)))) for i in range(BINS // 64)), F.lit(0))

    both = a["n"] + b["n"]
    need = F.ceil(F.lit(SIMILARITY) * both / F.lit(1 + SIMILARITY) - F.lit(1e-9))
    alike = F.coalesce(differing("parities") <= both - 2 * need, differing("signs") <= F.lit(MOST_SIGNS), F.lit(True))
    return (F.least(a["n"], b["n"]) >= F.lit(SIMILARITY) * F.greatest(a["n"], b["n"]) - F.lit(1e-9)) & alike


def banded_distance(a: list[int], b: list[int], limit: int) -> int:
    """Edits between two sequences if at most ``limit``, else some larger number.

    Bit-parallel on the band of ``limit`` diagonals either way: the cells of a
    column are bits of two integers that say where a cell is one more or one less
    than the cell above.
    """
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if m - n > limit:
        return limit + 1
    if n <= limit:  # the band must fit into a column; the same prefix on both sides adds no edits
        pad = [-1] * (limit + 1)
        return banded_distance(pad + a, pad + b, limit)
    places: dict[int, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << i)
    width = 2 * limit + 2
    ones, top = (1 << width) - 1, 1 << (width - 1)
    up, down, dist = ones ^ ((1 << (width - 1 - limit)) - 1), 0, limit
    low = limit - width + 1  # row of bit 0 in column 0, counted from 1
    for j, c in enumerate(b, 1):
        same, start = places.get(c, 0), low + j - 1
        same = (same >> start if start >= 0 else same << -start) & ones
        d = ((((same & up) + up) ^ up) | same | down) & ones
        right, left = down | (ones ^ (d | up)), d & up
        past = j - (n - limit)
        if past <= 0:
            if not d & top:
                dist += 1
                if dist > 3 * limit:
                    return limit + 1
        else:
            last = top >> past
            dist += bool(right & last) - bool(left & last)
        moved = d >> 1
        up, down = (left | (ones ^ (moved | right))) & ones, moved & right
    return dist


def _by_matches(matches: list[list[int]]) -> int:
    """Longest common subsequence from every element's places in the other sequence, last place first."""
    ends: list[int] = []
    for places in matches:
        for j in places:
            k = bisect_left(ends, j)
            ends[k : k + 1] = [j]
    return len(ends)


def _by_bits(matches: list[tuple[int, list[int]]], below: int, above: int) -> int:
    """The same, bit-parallel in the band: a zero bit is a place where the subsequence grows.

    ``matches`` has the places (first place first) of the elements at ascending positions.
    The window of places that an element can pair with moves along with its position;
    what leaves it below is final, what enters above has not been met.
    """
    width = below + above + 1
    grows = ones = (1 << width) - 1
    low, grown = -below, 0
    masks: dict[int, int] = {}
    for i, places in matches:
        step = i - below - low
        if step >= width:
            grown += width - grows.bit_count()
            grows = ones
        elif step:
            grown += step - (grows & ((1 << step) - 1)).bit_count()
            grows = (grows >> step) | (ones ^ (ones >> step))
        low += step
        key = id(places)
        if key not in masks:  # counted from its first place
            bits = bytearray((places[-1] - places[0]) // 8 + 1)
            for j in places:
                bits[(j - places[0]) >> 3] |= 1 << ((j - places[0]) & 7)
            masks[key] = int.from_bytes(bits, "little")
        shift = places[0] - low
        own = masks[key] << shift if 0 <= shift < width else masks[key] >> -shift if shift < 0 else 0
        met = grows & own
        grows = ((grows + met) | (grows - met)) & ones
    return grown + width - grows.bit_count()


def paired(a: np.ndarray, b: np.ndarray, need: int = 0) -> int:
    """How many shingles a banded alignment of the two sequences pairs up.

    That is their longest common subsequence if it has ``need`` elements or more, else
    perhaps less: with so many pairs at most len(a) - need elements of ``a`` and
    len(b) - need of ``b`` are left out, so no pair is further from the diagonal.
    """
    below, above = len(a) - need, len(b) - need
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short -= head
    differ = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if min(below, above) < 0 or not len(a) or not len(b):
        return head + tail
    at_a, at_b = np.flatnonzero(np.isin(a, b)).tolist(), np.flatnonzero(np.isin(b, a)).tolist()
    places: dict[int, list[int]] = {}
    for j, x in zip(at_b, b[at_b].tolist()):
        places.setdefault(x, []).append(j)
    matches = [(i, places[x]) for i, x in zip(at_a, a[at_a].tolist())]
    # shingles that repeat a lot have many places; without them, or where bits would fill the memory, a sorted list is better
    if sum(len(p) for _, p in matches) > 8 * len(a) and sum(p[-1] - p[0] for p in places.values()) <= _MOST_BITS:
        return head + tail + _by_bits(matches, below, above)
    near = [p[bisect_left(p, i - below) : bisect_right(p, i + above)][::-1] for i, p in matches]
    return head + tail + _by_matches(near)


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the shingles that an alignment pairs up are at least ``least`` of all, paired ones counted once."""
    need = math.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9)
    if min(len(a), len(b)) < need:
        return False
    common = np.intersect1d(labelled(a), labelled(b), assume_unique=True)
    return len(common) >= need and paired(a, b, need) >= need


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "doc_id", "n", "sketch", "parities", "signs"]
    for batch in batches:
        sizes, sketches, odd, least = [], [], [], []
        for text in batch.column("text").to_pylist():
            sh = shingles(text)
            sizes.append(len(sh))
            sketches.append(all_sketches(sh).view(np.int64) if len(sh) else [])
            odd.append(parities(sh).view(np.int64) if 0 < len(sh) <= PARITY_MOST else None)
            least.append(signs(sh).view(np.int64) if len(sh) >= SIGNS_LEAST else None)
        made = [pa.array(sizes, pa.int64()), *[pa.array(c, pa.list_(pa.int64())) for c in (sketches, odd, least)]]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), *made], names)


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = [similar(shingles(a), shingles(b)) for a, b in zip(pdf["text_a"], pdf["text_b"])]
        yield pdf.loc[keep, ["a", "b"]]


def sketched(docs: DataFrame) -> DataFrame:
    """(node, key, doc_id, copies, n, sketch, parities, signs): every distinct text with a word, numbered, with its smallest document and its number of rows."""
    ship(docs.sparkSession)
    rows = docs.where("text IS NOT NULL").select(text_key(F.col("text")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = rows.mapInArrow(_sketch, "key binary, doc_id long, n long, sketch array<long>, parities array<long>, signs array<long>").where("n > 0")
    folded = made.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n", "sketch", "parities", "signs")]
    )
    return stored(folded.withColumn("node", F.monotonically_increasing_id()), "sketches")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return stored(both.mapInPandas(_verify, "a long, b long"), "links")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """(key, comp, class_id, size): the class of every distinct text (by ``text_key``) that has a word, and the class's number of rows."""
    nodes = sketched(docs)
    prints = nodes.select("node", F.struct("n", "parities", "signs").alias("print"))
    members = nodes.select("node", F.explode("sketch").alias("bucket"))
    roots = members.groupBy("bucket").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(members.join(roots, "bucket").select("bucket", "node", "a"), "members")

    # one text for each candidate; ids with several texts or texts with several ids do no harm
    wanted = stored(members.select("node").distinct().join(nodes.select("node", "key", "doc_id"), "node"), "candidates")
    keyed = docs.where("text IS NOT NULL").select(text_key(F.col("text")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = flag_members(keyed, F.col("key"), wanted.select("key")).where("_maybe").drop("_maybe")
    texts = keyed.alias("t").join(wanted.alias("w"), (F.col("t.key") == F.col("w.key")) & F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")))
    texts = stored(texts.select("node", "text"), "candidate-texts").dropDuplicates(["node"])

    alike = may_be_similar(F.col("print_a"), F.col("print_b"))
    star = members.where("a <> node").select("a", F.col("node").alias("b")).distinct()
    star = star.join(prints.toDF("a", "print_a"), "a").join(prints.toDF("b", "print_b"), "b").where(alike)
    star = stored(star.select("a", "b"), "star-pairs")
    links = _verified(star, texts)

    label = components(links)
    # a bucket's pairs with its smallest text are decided; ``root`` tells them without looking them up
    placed = members.join(label, "node", "left").select("bucket", "node", (F.col("a") == F.col("node")).alias("root"), F.coalesce("comp", "node").alias("comp"))
    several = placed.groupBy("bucket").agg((F.min("comp") < F.max("comp")).alias("open")).where("open").select("bucket")
    placed = stored(placed.join(several, "bucket").join(prints, "node"), "placed")
    # components that meet in a bucket; those of one text only if the prints let them, inside the join
    comps = placed.groupBy("bucket", "comp").agg(
        F.when(F.count(F.lit(1)) == 1, F.first("print")).alias("print"), F.bool_and("root").alias("root")
    )
    comps = stored(comps, "meeting")
    left, right = comps.toDF("bucket", "comp_a", "print_a", "root_a"), comps.toDF("bucket_b", "comp_b", "print_b", "root_b")
    # a missing print is of a component of several texts, which are compared one by one below
    open_ = ~F.col("root_a") & ~F.col("root_b") & F.coalesce(alike, F.lit(True))
    across = left.join(right, (F.col("bucket") == F.col("bucket_b")) & (F.col("comp_a") < F.col("comp_b")) & open_).select("bucket", "comp_a", "comp_b", F.col("print_b").alias("only_b"))
    others = placed.where("NOT root")
    # members of the one component meet the other's only text at once, or all its members one by one
    one = others.select("bucket", "comp", "node", "print").toDF("bucket_x", "comp_x", "x", "print_x")
    two = others.select("bucket", "comp", "node", "print").toDF("bucket_y", "comp_y", "y", "print_y")
    alone = F.coalesce(may_be_similar(F.col("print_x"), F.col("only_b")), F.lit(True))
    rest = across.join(one, (F.col("bucket") == F.col("bucket_x")) & (F.col("comp_a") == F.col("comp_x")) & alone)
    alike = may_be_similar(F.col("print_x"), F.col("print_y"))
    rest = rest.join(two, (F.col("bucket") == F.col("bucket_y")) & (F.col("comp_b") == F.col("comp_y")) & alike)
    rest = stored(rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "rest-pairs")
    label = components(links.unionByName(_verified(rest, texts)))

    classed = nodes.select("node", "key", "doc_id", "copies").join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    names = classed.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("size"))
    return stored(classed.join(names, "comp").select("key", "comp", "class_id", "size"), "classes")


def with_classes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``class_id`` and ``comp``; a text that is like no other has its own doc_id and a null ``comp``."""
    classes = near_duplicate_classes(docs).withColumnRenamed("key", "_class_key").drop("size")
    rows = docs.withColumn("_key", text_key(F.col("text"))).join(classes, F.col("_key") == F.col("_class_key"), "left").drop("_key", "_class_key")
    return rows.withColumn("class_id", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")))


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """``docs`` without all but the first document (smallest id, one row) of each class of near copies."""
    own = {c: c if c in ("doc_id", "text") else f"d_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select([F.col(f"`{c}`").alias(n) for c, n in own.items()]).withColumn("_key", text_key(F.col("text")))
    classes = near_duplicate_classes(rows).where("size > 1").select(F.col("key").alias("_class_key"), "comp", "class_id")
    # texts that are alone stay where they are; the others are shuffled to meet their class
    rows = flag_members(rows, F.col("_key"), classes.select("_class_key"))
    met = rows.where("_maybe").join(classes, F.col("_key") == F.col("_class_key"), "left")
    first = met.where(F.col("comp").isNotNull() & F.col("doc_id").cast("long").eqNullSafe(F.col("class_id"))).dropDuplicates(["comp"])
    kept = [rows.where("NOT _maybe"), met.where("comp IS NULL"), first]
    return union_all([k.select([F.col(n).alias(c) for c, n in own.items()]) for k in kept])
