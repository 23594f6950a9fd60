"""Ranked lexical search over bit-sliced Bloom signatures.

Indexing gives every document a Bloom signature of its terms and of how often each
occurs (one entry for each count in ``COUNTS`` that the term reaches). Documents of
like signature size share a block, in which the signatures are stored by bit: row i
of a block is a bitmap of the documents with bit i set. A term's documents are the
intersection of its rows, which may hold too many documents but misses none, so the
sum over an item's terms of weight times the share of the highest count reached, at
the document's own length, is an upper bound of its score.

A search first scores the documents of the highest bounds exactly. The worst of an
item's best results so far is a floor under its final results; every document whose
bound reaches the floor is then scored exactly, all others are proven to be below.

Copies of a text have one score: they are found as rows but scored once.

Defined cases: a null text, or one without terms, is no document; rows with the
same item id are one item with the terms of all its distinct texts; a null item id
is an item like others; an item without terms has no results; equal scores go by
doc_id, null last; repeated rows are documents of their own. Texts of any length are
cut into terms piece by piece. Items are searched in blocks of at most
``ITEMS_PER_PASS`` items and ``TERMS_PER_PASS`` terms (or of one item with more).
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import flag_members, ship, stored, text_key

TOP = 20
FIRST_LOOK = 4 * TOP  # texts per item that are scored to find the floor
ITEMS_PER_PASS = 1000
TERMS_PER_PASS = 10_000

# The signature: bits by entries, hash functions, documents and cells of a block.
BITS_PER_ENTRY = 10  # rounded up to a power of two, so 10 to 20
HASHES = 6
BLOCK_DOCS = 1024
BLOCK_CELLS = 1 << 23
TERMS_AT_ONCE = 512  # terms that are looked up in a block together
PIECE = 1 << 20  # bytes of a text that are cut into terms at a time
COUNTS = sorted({1} | {c << s for s in range(38) for c in (2, 3)})  # 1, 2, 3, 4, 6, 8, 12, 16, 24, ...
ROW_GROUP = 16 << 20  # bytes of index rows that a reader holds at a time

# Fixed by the contract: ASCII but digits and letters separates terms; A-Z is lower-cased.
_TO_TERMS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c <= 0x2F or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c
    for c in range(256)
)


def term_counts(text: bytes | None) -> Counter:
    """How often each term occurs in a UTF-8 text, cut up in pieces of about ``PIECE`` bytes."""
    if not text:
        return Counter()
    if len(text) <= PIECE:
        return Counter(text.translate(_TO_TERMS).split())
    counts: Counter = Counter()
    rest = b""
    for i in range(0, len(text), PIECE):
        piece = rest + text[i : i + PIECE].translate(_TO_TERMS)
        if i + PIECE < len(text):
            end = piece.rfind(b" ") + 1  # the last term may go on
            piece, rest = piece[:end], piece[end:]
        counts.update(piece.split())
    return counts


def share(tf, m):
    """The contract's share of a term's weight, in whole numbers; works on numpy arrays as well."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def length_factor(n, docs: int, terms: int):
    return 75 + (25 * n * docs) // terms


def _entry_hashes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """64-bit entries for terms (by hash) that reach counts (by place in ``COUNTS``)."""
    with np.errstate(over="ignore"):
        x = hashes + (counts.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rows_of(entries: np.ndarray, bits: int) -> np.ndarray:
    """The ``HASHES`` rows of each entry among ``bits`` (a power of two), by double hashing."""
    with np.errstate(over="ignore"):
        step = (entries >> np.uint64(32)) | np.uint64(1)
        rows = entries[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)[None, :]
    return (rows & np.uint64(bits - 1)).astype(np.int64)


def term_hash(term: bytes) -> int:
    """64 bits of a term, the same in every process."""
    import xxhash

    return xxhash.xxh3_64_intdigest(term)


_REACHED = np.array(COUNTS, dtype=np.int64)
INDEX_SCHEMA = "bits long, docs int, doc_ids array<long>, keys binary, lengths array<long>, rows binary"


def _block(bits: int, docs: list[tuple]) -> pa.RecordBatch:
    """One index row: the documents' ids, text keys and lengths, and their signatures by bit."""
    n = len(docs)
    cells = np.zeros((bits, (n + 7) // 8 * 8), dtype=np.uint8)
    for i, (_, _, _, entries) in enumerate(docs):
        cells[_rows_of(entries, bits).ravel(), i] = 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array([bits], pa.int64()),
            pa.array([n], pa.int32()),
            pa.array([[d[0] for d in docs]], pa.list_(pa.int64())),
            pa.array([b"".join(d[1] for d in docs)], pa.binary()),
            pa.array([[d[2] for d in docs]], pa.list_(pa.int64())),
            pa.array([np.packbits(cells, axis=1).tobytes()], pa.binary()),
        ],
        names=["bits", "docs", "doc_ids", "keys", "lengths", "rows"],
    )


def build_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, key, text as bytes) to index rows, one open block for each signature size."""
    open_blocks: dict[int, list[tuple]] = {}
    for batch in batches:
        ids, keys = batch["doc_id"].to_pylist(), batch["key"].to_pylist()
        for i, text in enumerate(batch["text"]):
            counts = term_counts(text.as_py())
            if not counts:
                continue
            hashes = np.fromiter(map(term_hash, counts), dtype=np.uint64, count=len(counts))
            tf = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
            reached = np.searchsorted(_REACHED, tf, side="right")
            first = np.cumsum(reached) - reached
            levels = np.arange(int(reached.sum())) - np.repeat(first, reached)
            entries = _entry_hashes(np.repeat(hashes, reached), levels)
            bits = max(64, 1 << int(len(entries) * BITS_PER_ENTRY - 1).bit_length())
            block = open_blocks.setdefault(bits, [])
            block.append((ids[i], keys[i], int(tf.sum()), entries))
            if len(block) >= max(8, min(BLOCK_DOCS, BLOCK_CELLS // bits)):
                yield _block(bits, open_blocks.pop(bits))
    for bits, block in open_blocks.items():
        yield _block(bits, block)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), F.col("text").cast("binary").alias("text"))


def signature_index(docs: DataFrame) -> DataFrame:
    """The bit-sliced index of all documents with a term, in the shared folder: a row for each block."""
    ship(docs.sparkSession)
    return stored(_keyed(docs).mapInArrow(build_blocks, INDEX_SCHEMA), "signatures", **{"parquet.block.size": ROW_GROUP})


def document_frequencies(docs: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """In how many documents each of ``terms`` occurs; exact, unlike the index. One row a term and task is shuffled."""
    known = docs.sparkSession.sparkContext.broadcast(frozenset(terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(known.value.intersection(term_counts(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["term", "n"])

    counted = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "term binary, n long")
    return {bytes(r["term"]): r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # at most a row a term


class Items:
    """One pass's items with their terms' weights: item number -> [(term, weight, repeats)]."""

    def __init__(self, terms: dict[int, Counter], df: dict[bytes, int], docs: int, total: int):
        weight = {t: _weight(df.get(t, 0), docs) for t in {t for c in terms.values() for t in c}}
        self.docs, self.total = docs, total
        self.wanted = {i: [(t, weight[t] * r) for t, r in c.items() if t in df] for i, c in terms.items()}
        held = sorted({t for c in self.wanted.values() for t, _ in c})
        place = {t: k for k, t in enumerate(held)}
        self.hashes = np.array([term_hash(t) for t in held], dtype=np.uint64)
        self.places = {
            i: (np.array([place[t] for t, _ in c], dtype=np.int64), np.array([w for _, w in c], dtype=np.int64)) for i, c in self.wanted.items() if c
        }

    def score(self, item: int, counts: Counter, length: int) -> int:
        m = length_factor(length, self.docs, self.total)
        return sum(w * share(counts[t], m) for t, w in self.wanted[item] if t in counts)


def _weight(df: int, docs: int) -> int:
    return int(np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))))


def _reached_counts(rows: np.ndarray, hashes: np.ndarray, bits: int, n: int) -> np.ndarray:
    """For each term (by hash) and document of a block, how many of ``COUNTS`` the term may reach there, from 0."""
    reached = np.zeros((len(hashes), n), dtype=np.int64)
    alive = np.arange(len(hashes))
    for level in range(len(COUNTS)):
        slices = _rows_of(_entry_hashes(hashes[alive], np.full(len(alive), level)), bits)
        held = np.bitwise_and.reduce(rows[slices], axis=1)
        some = held.any(axis=1)
        alive, held = alive[some], held[some]
        # a document that lacks a lower count can't have a higher one
        here = np.unpackbits(held, axis=1)[:, :n].astype(bool) & (reached[alive] == level)
        reached[alive] += here
        alive = alive[here.any(axis=1)]
        if not len(alive):
            break
    return reached


def bounds_in_block(items: Items, row: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(item, upper bounds of all documents of an index row), for the items with a bound above 0."""
    bits, n = row["bits"], row["docs"]
    rows = np.frombuffer(row["rows"], dtype=np.uint8).reshape(bits, -1)
    m = length_factor(np.asarray(row["lengths"], dtype=np.int64), items.docs, items.total)
    shares = np.zeros((len(items.hashes), n), dtype=np.int64)
    for i in range(0, len(items.hashes), TERMS_AT_ONCE):
        reached = _reached_counts(rows, items.hashes[i : i + TERMS_AT_ONCE], bits, n)
        # a term that reaches a count occurs less often than the next one says
        for level in range(1, int(reached.max(initial=0)) + 1):
            t, d = np.nonzero(reached == level)
            shares[i + t, d] = share(COUNTS[min(level, len(COUNTS) - 1)] - 1, m)[d]
    found = shares.any(axis=1)
    for item, (places, weights) in items.places.items():
        here = found[places]
        if here.any():
            yield item, weights[here] @ shares[places[here]]


def _index_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch[name][i].as_py() for name in batch.schema.names}


def _pairs_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    types = [pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["item", "key", "doc_id", "bound"])


PAIRS_SCHEMA = "item int, key binary, doc_id long, bound long"


def most_promising(index: DataFrame, items, texts: int = FIRST_LOOK) -> DataFrame:
    """(item, key, doc_id, bound): for each item, rows of the texts with the highest bounds; ``texts`` of them, copies folded."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list] = {}
        held: dict[int, set] = {}
        for row in _index_rows(batches):
            keys = row["keys"]
            for item, bounds in bounds_in_block(items.value, row):
                heap, seen = heaps.setdefault(item, []), held.setdefault(item, set())
                better = np.flatnonzero(bounds > (heap[0][0] if len(heap) >= texts else 0))
                for d in better[np.argsort(-bounds[better], kind="stable")]:
                    key, bound = keys[16 * d : 16 * d + 16], int(bounds[d])
                    if len(heap) >= texts and bound <= heap[0][0]:
                        break
                    if key in seen:
                        continue
                    seen.add(key)
                    heapq.heappush(heap, (bound, key, row["doc_ids"][d]))
                    if len(heap) > texts:
                        seen.discard(heapq.heappop(heap)[1])
        yield _pairs_batch([(item, key, doc_id, bound) for item, heap in heaps.items() for bound, key, doc_id in heap])

    found = index.mapInArrow(look, PAIRS_SCHEMA)
    found = found.groupBy("item", "key").agg(F.min("doc_id").alias("doc_id"), F.max("bound").alias("bound"))
    best = Window.partitionBy("item").orderBy(F.desc("bound"), "key")
    return found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= texts).drop("r")


def not_excluded(index: DataFrame, items, floors, top: int = TOP) -> DataFrame:
    """(item, key, doc_id, bound): all rows whose bound reaches the item's floor, at most ``top`` (smallest ids) of a text's copies.

    More than that many copies can't be among the best, as they all have one score.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _index_rows(batches):
            out = []
            ids, keys = row["doc_ids"], row["keys"]
            for item, bounds in bounds_in_block(items.value, row):
                for d in np.flatnonzero(bounds >= max(1, floors.value.get(item, 1))):
                    out.append((item, keys[16 * d : 16 * d + 16], ids[d], int(bounds[d])))
            yield _pairs_batch(out)

    found = index.mapInArrow(look, PAIRS_SCHEMA)
    # a limit by rank is applied in each task before the shuffle, so a large group of copies is not gathered
    by_id = Window.partitionBy("item", "key").orderBy(F.asc_nulls_last("doc_id"))
    return found.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= top).drop("r")


def exact_scores(docs: DataFrame, pairs: DataFrame, items) -> DataFrame:
    """(item, key, score) for each distinct (item, key) of ``pairs``; one row of each text is shuffled, texts of no pair are not."""
    asked = pairs.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("one"), F.collect_set("item").alias("items"))
    asked = stored(asked.select("key", F.col("one.doc_id").alias("a_id"), "items"), "asked")
    ident = F.xxhash64("key", F.coalesce("doc_id", F.lit(-1)))
    rows = flag_members(_keyed(docs), ident, asked.select(F.xxhash64("key", F.coalesce("a_id", F.lit(-1))).alias("ident"))).where("_maybe").drop("_maybe")
    rows = rows.join(asked.withColumnRenamed("key", "a_key"), (F.col("key") == F.col("a_key")) & F.col("doc_id").eqNullSafe(F.col("a_id")))
    rows = rows.select("key", "items", "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, asked, text in zip(batch["key"], batch["items"], batch["text"]):
                counts = term_counts(text.as_py())
                length, key = sum(counts.values()), key.as_py()
                out += [(i, key, items.value.score(i, counts, length)) for i in asked.as_py()]
            columns = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.int64()))], names=["item", "key", "score"])

    return rows.mapInArrow(score, "item int, key binary, score long").groupBy("item", "key").agg(F.max("score").alias("score"))


def _passes(benchmark: DataFrame) -> Iterator[tuple[dict[int, object], dict[int, Counter]]]:
    """The items in blocks of bounded size: item number -> id, item number -> terms with repeats."""
    texts = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct().orderBy("item_id", "text")
    ids: dict[int, object] = {}
    terms: dict[int, Counter] = {}
    size, last = 0, object()
    for r in texts.toLocalIterator():
        if last is not None and r["item_id"] == last or (ids and r["item_id"] is None and last is None):
            terms[max(ids)] += term_counts(r["text"].encode())
            continue
        if ids and (len(ids) >= ITEMS_PER_PASS or size >= TERMS_PER_PASS):
            yield ids, terms
            ids, terms, size = {}, {}, 0
        last = r["item_id"]
        number = len(ids)
        ids[number], terms[number] = last, term_counts(r["text"].encode())
        size += len(terms[number])
    if ids:
        yield ids, terms


def ranked(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score, key): the ``top`` best documents with a score above 0 for each item; ``key`` is the text's identity."""
    spark: SparkSession = docs.sparkSession
    sc = spark.sparkContext
    index = signature_index(docs)
    n = index.select(F.sum("docs"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    parts = []
    for ids, terms in _passes(benchmark):
        if not n[0]:
            break
        df = document_frequencies(docs, sorted({t for c in terms.values() for t in c}))
        items = sc.broadcast(Items(terms, df, n[0], n[1]))
        first = stored(most_promising(index, items, 4 * top), "first-look")
        scores = exact_scores(docs, first, items)
        better = Window.partitionBy("item").orderBy(F.desc("score"))
        worst = scores.withColumn("r", F.row_number().over(better)).where(F.col("r") == top)
        floors = sc.broadcast({r["item"]: r["score"] for r in worst.select("item", "score").collect()})  # a row an item
        rows = stored(not_excluded(index, items, floors, top), "not-excluded")
        scored = rows.select("item", "key", "doc_id").join(exact_scores(docs, rows, items), ["item", "key"]).where("score > 0")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(ids.items()), f"item int, item_id {id_type}")
        parts.append(stored(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score", "key"), "ranked"))
    if not parts:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long, key binary")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
