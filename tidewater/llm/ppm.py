"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes long with the counts of
the byte that followed. A byte is predicted by the longest context seen in
training; one not seen there escapes to the next shorter context, with the
probability (kinds seen) / (times + kinds), and from there on the symbols of the
longer context are excluded. What is left at the end is uniform. The score of a
text is the log10 probability of its bytes (A-Z in lower case) and its end.

Both the trie and the word counts of the base score are tables that Spark counts
over all training documents. Documents are dealt into chunks of bounded size;
a chunk asks for each different five-byte string and word it holds once, those
requests meet the counts in joins, and the answers return to the chunk. So no
task holds the whole model, and the traffic is that of distinct strings and not
of all tokens. Only the counts of pairs of bytes (65,536 at most) and a few totals
pass the driver.

Words are asked for by a 63-bit hash. Defined cases: a null text is empty and is
its end alone; a null id falls in the fold of the empty string; repeated rows
train and are scored as often as they stand; without training rows all
probabilities are uniform.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, ship, stored

ORDER = 4  # bytes of context; a string and its next byte fit into 40 bits
FOLDS, HELD_OUT = 7, 2
CHUNK_BYTES = 12 << 20
_PIECE = 4 << 20
_START, _END = 0xFE, 0xFF  # bytes that UTF-8 never has
_SYMBOLS = 255  # all bytes but the start mark
_LOWER = bytes(range(256)).lower()


def _lowered(text: str | None) -> bytes:
    return (text or "").encode().translate(_LOWER)


def _strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte (and end) with the bytes before it as one number, and how many each text has."""
    a = np.frombuffer(b"".join(bytes([_START] * ORDER) + t + bytes([_END]) for t in texts), np.uint8)
    wide = a.astype(np.int64)
    g = wide[: len(a) - ORDER].copy()
    for i in range(1, ORDER + 1):
        g <<= 8
        g |= wide[i : len(a) - ORDER + i]
    return g[a[ORDER:] != _START], np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))


def _word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) % (1 << 63) - (1 << 63)  # below zero, where no byte string is


_END_KEY = _word_key(b" end of text")


def _pieces(texts: list[bytes]) -> Iterator[list[bytes]]:
    piece, size = [], 0
    for t in texts:
        piece.append(t)
        size += len(t)
        if size >= _PIECE:
            yield piece
            piece, size = [], 0
    if piece:
        yield piece


def _counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for piece in _pieces(texts):
        k, c = np.unique(_strings(piece)[0], return_counts=True)
        keys.append(k)
        counts.append(c)
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


_REQUEST = pa.schema([("chunk", pa.int64()), ("key", pa.int64()), ("n", pa.int64())])


def _requests(table: pa.Table) -> pa.Table:
    """The different strings and words of a chunk, with their counts in its training documents."""
    train = table.column("train").to_pylist()
    texts = [_lowered(t) for t in table.column("text").to_pylist()]
    learned = [t for t, x in zip(texts, train) if x]
    other = [t for t, x in zip(texts, train) if not x]
    keys, counts = _counted(learned)
    more, _ = _counted(other)
    words: Counter = Counter()
    for t in learned:
        words.update(t.split())
    for t in other:
        words.update(dict.fromkeys(t.split(), 0))
    own = [keys, more, np.fromiter(map(_word_key, words), np.int64, len(words)), np.asarray([_END_KEY])]
    n = [counts, np.zeros(len(more), np.int64), np.fromiter(words.values(), np.int64, len(words)), np.asarray([len(learned)])]
    keys, counts = _summed(np.concatenate(own), np.concatenate(n))
    chunk = np.full(len(keys), table.column("chunk")[0].as_py(), np.int64)
    return pa.Table.from_arrays([pa.array(chunk), pa.array(keys), pa.array(counts)], schema=_REQUEST)


def _predictions(pair_counts: np.ndarray):
    """Log10 probabilities of byte strings that share their last two context bytes, given the counts of byte pairs."""
    single = pair_counts.sum(axis=0)
    n1, d1 = pair_counts.sum(axis=1), (pair_counts > 0).sum(axis=1)
    n0, d0 = int(single.sum()), int((single > 0).sum())
    over1 = ((pair_counts > 0) * single).sum(axis=1)  # order-0 counts of the symbols a byte was followed by

    def run(table: pa.Table) -> pa.Table:
        g, c = table.column("key").to_numpy(), table.column("n").to_numpy()
        s, last = g & 0xFF, (g >> 8) & 0xFF
        times: list[np.ndarray] = [single[s], pair_counts[last, s]]
        n: list[np.ndarray] = [np.full(len(g), n0), n1[last]]
        d: list[np.ndarray] = [np.full(len(g), d0), d1[last]]
        over: list[np.ndarray] = [np.zeros(len(g), np.int64), over1[last]]  # over[j]: order j-1 counts of order j's symbols
        for j in range(2, ORDER + 1):
            _, first, entry = np.unique(g & ((1 << (8 * j + 8)) - 1), return_index=True, return_inverse=True)
            count = np.bincount(entry, c, len(first)).astype(np.int64)  # of each (context, symbol)
            _, context = np.unique((g[first] >> 8) & ((1 << (8 * j)) - 1), return_inverse=True)
            size = int(context.max()) + 1
            of = context[entry]
            n.append(np.bincount(context, count, size).astype(np.int64)[of])
            d.append(np.bincount(context, count > 0, size).astype(np.int64)[of])
            over.append(np.bincount(context, np.where(count > 0, times[j - 1][first], 0), size).astype(np.int64)[of])
            times.append(count[entry])
        logp, open_ = np.zeros(len(g)), np.ones(len(g), bool)
        for j in range(ORDER, -1, -1):
            longer = n[j + 1] > 0 if j < ORDER else np.zeros(len(g), bool)
            mass = n[j] - np.where(longer, over[j + 1], 0) if j < ORDER else n[j]
            kinds = d[j] - np.where(longer, d[j + 1], 0) if j < ORDER else d[j]
            here = open_ & (n[j] > 0) & (kinds > 0)
            total = np.maximum(mass + kinds, 1)
            hit = here & (times[j] > 0)
            logp[hit] += np.log10(times[j][hit] / total[hit])
            escape = here & ~hit
            logp[escape] += np.log10(kinds[escape] / total[escape])
            open_ &= ~hit
        logp[open_] -= np.log10(max(1, _SYMBOLS - d0))
        return pa.Table.from_arrays([table.column("key"), pa.array(logp)], names=["key", "value"])

    return run


def _scored(train_tokens: int, distinct: int):
    """Scores of a chunk's documents from the answers to its requests."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys, values = answers.column("key").to_numpy(), answers.column("value").to_numpy()
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        split = int(np.searchsorted(keys, 0))
        strings, logp = keys[split:], values[split:]
        counts = dict(zip(keys[:split].tolist(), values[:split].tolist()))
        texts = [_lowered(t) for t in docs.column("text").to_pylist()]
        score = []
        for piece in _pieces(texts):
            g, sizes = _strings(piece)
            score.append(np.add.reduceat(logp[np.searchsorted(strings, g)], np.cumsum(sizes) - sizes))
        known: dict[bytes, float] = _Counts(counts)
        n_tokens, n_known, base = [], [], []
        floor = np.log10(train_tokens + distinct + 1)
        for t in texts:
            words = t.split()
            c = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
            c = np.append(c, counts[_END_KEY])
            n_tokens.append(len(c))
            n_known.append(int((c > 0).sum()))
            base.append(float(np.log10(c + 1).sum() - len(c) * floor))
        made = [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(np.concatenate(score))]
        return pa.Table.from_arrays([docs.column("own"), *made], names=["own", "n_tokens", "n_known", "base_score", "score"])

    return run


class _Counts(dict):
    """Counts of words, looked up by their key once."""

    def __init__(self, by_key: dict[int, float]):
        self.by_key = by_key

    def __missing__(self, word: bytes) -> float:
        got = self[word] = self.by_key[_word_key(word)]
        return got


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) with held_out, n_tokens, n_known, train_tokens, base_score and score.

    Trains on the documents outside the held-out fold.
    """
    ship(docs.sparkSession)
    held_out = crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT
    total = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    chunks = int(total) // chunk_bytes + 1
    rows = docs.select(
        F.struct("doc_id", held_out.alias("held_out")).alias("own"), "text", (~held_out).alias("train"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk")
    )
    requests = stored(rows.select("chunk", "text", "train").groupBy("chunk").applyInArrow(_requests, "chunk long, key long, n long"), "requests")
    counts = stored(requests.groupBy("key").agg(F.sum("n").alias("n")), "counts")
    words, strings = counts.where("key < 0"), counts.where("key >= 0")
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    pairs = np.zeros((256, 256), np.int64)
    both = strings.groupBy(F.pmod("key", F.lit(1 << 16)).cast("int").alias("pair")).agg(F.sum("n").alias("n"))
    for r in both.collect():
        pairs[r["pair"] >> 8, r["pair"] & 0xFF] = r["n"]
    context = F.pmod(F.shiftright("key", 8), F.lit(1 << 16)).alias("context")
    predicted = strings.groupBy(context).applyInArrow(_predictions(pairs), "key long, value double")
    values = stored(predicted.unionByName(words.select("key", F.col("n").cast("double").alias("value"))), "values")
    answers = requests.select("chunk", "key").join(values, "key").select("chunk", "key", "value")

    fields = "own struct<doc_id:long,held_out:boolean>, n_tokens long, n_known long, base_score double, score double"
    out = rows.select("chunk", "own", "text").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scored(int(tokens), int(distinct)), fields)
    return out.select("own.doc_id", "own.held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score", "score")
