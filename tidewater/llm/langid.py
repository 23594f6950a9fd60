"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a label. A word's own score for each language is a sum
of learned weights of its features: the word itself (lexicon), its prefixes and
suffixes, and its inner character n-grams, hashed into a table of fixed size.
Learned transitions tie neighbouring words together, so a switch of language
inside a text costs as much as switches did in training. Forward-backward gives
each word's probability of each language; a text gets the language with the
largest share of its letters, and that share is the score.

Training reads a bounded sample: the ``PER_LANGUAGE`` labelled documents of every
language whose ids hash lowest. A document is cut into stretches, and stretches of
different documents are chained, so that the transitions see switches.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows
without a language don't train; with no training row every text is ``und``; the
model depends on the set of training rows and not on their order, so ties and
repeated rows do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, release, whole_texts

UNKNOWN = "und"
FOLDS, HELD_OUT = 5, 0
PER_LANGUAGE = 250
BUCKETS = 1 << 17
STRETCH = 40  # words of one document between two others, on average
EPOCHS = 30
LEAST = 0.5  # share of a text's letters that its language needs in a filter
LONG, OVERLAP = 2_000, 50  # words of a stretch, and of its neighbours on either side
WORDS_AT_ONCE = 50_000
_CACHE_WORDS = 100_000
ROWS_AT_ONCE = 1_000  # of an Arrow batch: texts as Python strings, and rows given back

_WORD = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD(text.lower())


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h ^ np.uint64(kind * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(40)) % np.uint64(BUCKETS)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every feature of every word: lexicon, prefixes and suffixes of two to four letters, n-grams of two and three."""
    c = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(c)) - begin[owner]
    to_end = sizes[owner] - place  # characters from here to the end
    step = np.uint64(0x100000001B3)
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), step, np.uint64))
    found, of = [_bucket(np.add.reduceat(c * powers[place], begin), 1)], [np.arange(len(words))]
    h = c.copy()
    for k in (2, 3, 4):
        h = h[:-1] * step + c[k - 1 :]
        whole = np.flatnonzero(to_end[: len(h)] >= k)
        if k < 4:
            found.append(_bucket(h[whole], k))
            of.append(owner[whole])
        for kind, at in ((10 + k, whole[place[whole] == 1]), (20 + k, whole[to_end[whole] == k + 1])):
            found.append(_bucket(h[at], kind))
            of.append(owner[at])
    return np.concatenate(found).astype(np.int64), np.concatenate(of)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # feature bucket x label
    moves: np.ndarray  # log weight of a label after a label
    start: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        bucket, owner = features(words)
        size = np.sqrt(np.bincount(owner, minlength=len(words)))
        return np.stack([np.bincount(owner, self.weights[bucket, c], len(words)) / size for c in range(len(self.labels))], axis=1)


def forward_backward(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Label probabilities of many sequences at once.

    ``scores`` holds the sequences' words one after the other, longest sequence
    first. Step t works on the t-th word of all sequences that have one. Returns
    the probabilities, row for row, and with ``pairs`` the expected count of each
    move and the summed log partition too.
    """
    n = len(sizes)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    longest = int(sizes[0]) if n else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), side="left")  # sequences longer than t
    shift = scores.max(axis=1, keepdims=True)
    e = np.exp(scores - shift)
    move = np.exp(moves)
    alpha, total = np.empty_like(e), np.empty(len(e))
    for t in range(longest):
        at = begin[: alive[t]] + t
        a = (np.exp(start) if t == 0 else alpha[at - 1] @ move) * e[at]
        z = a.sum(axis=1)
        alpha[at], total[at] = a / z[:, None], z
    beta = np.ones_like(e)
    counts = np.zeros_like(move)
    for t in range(longest - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        ahead = beta[at + 1] * e[at + 1] / total[at + 1][:, None]
        if pairs:
            counts += (alpha[at].T @ ahead) * move
        beta[at] = ahead @ move.T
    post = alpha * beta
    post /= post.sum(axis=1, keepdims=True)
    if pairs:
        return post, counts, float(np.log(total).sum() + shift.sum())
    return post


def train(texts: list[tuple[str, str]], epochs: int = EPOCHS) -> Model | None:
    """Fit the field to (text, language) rows by gradient steps scaled per weight."""
    labels = sorted({lang for _, lang in texts})
    if not labels:
        return None
    index = {c: i for i, c in enumerate(labels)}
    rng = np.random.default_rng(7)
    stretches: list[tuple[int, list[str]]] = []
    for text, lang in sorted(texts):
        words, at = words_of(text), 0
        while at < len(words):
            size = int(rng.geometric(1 / STRETCH))
            stretches.append((index[lang], words[at : at + size]))
            at += size
    if not stretches:
        return None
    # chains of neighbouring stretches: mostly of the same document, every few a switch
    order = list(range(len(stretches)))
    for i in rng.choice(len(order), len(order) // 4, replace=False):
        j = int(rng.integers(len(order)))
        order[i], order[j] = order[j], order[i]
    chains = [order[i : i + 8] for i in range(0, len(order), 8)]
    vocabulary: dict[str, int] = {}
    rows, gold, sizes = [], [], []
    for chain in chains:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for s in chain for w in stretches[s][1]]
        rows.append(np.asarray(ids))
        gold.append(np.repeat([stretches[s][0] for s in chain], [len(stretches[s][1]) for s in chain]))
        sizes.append(len(ids))
    by_size = np.argsort(-np.asarray(sizes), kind="stable")
    token = np.concatenate([rows[i] for i in by_size])
    y = np.concatenate([gold[i] for i in by_size])
    sizes = np.asarray(sizes)[by_size]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    inner = np.ones(len(y), bool)
    inner[first] = False

    flat, owner = features(list(vocabulary))
    n_words = len(vocabulary)
    scale = 1 / np.sqrt(np.bincount(owner, minlength=n_words))[owner]

    k = len(labels)
    weights, moves, start = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k)
    seen_moves = np.zeros((k, k))
    np.add.at(seen_moves, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
    seen_start = np.bincount(y[first], minlength=k)
    seen_words = np.zeros((n_words, k))
    np.add.at(seen_words, (token, y), 1)
    squares = [np.full_like(weights, 1e-6), np.full_like(moves, 1e-6), np.full_like(start, 1e-6)]
    for _ in range(epochs):
        per_word = np.stack([np.bincount(owner, weights[flat, c] * scale, n_words) for c in range(k)], axis=1)
        post, moved, _ = forward_backward(per_word[token], sizes, moves, start, pairs=True)
        miss = seen_words - np.stack([np.bincount(token, post[:, c], n_words) for c in range(k)], axis=1)
        grads = [
            np.stack([np.bincount(flat, miss[owner, c] * scale, BUCKETS) for c in range(k)], axis=1) / len(y) - 1e-7 * weights,
            (seen_moves - moved) / len(y) - 1e-4 * moves,
            (seen_start - post[first].sum(axis=0)) / len(first) - 1e-4 * start,
        ]
        for w, g, q in zip((weights, moves, start), grads, squares):
            q += g * g
            w += 0.5 * g / np.sqrt(q)
    return Model(labels, weights.astype(np.float32), moves, start)


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(text, lang): the labelled rows to train on, ``per_language`` of each language at most, lowest hash of id and text first."""
    rows = docs.where((crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("text", "lang", F.xxhash64("doc_id", "text").alias("h"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    # hashes alone are ranked; a row for each language then picks the texts
    lowest = rows.groupBy("lang", "h").agg(F.lit(1).alias("one")).withColumn("r", rank).where(F.col("r") <= per_language)
    limits = lowest.groupBy("lang").agg(F.max("h").alias("limit"))
    # a row for each language, as the model has a column for each
    return rows.join(F.broadcast(limits), "lang").where("h <= limit").dropDuplicates(["lang", "h"]).select("text", "lang")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """The field learned from the bounded sample; the only rows that reach the driver."""
    return train([(r["text"], r["lang"]) for r in sample(docs, per_language).collect()])


def _stretches(texts: list[str | None]) -> Iterator[list[tuple[int, list[str], int, int]]]:
    """Groups of (text's place, words, first and end of those to count): long texts in overlapping stretches, so that no group is large."""
    group, held = [], 0
    for i, text in enumerate(texts):
        words = words_of(text) if text else []
        for at in range(0, len(words), LONG):
            low, end = max(0, at - OVERLAP), min(len(words), at + LONG)
            part = words[low : end + OVERLAP]
            group.append((i, part, at - low, end - low))
            held += len(part)
            if held >= WORDS_AT_ONCE:
                yield group
                group, held = [], 0
    if group:
        yield group


class WordScores:
    """A model's word scores kept by word, as rows of one table of bounded size."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.table = np.empty((0, len(model.labels)))

    def of(self, words: list[str]) -> np.ndarray:
        """The scores of different words, row for row."""
        if len(self.place) > _CACHE_WORDS:
            self.place.clear()
        new = [w for w in words if w not in self.place]
        if new:
            first = len(self.place)
            if first + len(new) > len(self.table):
                more = np.empty((max(first + len(new), min(2 * len(self.table), _CACHE_WORDS)), self.table.shape[1]))
                more[:first] = self.table[:first]
                self.table = more
            self.table[first : first + len(new)] = self.model.word_scores(new)
            self.place.update(zip(new, range(first, first + len(new))))
        return self.table[np.fromiter((self.place[w] for w in words), np.int64, len(words))]


def predict(model: Model, texts: list[str | None], cache: dict[str, WordScores]) -> tuple[list[str], list[float]]:
    """Language and score of each text.

    Long texts are walked in stretches with ``OVERLAP`` words of their neighbours on
    either side, beyond which a label hardly depends on the words: memory and steps
    have a bound whatever the text's length. ``cache`` keeps the words' scores from
    call to call.
    """
    known = cache.setdefault("words", WordScores(model))
    share = np.zeros((len(texts), len(model.labels)))
    for group in _stretches(texts):
        group.sort(key=lambda g: -len(g[1]))
        ids: dict[str, int] = {}
        token = np.fromiter((ids.setdefault(w, len(ids)) for _, words, _, _ in group for w in words), np.int64)
        table = known.of(list(ids))
        length = np.fromiter((sum(map(str.isalpha, w)) for w in ids), np.float64, len(ids))[token]
        sizes = np.asarray([len(words) for _, words, _, _ in group])
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        place = np.arange(len(token)) - np.repeat(begin, sizes)
        first, end = (np.repeat([g[k] for g in group], sizes) for k in (2, 3))
        length[(place < first) | (place >= end)] = 0
        post = forward_backward(table[token], sizes, model.moves, model.start)
        np.add.at(share, [g[0] for g in group], np.add.reduceat(post * length[:, None], begin, axis=0))
    out, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    for i in np.flatnonzero(share.sum(axis=1)):  # signs that count as letters in words but are none give nothing
        s = share[i] / share[i].sum()
        best = int(np.argmax(s))
        out[i], score[i] = model.labels[best], float(min(1.0, s[best]))
    return out, score


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``ROWS_AT_ONCE`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with held_out, lang_pred and score, which it must not have before. Only the text decides."""
    whole_texts(docs.sparkSession)
    base = docs.withColumn("held_out", crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT)
    if model is None:
        return base.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers, whatever the corpus

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, WordScores] = {}
        for batch in _parts(batches):
            langs, scores = predict(shared.value, batch.column("text").to_pylist(), cache)
            made = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "lang_pred", "score"])
        cache.clear()
        release()

    return base.mapInArrow(label, _schema(base) + ", lang_pred string, score double")


def accepted(docs: DataFrame, model: Model | None, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of at least ``least``; none without a model."""
    whole_texts(docs.sparkSession)
    if model is None:
        return docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, WordScores] = {}
        for batch in _parts(batches):
            langs, scores = predict(shared.value, batch.column("text").to_pylist(), cache)
            yield batch.filter(pa.array([c != UNKNOWN and s >= least for c, s in zip(langs, scores)], pa.bool_()))
        cache.clear()
        release()

    return docs.mapInArrow(keep, _schema(docs))
