"""Packing of tokenised documents into sequences by length patterns.

A pattern is the lengths of a few documents that fill a sequence. The lengths
are put in bins, all patterns of up to ``MOST`` bins that fill a sequence are
enumerated, and non-negative least squares says how often to use each so that
the bins' counts are met. The repeat counts are rounded down; what is left, and
the room left in patterns whose documents are shorter than their bins, goes to
best fit by exact length. All of that works on the histogram of lengths, which
has at most one entry per possible length, so it doesn't grow with the corpus.

The plan says for each length which ranks go to which sequences at which offset;
each piece looks its place up by its length and its rank among the pieces of
that length. Ranks come from counts per stored part and length, so that a length
that very many pieces share is numbered in parallel.

Defined cases: a null text is empty; an empty text still has its end token; a
text longer than a sequence is cut so that its first piece takes the odd rest
and all others are full; rows with the same doc_id are packed on their own.
"""

from __future__ import annotations

import gc
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, stored, whole_texts

CAPACITY = 2048
END = 0
BINS = 256
MOST = 3  # documents in a pattern
_CACHE_WORDS = 100_000  # of each of two generations
_ROWS_AT_ONCE = 1_000  # of an Arrow batch: texts as Python strings, and pieces given back
_ODD_BLANK = re.compile(r" (?:\s|\Z)").search
# where a line end isn't between two characters that are no white space, and a full stop or comma before a blank or line end not after a letter or digit
_ODD_LINE = re.compile(r"\n(?:\s|\Z|(?<!\S\n))").search
_ODD_STOP = re.compile(r"[.,](?<![^\W_].)[ \n]").search
_BARE = "\0"  # before a part that follows no blank

# ---------------------------------------------------------------------------
# tokens
# ---------------------------------------------------------------------------


class Encoder(dict):
    """Token ids of texts, word by word, remembering those of words seen lately.

    A blank before a character that is no white space always starts a new
    pre-token, so a text may be cut at such blanks and its parts encoded on their
    own. Words that follow a blank are kept without it. When the dictionary is full it
    becomes the older generation, from which words come back as they are met again.
    Line ends between lines, and full stops and commas at the end of a word or line, are
    pre-tokens of their own: they are parted from the words, and marked like all else that
    follows no blank.
    """

    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenize = Tokenizer.from_file(path).model.tokenize  # without special tokens: their strings are ordinary text
        self.pre_tokens = regex.compile(public_tokenizers.PATTERN).findall
        self.older: dict[str, bytes] = {}  # words
        self.ids: dict[str, bytes] = {}  # of pre-tokens of other words

    def _ids(self, part: str) -> bytes:
        signs = part if part.isascii() and part.isalpha() else part.encode().decode("latin-1").translate(_BYTE_SIGNS)
        return array("I", [t.id for t in self.tokenize(signs)]).tobytes()

    def _pre_token(self, part: str) -> bytes:
        got = self.ids.get(part)
        if got is None:
            if len(self.ids) >= _CACHE_WORDS:
                self.ids.clear()
            got = self.ids[part] = self._ids(part)
        return got

    def _part(self, part: str) -> bytes:
        return b"".join(map(self._pre_token, self.pre_tokens(part)))

    def __missing__(self, word: str) -> bytes:
        got = self.older.get(word)
        if got is None:
            if word.isalpha():  # letters are one pre-token
                got = array("I", [t.id for t in self.tokenize(_BLANK_SIGN + word)]).tobytes() if word.isascii() else self._ids(" " + word)
            elif word[:1] == _BARE:
                got = self._part(word[1:])
            elif word[-1:] in ".," and word[:-1].isalpha():  # not remembered beside the word without it
                return self[word[:-1]] + self._pre_token(word[-1])
            else:
                got = self._part(" " + word)
        if len(self) >= _CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """The ids as unsigned little-endian 32-bit numbers."""
        odd = _ODD_BLANK(text)
        if not (odd or _BARE in text or _ODD_LINE(text) or _ODD_STOP(text)):
            parted = text.replace("\n", " \0\n \0").replace(", ", " \0, ").replace(". ", " \0. ")
            return b"".join(map(self.__getitem__, (_BARE + parted).split(" ")))
        first, *words = text.split(" ")
        if odd:  # a blank that doesn't lead a word belongs with what is before it
            parts = [first]
            for w in words:
                if w and not w[0].isspace():
                    parts.append(" " + w)
                else:
                    parts[-1] += " " + w
            return b"".join(map(self._part, parts))
        if _BARE in text:  # here it is a character of the text
            return self._part(first) + b"".join([self._part(" " + w) for w in words])
        return self._part(first) + b"".join(map(self.__getitem__, words))


def _byte_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies write for each byte: itself, or the next free one from 256 on."""
    own = {b for r in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(r[0], r[1] + 1)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_SIGNS = _byte_signs()
_BLANK_SIGN = _BYTE_SIGNS[ord(" ")]
_ENCODERS: dict[str, Encoder] = {}


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and its end token, cut to ``capacity``."""
    whole_texts(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer_path)
        if encoder is None:
            encoder = _ENCODERS[tokenizer_path] = Encoder(tokenizer_path)
        end = np.asarray([END], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                some = batch.slice(at, _ROWS_AT_ONCE)
                rows: list[list] = [[] for _ in fields]
                # a token is an object, none of them in a cycle: looking for cycles among them takes a seventh of the time
                collecting = gc.isenabled()
                gc.disable()
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    start, piece = 0, 0
                    while start < n:
                        size = (n - start - 1) % capacity + 1
                        own = ids[4 * start : 4 * (start + size)]
                        for column, value in zip(rows, (doc_id, piece, start, size, zlib.crc32(own), own)):
                            column.append(value)
                        start, piece = start + size, piece + 1
                if collecting:
                    gc.enable()
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, fields)], schema=fields)
        release()

    fields = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    if with_ids:
        fields = fields.append(pa.field("ids", pa.binary()))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


# ---------------------------------------------------------------------------
# the plan, from the histogram alone
# ---------------------------------------------------------------------------


def patterns(bins: int = BINS, most: int = MOST) -> np.ndarray:
    """All descending tuples of up to ``most`` bins (0: none) whose sizes add up to ``bins``."""
    found: list[tuple[int, ...]] = []

    def extend(rest: int, largest: int, taken: tuple[int, ...]) -> None:
        if rest == 0:
            found.append(taken + (0,) * (most - len(taken)))
        elif len(taken) < most:
            left = most - len(taken)
            for b in range(min(rest, largest), (rest - 1) // left, -1):
                extend(rest - b, b, taken + (b,))

    extend(bins, bins, ())
    return np.asarray(found)


def nonnegative_least_squares(a: np.ndarray, y: np.ndarray, rounds: int) -> np.ndarray:
    """x >= 0 that makes a @ x closest to y, by the active-set method: a column enters while it still helps."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    tiny = 1e-9 * max(1.0, float(np.abs(y).max(initial=0)))
    for _ in range(rounds):
        gain = a.T @ (y - a @ x)
        gain[active] = -np.inf
        j = int(np.argmax(gain))
        if gain[j] <= tiny:
            break
        active[j] = True
        while True:
            at = np.flatnonzero(active)
            own = a[:, at]
            # normal equations, with a trace of ridge for columns that depend on each other
            z = np.linalg.solve(own.T @ own + 1e-10 * np.eye(len(at)), own.T @ y)
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            old = x[at]
            step = np.min(old[low] / np.maximum(old[low] - z[low], 1e-300))
            x[at] = old + step * (z - old)
            active[at[low & (x[at] <= tiny)]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY, bins: int = BINS, most: int = MOST) -> list[tuple[int, tuple[int, ...]]]:
    """(repeats, lengths): how many sequences get documents of exactly these lengths, in this order.

    Every length of the histogram is used up.
    """
    left = {k: v for k, v in histogram.items() if v}
    out: list[tuple[int, tuple[int, ...]]] = []
    if left.pop(capacity, 0):
        out.append((histogram[capacity], (capacity,)))
    if not left:
        return out
    wide = -(-capacity // bins)
    counts = np.zeros(bins + 1)
    for length, n in left.items():
        counts[-(-length // wide)] += n
    forms = patterns(bins, most)
    forms = forms[np.all((forms == 0) | (counts[forms] > 0), axis=1)]
    use = np.zeros(len(forms), int)
    if len(forms):
        a = np.zeros((bins + 1, len(forms)))
        for slot in range(most):
            np.add.at(a, (forms[:, slot], np.arange(len(forms))), 1)
        a[0] = 0
        use = np.floor(nonnegative_least_squares(a, counts, 3 * bins) + 1e-6).astype(int)

    # repeat counts into exact lengths: each bin hands out its longest lengths first
    stock: dict[int, list[int]] = {}
    for length in sorted(left):
        stock.setdefault(-(-length // wide), []).append(length)

    def draw(want: list[int]) -> list[int] | None:
        lengths: list[int] = []
        for b in want:
            while stock[b] and not left[stock[b][-1]]:
                stock[b].pop()
            if not stock[b]:
                for x in lengths:
                    left[x] += 1
                    if x not in stock[-(-x // wide)]:
                        stock[-(-x // wide)].append(x)
                return None
            left[stock[b][-1]] -= 1
            lengths.append(stock[b][-1])
        return lengths

    room: list[tuple[int, int, int, tuple[int, ...]]] = []  # (free, order, repeats, lengths), sorted
    order = 0
    for j in np.argsort(-use, kind="stable"):
        times, want = int(use[j]), [int(b) for b in forms[j] if b]
        while times > 0 and (lengths := draw(want)):
            more = min([times - 1, *(left[x] // lengths.count(x) for x in lengths)])
            for x in lengths:
                left[x] -= more
            insort(room, (capacity - sum(lengths), order, 1 + more, tuple(lengths)))
            order, times = order + 1, times - 1 - more

    # the residual, longest first, each into the sequences with the least room that holds it
    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            i = bisect_left(room, (length,))
            if i == len(room):
                each = capacity // length
                if n >= each:
                    insort(room, (capacity - each * length, order, n // each, (length,) * each))
                    n -= n // each * each
                else:
                    insort(room, (capacity - n * length, order, 1, (length,) * n))
                    n = 0
                order += 1
                continue
            free, _, times, lengths = room.pop(i)
            each = min(free // length, max(1, n // times))
            now = min(times, n // each)
            if now < times:
                insort(room, (free, order, times - now, lengths))
                order += 1
            insort(room, (free - each * length, order, now, lengths + (length,) * each))
            n, order = n - now * each, order + 1
    return out + [(times, lengths) for _, _, times, lengths in room]


def slots(made: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, offset) of every place in the plan."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for times, lengths in made:
        offset = 0
        for x in lengths:
            out.append((x, rank.get(x, 0), times, sequence, offset))
            rank[x] = rank.get(x, 0) + times
            offset += x
        sequence += times
    return out


# ---------------------------------------------------------------------------
# places of all pieces
# ---------------------------------------------------------------------------


def _ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``rank``, from 0 among those of the same length; any order, but the same whenever it is read."""
    parted = stored(pieces.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()), "pieces")
    counts = parted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("nth")) - 1
    return parted.withColumn("within", within).join(counts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("within")).drop(
        "part", "nth", "before", "within"
    )


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a column ``length`` from 1 to ``capacity``) with sequence_id and offset.

    The histogram and the plan are the only things that pass the driver; they are
    bounded by ``capacity``, not by the corpus.
    """
    ranked = stored(_ranked(pieces), "ranked")
    histogram = {int(r["length"]): int(r["n"]) for r in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = slots(plan(histogram, capacity))
    schema = "length long, first_rank long, ranks long, first_sequence long, offset long"
    table = ranked.sparkSession.createDataFrame(places, schema)
    # places with the same length and first rank differ in sequence; at most a few per length and pattern
    inside = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("ranks"))
    joined = ranked.alias("p").join(F.broadcast(table).alias("s"), (F.col("p.length") == F.col("s.length")) & inside)
    return joined.select(
        *[F.col(f"p.{c}").alias(c) for c in pieces.columns],
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
        "offset",
    )
