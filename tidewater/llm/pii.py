"""Personal data by candidates and gradient-boosted trees.

Four base patterns (mail, IP address, card, phone) always count. Beside them,
generators of high recall propose further spans of the same kinds: addresses with
spelled-out signs, numbers with other separators or without a plus. Boosted trees
score a candidate by its format and its context; they learn from a bounded sample
in which candidates that a base pattern confirms are positive and all others are
negative, without the very sign that the base pattern asks for. Isotonic
calibration on rows kept apart turns scores into precision, and each kind gets the
lowest threshold that reaches ``PRECISION`` there (none, if none does). Candidates
above it are added where they don't overlap a span already chosen.

Defined cases: a null text is empty; offsets are code points, ends exclusive; with
no row to learn from, only base spans count.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 40_000
PRECISION = 0.98
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 32

# ---------------------------------------------------------------------------
# base patterns, fixed by the contract; written so that no text takes quadratic time
# ---------------------------------------------------------------------------
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]").findall
_HAS_DIGIT = re.compile(r"[0-9]").search
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every base match."""
    found = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            found.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _HAS_DIGIT(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                found.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = "".join(_DIGITS(m[0])) if m.end() - m.start() <= 64 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGITS(m[0])) <= 15:
                    found.append(("phone", m.start(), m.end()))
    return found


# ---------------------------------------------------------------------------
# candidates and their features
# ---------------------------------------------------------------------------
_SPELLED = re.compile(
    r"(?<![\w.])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?: ?[\[({<] ?at ?[\])}>] ?| at |@)[A-Za-z0-9-]{1,63}"
    r"(?:(?: ?[\[({<] ?dot ?[\])}>] ?| dot |\.)[A-Za-z0-9-]{2,24}){1,4}",
    re.I,
)
_QUAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?[.,:] ?[0-9]{1,3}){3}(?![0-9])")
_LONG = re.compile(r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){11,18}(?![0-9])")
_CALL = re.compile(r"(?<![0-9+])\+?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9])")
_WORD_BEFORE = re.compile(r"(\w+)\W{0,3}\Z")
TRIGGERS = {
    "email": set("mail email contact write address reply".split()),
    "ip": set("ip host server address node from".split()),
    "card": set("card visa mastercard account credit payment no number".split()),
    "phone": set("phone tel call mobile fax cell telephone number contact".split()),
}
FEATURES = (
    "length digits letters separators kinds_of_separators groups longest_group shortest_group first_group last_group distinct_digits "
    "luhn octets leading_zero upper trigger word_before word_after joined_before joined_after digits_near line_start ends_sentence"
).split()


def candidates(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all proposals; they may overlap."""
    out = []
    low = "@" in text or " at " in text or "at]" in text or "at)" in text
    if low and ("@" in text or "dot" in text.lower()):
        out += [("email", m.start(), m.end()) for m in _SPELLED.finditer(text)]
    if _HAS_DIGIT(text):
        for kind, pattern in (("ip", _QUAD), ("card", _LONG), ("phone", _CALL)):
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return out


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span; not the signs that its base pattern is defined by."""
    span = text[start:end].lstrip("+")
    digits = "".join(_DIGITS(span))
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    others = [c for c in span if not c.isalnum()]
    before, after = text[max(0, start - 24) : start].rstrip("+"), text[end : end + 24]
    word = _WORD_BEFORE.search(before)
    # the card check decides cards, so cards are described without it, and addresses without their octets
    return [
        len(span), len(digits), sum(map(str.isalpha, span)), len(others), len(set(others)), len(groups), max(groups), min(groups),
        groups[0], groups[-1], len(set(digits)), float(kind != "card" and bool(digits) and luhn(digits)),
        float(kind != "ip" and all(int(g) <= 255 for g in re.findall(r"[0-9]{1,9}", span))), float(digits.startswith("0")),
        float(any(map(str.isupper, span))), float(bool(word) and word[1].lower() in TRIGGERS[kind]), float(bool(word)),
        float(bool(re.match(r"\W{0,2}\w", after))), float(before[-1:].isalnum() or before[-1:] in tuple("-_/#=\"'")),
        float(after[:1].isalnum() or after[:1] in tuple("-_/#=\"'")), len(_DIGITS(before + after)), float(start == 0 or text[start - 1] == "\n"),
        float(after[:1] in tuple(".!?\n") or not after),
    ]


# ---------------------------------------------------------------------------
# boosted trees
# ---------------------------------------------------------------------------
@dataclass
class Boosted:
    """Trees of depth ``DEPTH`` as (feature, cut) per inner node and a value per leaf, and calibrated thresholds."""

    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for feature, cut, leaf in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > cut[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Logistic gradient boosting with histogram splits."""
    model = Boosted()
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.start = float(np.log(rate / (1 - rate)))
    score = np.full(len(y), model.start)
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, cut, at = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(len(y), int)
        for node in range(inner):
            own = at == node
            best = (1e-6, 0, np.inf, 0)
            gs, hs = g[own].sum(), h[own].sum()
            for j in range(x.shape[1]):
                gb = np.cumsum(np.bincount(binned[own, j], g[own], len(edges[j]) + 1))[:-1]
                hb = np.cumsum(np.bincount(binned[own, j], h[own], len(edges[j]) + 1))[:-1]
                if not len(gb):
                    continue
                gain = gb**2 / (hb + 1) + (gs - gb) ** 2 / (hs - hb + 1) - gs**2 / (hs + 1)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, float(edges[j][k]), k)
            feature[node], cut[node] = best[1], best[2]
            at[own] = 2 * node + 1 + (x[own, best[1]] > best[2])
        leaf_of = at - inner
        leaf = RATE * np.bincount(leaf_of, g, inner + 1) / (np.bincount(leaf_of, h, inner + 1) + 1)
        score += leaf[leaf_of]
        model.trees.append((feature, cut, leaf))
    return model


def calibrated(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: ascending scores and the precision from each of them on up to the next."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # [score from, positives, rows]
    for s, v in zip(score[order], y[order]):
        blocks.append([s, v, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, v1, n1 = blocks.pop()
            blocks[-1][1] += v1
            blocks[-1][2] += n1
    # one more negative than seen, so that a few rows alone don't promise certainty
    return np.asarray([b[0] for b in blocks]), np.asarray([b[1] / (b[2] + 1) for b in blocks])


@dataclass
class Detector:
    models: dict[str, Boosted]
    thresholds: dict[str, float]

    def more(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Candidates above their kind's threshold that overlap no base span nor a better candidate."""
        taken = [(s, e) for _, s, e in base]
        scored = []
        for kind, start, end in candidates(text):
            limit = self.thresholds.get(kind, np.inf)
            if limit < np.inf and not any(s < end and start < e for s, e in taken):
                score = float(self.models[kind].raw(np.asarray([describe(text, kind, start, end)]))[0])
                if score >= limit:
                    scored.append((-score, start, end, kind))
        out = []
        for _, start, end, kind in sorted(scored):
            if not any(s < end and start < e for s, e in taken):
                taken.append((start, end))
                out.append((kind, start, end))
        return out


def fit(kinds: list[str], x: np.ndarray, y: np.ndarray) -> Detector:
    """A model and a threshold for each kind; every third row is kept for calibration."""
    models, thresholds = {}, {}
    for kind in KINDS:
        own = np.flatnonzero(np.asarray(kinds) == kind)
        aside = np.arange(len(own)) % 3 == 0
        learn, test = own[~aside], own[aside]
        if len(test) < 20 or not 0 < y[learn].sum() < len(learn):
            continue  # nothing to tell apart
        models[kind] = boost(x[learn], y[learn])
        score, precision = calibrated(models[kind].raw(x[test]), y[test])
        good = np.flatnonzero(precision >= PRECISION)
        if len(good):
            thresholds[kind] = float(score[good[0]])
    return Detector(models, thresholds)


# ---------------------------------------------------------------------------
# on Spark
# ---------------------------------------------------------------------------
def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds, rows, labels = [], [], []
        for text in batch.column("text").to_pylist():
            base = {(k, s, e) for k, s, e in base_spans(text)}
            for kind, start, end in candidates(text):
                # a base match within the candidate, but for a sign before it, confirms it
                hit = any(k == kind and start <= s + 1 and s <= start + 1 and e == end for k, s, e in base)
                kinds.append(kind)
                rows.append(describe(text, kind, start, end))
                labels.append(float(hit))
        made = [pa.array(kinds, pa.string()), pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.float64())]
        yield pa.RecordBatch.from_arrays(made, ["kind", "x", "y"])


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Detector:
    """A detector from the candidates of about ``sample_docs`` documents, chosen by hash."""
    ship(docs.sparkSession)
    n = max(1, docs.count())
    share = min(1.0, sample_docs / n)
    rows = docs.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20))))
    got = rows.where("text RLIKE '[0-9@]'").select("text").mapInArrow(_examples, "kind string, x array<double>, y double")
    got = sorted((r["kind"], tuple(r["x"]), r["y"]) for r in got.collect())
    # rows in a fixed order that has nothing to do with what they hold
    got.sort(key=lambda r: hashlib.md5(repr(r).encode()).digest())
    return fit([r[0] for r in got], np.asarray([r[1] for r in got]).reshape(-1, len(FEATURES)), np.asarray([r[2] for r in got]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def found(docs: DataFrame, detector: Detector, with_text: bool = False) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans[, redacted]) of every document; counts are of base spans.

    ``redacted`` is the text with every span replaced by its kind in brackets.
    """
    ship(docs.sparkSession)
    last = ["redacted"] if with_text else []
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            base_out, all_out, clean = [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                base = base_spans(text)
                spans = base + shared.value.more(text, base)
                for c, kind in zip(counts, KINDS):
                    c.append(sum(k == kind for k, _, _ in base))
                base_out.append(_joined(base))
                all_out.append(_joined(spans))
                if with_text:
                    clean.append(redacted(text, spans))
            texts = (base_out, all_out, clean) if with_text else (base_out, all_out)
            made = [pa.array(c, pa.int64()) for c in counts] + [pa.array(c, pa.string()) for c in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", *[f"n_{k}" for k in KINDS], "base_spans", "spans", *last])

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + "".join(f", {c} string" for c in ("base_spans", "spans", *last))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with the union of the spans replaced; overlapping ones take the name of the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]
