import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tidewater.llm import ranked as R

from .helpers import odd_documents, same_as_oracle


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, top=20):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    texts = {}
    for i, t in {(i, t or "") for i, t in items}:
        texts.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, wanted in texts.items():
        scored = []
        for doc_id, c, length in held:
            m = 75 + (25 * length * n) // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in wanted.items() if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:top])]
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def found(docs, items):
    return [(r.item_id, r.rank, r.doc_id, r.score) for r in R.ranked(docs, items).collect()]


def made(spark, n=600, seed=1):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Été", "naïve", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(r.choices(vocabulary, weights, k=r.choice([3, 20, 200, 900])))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(200)]  # a hot group of copies
    items = [(i, " ".join(r.choices(vocabulary, weights, k=r.choice([1, 8, 40])))) for i in range(15)]
    items += [(100, docs[5][1]), (101, "w399, W399 w399!"), (102, "nothing of this"), (103, "?!"), (104, None), (None, "w3 w4"), (0, "w7 w8"), (0, "w7 w8")]
    return docs, items


def test_oracle(spark, sf):
    same_as_oracle(spark, sf, "op13_ranked_search")


def test_equals_brute_force(spark):
    docs, items = made(spark)
    got = found(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    assert in_order(got) == in_order(brute(docs, items)) and len(got) > 200


def test_passes_give_the_same_results(spark, monkeypatch):
    docs, items = made(spark, 150, 2)
    monkeypatch.setattr(R, "ITEMS_PER_PASS", 4)
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert in_order(got) == in_order(brute(docs, items))


def blocks_of(docs):
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs], pa.int64()), pa.array([b"k" * 16] * len(docs)), pa.array([t.encode() for _, t in docs])], names=["doc_id", "key", "text"])
    return list(R._index_rows(R.build_blocks([batch])))


def test_bounds_are_never_below_scores_and_mostly_close(spark):
    docs, items = made(spark, 500, 3)
    counted = {d: R.term_counts(t.encode()) for d, t in docs}
    n, total = len(docs), sum(sum(c.values()) for c in counted.values())
    df = Counter(t for c in counted.values() for t in c)
    wanted = {i: R.term_counts((t or "").encode()) for i, (_, t) in enumerate(items)}
    search = R.Items({i: c for i, c in wanted.items()}, df, n, total)
    close = everything = 0
    seen = 0
    for row in blocks_of(docs):
        bounds = dict(R.bounds_in_block(search, row))
        seen += row["docs"]
        for item in wanted:
            for k, doc_id in enumerate(row["doc_ids"]):
                exact = search.score(item, counted[doc_id], sum(counted[doc_id].values()))
                bound = int(bounds[item][k]) if item in bounds else 0
                assert bound >= exact
                everything += exact > 0
                close += exact > 0 and bound <= 1.1 * exact
    assert seen == len(docs) and close > 0.9 * everything


def test_terms_of_long_texts_are_cut_like_short_ones(monkeypatch):
    text = " ".join(f"Wörd{i % 50}-x{i % 7}" for i in range(5000)) + "y" * 3000
    whole = R.term_counts(text.encode())
    assert whole == Counter(t.encode() for t in terms(text))
    for piece in (1, 7, 100, 4096):
        monkeypatch.setattr(R, "PIECE", piece)
        assert R.term_counts(text.encode()) == whole


def test_counts_are_ordered_and_cover_any_number():
    assert R.COUNTS[:8] == [1, 2, 3, 4, 6, 8, 12, 16] and R.COUNTS[-1] > 1 << 37
    rows = R._rows_of(np.array([0, 2**64 - 1, 12345], dtype=np.uint64), 64)
    assert rows.shape == (3, R.HASHES) and rows.min() >= 0 and rows.max() < 64


def test_odd_documents(spark):
    docs = odd_documents(spark, ["word1 and word2"])
    items = [(1, "word1 and so"), (2, "the very same row"), (3, "")]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = found(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert in_order(got) == in_order(brute(rows, items))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert found(empty, spark.createDataFrame(items, "item_id long, text string")) == []
    assert found(docs, spark.createDataFrame([], "item_id long, text string")) == []
