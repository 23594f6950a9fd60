import math
import random
import zlib
from collections import Counter, defaultdict

from tidewater.llm import ppm
from tidewater.llm.queries import REGISTRY

from .helpers import odd_documents


def low(text):
    return (text or "").encode().translate(ppm._LOWER)


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def by_hand(rows):
    """The model with nested dictionaries, a symbol at a time."""
    train = [low(t) for d, t in rows if not held_out(d)]
    words = Counter(w for t in train for w in t.split())
    words[None] = len(train)
    n, v = sum(words.values()), sum(c > 0 for c in words.values())
    trie = [defaultdict(Counter) for _ in range(5)]
    for t in train:
        a = b"\xfe" * 4 + t + b"\xff"
        for i in range(4, len(a)):
            for k in range(5):
                trie[k][a[i - k : i]][a[i]] += 1

    def logp(before, symbol):
        total, excluded = 0.0, set()
        for k in range(4, -1, -1):
            seen = {s: c for s, c in trie[k].get(before[4 - k :], {}).items() if s not in excluded}
            if seen:
                mass = sum(seen.values()) + len(seen)
                if symbol in seen:
                    return total + math.log10(seen[symbol] / mass)
                total += math.log10(len(seen) / mass)
                excluded |= set(seen)
        return total - math.log10(255 - len(excluded))

    out = []
    for d, t in rows:
        a, w = b"\xfe" * 4 + low(t) + b"\xff", [*low(t).split(), None]
        base = sum(math.log10((words.get(x, 0) + 1) / (n + v + 1)) for x in w)
        out.append((d, held_out(d), len(w), sum(words.get(x, 0) > 0 for x in w), n, base, sum(logp(a[i - 4 : i], a[i]) for i in range(4, len(a)))))
    return sorted(out, key=str)


def same(got, want):
    got = sorted((tuple(r) for r in got), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9)


def test_equals_model_by_hand(spark):
    r = random.Random(3)
    rows = [(i, None if i == 5 else "".join(r.choice("ab cé\nX漢\t") for _ in range(r.randint(0, 60)))) for i in range(120)]
    same(ppm.score(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=700).collect(), by_hand(rows))


def test_odd_rows(spark):
    docs = odd_documents(spark, ["The cat, the CAT", "a\u00a0b\x85c", "É é"])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    same(ppm.score(docs).collect(), by_hand(rows))
    assert ppm.score(docs.limit(0)).count() == 0


def test_no_training_rows(spark):
    ids = [i for i in range(200) if held_out(i)][:4]
    rows = [(i, "abc abc") for i in ids]
    same(ppm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(), by_hand(rows))


def test_held_out_texts_are_predicted(spark, sf):
    rows = REGISTRY["op9_lm_scoring"](spark, sf).collect()
    size = {r.doc_id: len(low(r.text)) + 1 for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(size) and all(r.score < 0 for r in rows)
    bits = -sum(r.score for r in held) / sum(size[r.doc_id] for r in held) / math.log10(2)
    assert bits < 3.5  # of 8 for uniform bytes
