import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import nearup as N
from tidewater.llm.queries import REGISTRY

from .helpers import odd_documents


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_distance():
    r = random.Random(4)
    for _ in range(400):
        a = [r.randrange(4) for _ in range(r.randint(0, 25))]
        b = list(a)
        for _ in range(r.randint(0, 6)):
            k, p = r.randrange(3), r.randrange(len(b) + 1)
            b[p : p + (k > 0)] = [9] * (k < 2)
        d = edits(a, b)
        for limit in (0, 1, 3, 8):
            got = N.banded_distance(a, b, limit)
            assert got == d if d <= limit else got > limit


def test_sketch_depends_on_order():
    words = [f"w{i}" for i in range(400)]
    a, b = N.shingles(" ".join(words)), N.shingles(" ".join(words[200:] + words[:200]))
    same = np.mean(N.order_minhash(a, 400, 5) == N.order_minhash(b, 400, 5))
    near = list(words)
    near[100] = "x"
    assert same < 0.3 < np.mean(N.order_minhash(a, 400, 5) == N.order_minhash(N.shingles(" ".join(near)), 400, 5))


def brute_classes(texts):
    """Smallest id of each component of similar texts, all pairs compared."""
    shingled = {i: N.shingles(t or "") for i, t in texts}
    up = {i: i for i, _ in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = [i for i, _ in texts]
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if len(shingled[i]) and len(shingled[j]) and N.similar(shingled[i], shingled[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in ids}


def test_classes_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.class_id for r in REGISTRY["op1_minhash_near_dedup"](spark, sf).collect()}
    assert got == want and len(set(want.values())) < len(want)


def test_group_of_near_copies(spark):
    r = random.Random(9)
    words = [f"w{r.randrange(5000)}" for _ in range(300)]
    texts = []
    for i in range(60):  # each a few words from the first, most unlike one another by some words
        w = list(words)
        for _ in range(3):
            w[r.randrange(300)] = f"x{r.randrange(9999)}"
        texts.append(" ".join(w))
    texts += [" ".join(f"o{r.randrange(9999)}" for _ in range(300)) for _ in range(20)]
    texts += [" ".join(words[:60] + [f"p{i}_{k}" for k in range(300)]) for i in range(15)]  # only a passage shared
    docs = odd_documents(spark, texts)
    got = N.with_classes(docs.select("doc_id", "text")).collect()
    by_id = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert {by_id[i] for i in range(60)} == {0}
    assert all(by_id[i] == i for i in range(60, len(texts) + 5))
    kept = N.one_of_each_class(docs.select("doc_id", "text", "source"))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == ["doc_id", "text", "source"] and len(ids) == 1 + 35 + 6  # the repeated row once
    assert N.with_classes(docs.select("doc_id", "text").limit(0)).count() == 0


def test_similar_texts_share_a_tier():
    for n in range(1, 200):
        for m in range(n, int(n / N.SIMILARITY) + 1):
            assert set(N.tiers(n)) & set(N.tiers(m)), (n, m)


def test_similarity_counts_paired_shingles():
    a = np.arange(100, dtype=np.uint64)
    replaced = a.copy()
    replaced[:11] += np.uint64(1000)
    assert N.similar(a, replaced) and N.similar(a, a[:80]) and not N.similar(a, a[:79])
    replaced[11] += np.uint64(1000)
    assert not N.similar(a, replaced) and not N.similar(a, a[::-1].copy())


def paired_by_table(a, b):
    """Longest common subsequence, cell by cell."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_passages_removed_and_added():
    words = [f"w{i}" for i in range(1, 105)]
    for lost in (6, 8):  # header dropped, footer added: 92 of 108 for 8 words
        assert N.similar(N.shingles(" ".join(words)), N.shingles(" ".join(words[lost:] + [f"new{i}" for i in range(lost)])))
    r, seen = random.Random(12), set()
    for _ in range(1500):
        kinds = r.choice((3, 30, 100_000))  # few kinds repeat a lot
        a = [r.randrange(kinds) for _ in range(r.randint(1, 70))]
        b = list(a)
        for _ in range(r.randint(0, 3)):
            p, size = r.randrange(len(b) + 1), r.randint(0, 7)
            if r.random() < 0.5 and len(b) > size:
                del b[p : p + size]
            else:
                b[p:p] = [r.randrange(kinds) for _ in range(size)]
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        common = paired_by_table(a, b)
        assert N.paired(x, y) == N.paired(y, x) == common
        want = common >= N.SIMILARITY * (len(a) + len(b) - common) - 1e-9
        assert N.similar(x, y) == N.similar(y, x) == want
        seen.add((kinds, want))
    assert len(seen) == 6


def test_band_keeps_what_is_similar():
    r, near = random.Random(21), 0
    for _ in range(1500):
        kinds = r.choice((2, 5, 40, 100_000))
        a = [r.randrange(kinds) for _ in range(r.randint(1, 90))]
        b = [x for x in a if r.random() > r.choice((0.02, 0.3))]
        for _ in range(r.randint(0, 9)):
            b.insert(r.randrange(len(b) + 1), r.randrange(kinds))
        if not b:
            continue
        x, y, common = np.array(a, np.uint64), np.array(b, np.uint64), paired_by_table(a, b)
        for need in (0, common // 2, common, common + 1, common + 5):
            got = N.paired(x, y, need)
            assert got == common if need <= common else got <= common
        near += common > 0.8 * len(a)
    assert near > 300


def test_bits_and_lists_agree():
    r = random.Random(8)
    for _ in range(300):
        a, b = [[r.randrange(4) for _ in range(r.randint(1, 60))] for _ in "ab"]
        below, above = r.randint(0, 30), r.randint(0, 30)
        places = {x: [j for j, y in enumerate(b) if x == y] for x in set(b)}
        matches = [(i, places[x]) for i, x in enumerate(a) if x in places]
        near = [[j for j in reversed(p) if -below <= j - i <= above] for i, p in matches]
        assert N._by_bits(matches, below, above) == N._by_matches(near)


def test_parities_lose_no_similar_pair():
    r = random.Random(5)
    for _ in range(600):
        n = r.choice((1, 4, 20, 150, 900, 1250))
        a = np.array([r.randrange(r.choice((3, 10**9))) for _ in range(n)], np.uint64)
        b = np.array([x if r.random() > 0.15 else r.randrange(10**9) for x in a.tolist()], np.uint64)
        turned = int(np.bitwise_count(N.parities(a) ^ N.parities(b)).sum())
        common = len(np.intersect1d(N.labelled(a), N.labelled(b)))
        assert turned <= 2 * n - 2 * common
    # texts that are near in length have one kind of print in common
    assert math.ceil(N.SIMILARITY * (N.PARITY_MOST + 1)) >= N.SIGNS_LEAST


def test_prints_inside_spark(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for n in (8, 100, 900, 1200, 1300, 1900):
        for lost in (0, 0.05, 0.12, 0.3, 0.7):
            w = words[:n]
            w[: int(lost * n)] = [f"x{r.random()}" for _ in range(int(lost * n))]
            rows.append((" ".join(words[:n]), " ".join(w)))
            rows.append((" ".join(words[: int(n * 0.9)]), " ".join(w)))
    made = []
    for a, b in rows:
        pair = []
        for t in (a, b):
            sh = N.shingles(t)
            longs = lambda x: [int(v) for v in x.view(np.int64)]
            pair.append((len(sh), longs(N.parities(sh)) if len(sh) <= N.PARITY_MOST else None, longs(N.signs(sh)) if len(sh) >= N.SIGNS_LEAST else None))
        made.append((*pair, N.similar(N.shingles(a), N.shingles(b))))
    one = "struct<n:long,parities:array<long>,signs:array<long>>"
    got = spark.createDataFrame(made, f"a {one}, b {one}, similar boolean").withColumn("may", N.may_be_similar(F.col("a"), F.col("b"))).collect()
    assert all(x.may for x in got if x.similar) and sum(x.similar for x in got) > 15 and sum(not x.may for x in got) > 15


def missed(n, m):
    """The probability that texts of n and m shingles that are just similar share no sketch."""
    common = math.ceil(N.SIMILARITY * (n + m) / (1 + N.SIMILARITY) - 1e-9)
    out = 1.0
    for picked, sketches in set(N.tiers(n)) & set(N.tiers(m)):
        out *= (1 - math.comb(common, picked) / math.comb(n + m - common, picked)) ** sketches
    return out


def test_similar_texts_are_candidates():
    for n in [*range(2, 300), *range(300, 20_000, 1970)]:
        for m in range(n, int(n / N.SIMILARITY + 1e-9) + 1, 1 + n // 300):
            assert missed(n, m) < 1e-5, (n, m)
    # of long texts that fill all bins a sign differs where the smallest shingle does, every other time
    differ = (1 - N.SIMILARITY) / 2
    assert sum(math.comb(N.BINS, i) * differ**i * (1 - differ) ** (N.BINS - i) for i in range(N.MOST_SIGNS + 1, N.BINS + 1)) < 1e-5


def test_just_similar_texts_meet():
    r = random.Random(3)
    for n in (13, 30, 40, 50, 60, 100):
        for _ in range(300):
            a = np.array([r.getrandbits(63) for _ in range(n)], np.uint64)
            b = a.copy()
            out = n - math.ceil(N.SIMILARITY * 2 * n / (1 + N.SIMILARITY) - 1e-9)
            b[r.sample(range(n), out)] ^= np.uint64(1 << 63)
            assert N.similar(a, b) and set(N.all_sketches(a).tolist()) & set(N.all_sketches(b).tolist())
