import random
import re
import zlib
from collections import Counter

import pytest

from tidewater.llm import variants as V

from .helpers import odd_documents, same_as_oracle


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_forms(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        out[w] = (best if best and counts[best] >= 10 * n else None, len(near))
    rows = set()
    for w, (form, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, counts[w], n_near, counts[form] if form else None))
    return rows


def found(words):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in V.variant_forms(words).collect()}


def edited(r, w):
    p, k = r.randrange(len(w)), r.randrange(3)
    return w[:p] + w[p + 1 :] if k == 0 and len(w) > 7 else w[:p] + r.choice("abcéÿ") + w[p + (k == 1) :]


def test_oracle(spark, sf):
    same_as_oracle(spark, sf, "op11_spelling_variants")


def test_near_words_equal_brute_force(spark):
    r = random.Random(7)
    words = set()
    for _ in range(120):
        w = "".join(r.choice(r.choice(["ab", "abcdef", "xyzé"])) for _ in range(r.randint(7, 14)))
        words.add(w)
        for _ in range(4):
            w = edited(r, w)
            words.add(w)
    words |= {"a" * n for n in range(7, 12)} | {"ab" * 5, "ba" * 5, "a" + "ab" * 5, "aaaaaab", "baaaaaa", "abaaaaa"}
    counts = {w: r.choice([2, 3, 25, 400, 6000]) for w in words}
    assert found(spark.createDataFrame(list(counts.items()), "word string, n long")) == brute_forms(counts)


def test_pivots_are_the_cheapest_disjoint_pair():
    r = random.Random(3)
    for _ in range(500):
        cost = [r.randrange(20) for _ in range(r.randint(5, 12))]
        prefix = V.prefix_of([(c, i) for i, c in enumerate(cost)])
        first, second = costs = V.pivot_costs(cost)
        got = V.pivots_of(prefix, costs)
        pairs = [(first[a] + second[b]) for a in prefix for b in prefix if b - a >= 2]
        assert got[1] - got[0] >= 2 and first[got[0]] + second[got[1]] == min(pairs)
    tied = V.prefix_of([(1, "aa")] * 6 + [(2, "ab")])
    assert tied == [0, 1, 2, 3, 4, 5]


def test_one_edit_alters_two_odd_letters_at_most():
    r = random.Random(8)
    for _ in range(300):
        w = "".join(r.choice("abcdeéÿ") for _ in range(r.randint(7, 12)))
        assert ((V.odd_letters(w) ^ V.odd_letters(edited(r, w))) & (2**64 - 1)).bit_count() <= 2


def test_words_equal_brute_force(spark):
    docs = [(i, " ".join(random.Random(i % 9).choices(["Wördery", "ÀLONGword", "another", "seventy", "eightynine", "short", "x÷y×zabc", "9digits8inbetween"], k=60))) for i in range(60)]
    docs += [(None, "another another\nanother"), (3, None), (4, ""), (5, "another" * 3000 + " " + "another" * 3000)]
    got = {r.word: r.n for r in V.counted_words(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_counts(docs) and len(got) > 10


def test_ties_chains_and_hot_forms(spark):
    counts = {"aaaaaaa": 50_000, "aaaaaab": 500, "aaaaabb": 5, "caaaaaa": 50_000, "aaaaaaaz": 5}
    counts |= {f"aaaaa{x}{y}": 3 for x in "defgh" for y in "ijklm"}
    rows = found(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert rows == brute_forms(counts)
    by_word = {r[0]: r for r in rows}
    assert by_word["aaaaabb"][1:3] == ("aaaaaab", "aaaaaaa") and by_word["caaaaaa"][1] is None


def test_odd_documents(spark):
    docs = odd_documents(spark, ["strange strange strange", "strnage strange"])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(V.counted_words(docs)) == brute_forms(brute_counts(rows))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert found(V.counted_words(empty)) == set()
    with pytest.raises(ValueError):
        V.runs_of_letters(empty, least=3)
    with pytest.raises(ValueError):
        V.variant_forms(spark.createDataFrame([], "word string, n long"), dominance=1)
