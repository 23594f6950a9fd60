import os
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidewater.llm import linededup as L

from .helpers import odd_documents, same_as_oracle


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near(a, b):
    """As many edits as the shorter line allows: what both ends share is cut off first, and unequal letters counted."""
    allowed = min(2, min(len(a), len(b)) // 10)
    if abs(len(a) - len(b)) > allowed or sum(((Counter(a) - Counter(b)) + (Counter(b) - Counter(a))).values()) > 2 * allowed:
        return False
    n = len(os.path.commonprefix([a, b]))
    a, b = a[n:], b[n:]
    n = len(os.path.commonprefix([a[::-1], b[::-1]]))
    return edits(a[: len(a) - n], b[: len(b) - n]) <= allowed


def variant(r, text, n):
    t = list(text)
    for _ in range(n):
        k, p = r.randrange(3), r.randrange(len(t))
        if k == 0:
            t.insert(p, r.choice("abé"))
        elif k == 1:
            t.pop(p)
        else:
            t[p] = r.choice("xyz漢")
    return "".join(t)


def made_lines():
    r = random.Random(5)
    lines = []
    for _ in range(40):
        base = "".join(r.choice("abcd é") for _ in range(r.randint(20, 60))).strip() + "endofline"
        lines += [base] + [variant(r, base, r.randint(0, 4)) for _ in range(4)]
    for _ in range(30):  # lines that allow one edit, and just two
        base = "".join(r.choice("abcd") for _ in range(r.randint(8, 21)))
        lines += [base] + [variant(r, base, r.randint(0, 3)) for _ in range(3)]
    return lines + ["short", "shorx", "", "twenty characters ab", "twenty characters a", "Read more", "Read more!", "Subscribe now", "Subscribe now!", "Subscribe nou!"]


def test_oracle(spark, sf):
    same_as_oracle(spark, sf, "op10_line_dedup")


def test_banded_distance(spark):
    r, rows = random.Random(1), []
    for _ in range(400):
        a = "".join(r.choice("abé") for _ in range(r.randint(4, 30)))
        a, b = sorted((a, variant(r, a, r.randint(0, 4)) or "abcd"), key=len)
        rows.append((a, b, edits(a, b)))
    df = spark.createDataFrame(rows, "a string, b string, d int")
    for k in (1, 2, 3):
        able = df.where(f"char_length(b) - char_length(a) <= {k} AND char_length(a) > {k}")
        assert able.where(F.least("d", F.lit(k + 1)) != F.least(L.edits_within_band(F.col("a"), F.col("b"), k), F.lit(k + 1))).count() == 0


def test_links_equal_brute_force(spark):
    lines = sorted({x for x in made_lines() if x})
    docs = spark.createDataFrame([(i, "\n".join(lines[i::7])) for i in range(7)], "doc_id long, text string")
    found = L.distinct_lines(docs)
    text = {r.id: r.line for r in found.collect()}
    got = {tuple(sorted((text[r.a], text[r.b]))) for r in L.line_links(found).collect()}
    want = {tuple(sorted((a, b))) for i, a in enumerate(lines) for b in lines[:i] if near(a, b)}
    assert ("Subscribe now", "Subscribe now!") in want and ("Subscribe nou!", "Subscribe now") not in want and ("Read more", "Read more!") not in want
    assert got == want and len(want) > 30


def brute_kept(rows):
    """The rule by hand: the first line of each class stays."""
    lines = sorted({x for _, t in rows if t for x in t.split("\n") if x.strip(" ")})
    up = {x: x for x in lines}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    by_size = defaultdict(list)
    for a in lines:
        for size in range(len(a) - 2, len(a) + 3):
            for b in by_size[size]:
                if near(a, b):
                    up[root(a)] = root(b)
        by_size[len(a)].append(a)
    seen, out = set(), []
    places = defaultdict(list)
    for n, (doc_id, t) in sorted(enumerate(rows), key=lambda x: (x[1][0] is not None, x[1][0] or 0)):
        for x in (t or "").split("\n"):
            again = bool(x.strip(" ")) and root(x) in seen
            if not again:
                places[n].append(x)
            if x.strip(" "):
                seen.add(root(x))
    for n, (doc_id, t) in enumerate(rows):
        kept = "\n".join(places[n])
        if t is None:
            out.append((doc_id, None))
        elif kept == t or kept.strip():
            out.append((doc_id, kept))
    return sorted(out, key=str)


def test_drop_repeated_lines(spark):
    lines = made_lines()
    rows = [(i, "\n".join(lines[i::5] + lines[i : i + 3])) for i in range(30)] + [(90, None), (91, ""), (92, lines[0]), (93, "tiny\n" + lines[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted([(r.doc_id, r.text) for r in L.drop_repeated_lines(docs).collect()], key=str)
    assert got == brute_kept(rows)


def test_exact_copies_of_short_lines_are_folded(spark):
    rows = [(i, f"{'abcde'[i] * 15} is its own\nRead more\n \n" + "xyzuv"[i]) for i in range(5)]
    got = {r.doc_id: r.text for r in L.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].count("Read more") == 1 and all("Read more" not in got[i] and "\n \n" in got[i] for i in range(1, 5))


def test_filter_keeps_all_known_keys(spark):
    keys = spark.range(20000).select(F.xxhash64("id").alias("k"))
    rows = spark.range(60000).select(F.xxhash64("id").alias("key"), "id")
    kept = L.only_known(rows, "key", keys)
    assert kept.columns == ["key", "id"] and kept.where("id < 20000").count() == 20000 and kept.count() < 22000


def test_odd_rows(spark):
    docs = odd_documents(spark).select("doc_id", "text")
    classes = L.line_classes(docs)
    assert classes.where("n_links > 0").count() == 0
    kept = L.drop_repeated_lines(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()  # equal rows are one document
    assert L.line_classes(docs.limit(0)).count() == 0 and L.drop_repeated_lines(docs.limit(0)).count() == 0


def test_own_keys_pass_the_filter_only_if_another_line_has_them(spark):
    keys = spark.createDataFrame([(k * 7919,) for k in range(500)] + [(3 * 7919,)], "key long")
    rows = spark.createDataFrame([(k * 7919, own) for k in range(500) for own in (True, False)], "key long, own boolean")
    kept = {(r.key // 7919, r.own) for r in L.only_known(rows, "key", keys, "own").collect()}
    assert {(k, False) for k in range(500)} | {(3, True)} <= kept
    assert sum(own for _, own in kept) < 50


def test_classes_of_many_near_copies_come_from_few_pairs(spark, monkeypatch):
    # near copies that all lie two edits apart at most, and a chain whose ends only its middle connects
    crowd = [f"the same long line of a template, number {i:02d}, said again" for i in range(60)]
    chain = ["a chain of lines in which only neighbours are near " + "x" * i + "y" * (12 - i) for i in range(0, 13, 2)]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(crowd + chain + ["a line that is like no other one at all"])], "doc_id long, text string")
    lines = L.distinct_lines(docs)
    want = {frozenset(r.ids) for r in L.line_classes(docs).where("n_links > 0").groupBy("comp").agg({"line_key": "collect_set"}).toDF("comp", "ids").collect()}
    met, near = [], L._near
    monkeypatch.setattr(L, "_near", lambda pairs, able: met.append(pairs.select("a", "b").distinct().count()) or near(pairs, able))
    keyed = lines.select("id", L.text_key(lines.line).alias("line_key")).join(L.line_comps(lines), "id")
    assert {frozenset(r.ids) for r in keyed.groupBy("comp").agg({"line_key": "collect_set"}).toDF("comp", "ids").collect()} == want
    assert len(want) == 2 and sum(met) < 60 * 59 // 2 / 3
