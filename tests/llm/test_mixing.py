import hashlib
import math
import re

from pyspark.sql import functions as F

from tidewater.llm import mixing as M

from .helpers import odd_documents, same_as_oracle


def brute_targets(sizes, weights, share, most):
    """Resharing as stated: what goes beyond a cap is shared among the others by weight, until none is above."""
    left, free, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free and left > 1e-9:
        total = sum(weights[i] for i in free)
        for i in free:
            target[i] += left * weights[i] / total
        left = 0.0
        for i in list(free):
            if target[i] >= most * sizes[i]:
                left += target[i] - most * sizes[i]
                target[i] = float(most * sizes[i])
                free.discard(i)
    return target


def brute(rows):
    """(doc_id, size, source size, target, taken) of (doc_id, text, source) rows, by hand."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    held = [sum(n for n, r in zip(size, rows) if r[2] == s) for s in names]
    targets = brute_targets(held, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2)
    out = []
    for s, total, target in zip(names, held, targets):
        keyed = []
        for (doc_id, text, source), n in zip(rows, size):
            if source == s:
                digest = hashlib.md5(f"{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
                quality = (len(re.findall("[A-Za-z]", text or "")) + 1) / (len(text or "") + 1)
                keyed.append((-math.log((int(digest[:13], 16) + 0.5) / 2**52) / quality, digest, n, doc_id))
        words = math.floor(target + 0.5)
        epochs = words // total if total else 0
        left = words - epochs * total
        for _, _, n, doc_id in sorted(keyed, key=lambda k: k[:3]):
            more = max(0, min(left, n))
            left -= more
            out.append((doc_id, n, total, round(target, 6), epochs * n + more))
    return out


def mix(docs):
    rows = docs.select(
        "doc_id",
        "source",
        M.word_count(F.col("text")).alias("size"),
        M.letter_share(F.col("text")).alias("quality"),
        M.row_digest(F.col("doc_id"), F.col("text")).alias("digest"),
    )
    found = M.mixed(rows, F.col("source"), F.col("size"), F.col("quality"), F.col("digest"))
    return [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in found.select("row.doc_id", "size", "source_size", "target", "taken").collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_oracle(spark, sf):
    same_as_oracle(spark, sf, "op12_source_mixing")


def test_equals_brute_force_with_hot_and_tiny_sources(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 37)), "hot") for i in range(120)]
    rows += [(1000 + i, "one two\tthree\x0bfour five " * (i % 4), f"s{i % 5}") for i in range(40)]
    rows += [(2000, "the only one", "alone"), (2001, "", "empty"), (2002, None, "null text"), (None, "no id here", None), (2003, "no source", None)]
    rows += [(7, "the same row again", "copies")] * 30
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5))
    assert in_order(got) == in_order(brute(rows))


def test_sources_meet_targets_and_no_row_is_taken_more_than_twice(spark, sf):
    got = mix(spark.read.parquet(f"{sf}/documents.parquet"))
    assert all(0 <= taken <= 2 * n for _, n, _, _, taken in got)
    taken, target = {}, {}
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for doc_id, _, _, t, n in got:
        taken[docs[doc_id]] = taken.get(docs[doc_id], 0) + n
        target[docs[doc_id]] = t
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in taken)


def test_targets(spark):
    cases = [[100, 1, 50, 7], [10], [0, 0, 0], [5, 0, 5], [1, 1000, 1, 1000, 30, 2]]
    for sizes in cases:
        rows = [(i, n) for i, n in enumerate(sizes)]
        found = M.source_targets(spark.createDataFrame(rows, "place long, source_size long"), (3, 1, 2), 1.5, 2)
        got = [r.target for r in found.orderBy("place").collect()]
        want = brute_targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5, 2)
        assert all(math.isclose(a, b, abs_tol=1e-6) for a, b in zip(got, want)), (sizes, got, want)
    # a share above what all may give: everything at its cap
    found = M.source_targets(spark.createDataFrame([(0, 4), (1, 6)], "place long, source_size long"), (3, 1), 5.0, 2)
    assert [r.target for r in found.orderBy("place").collect()] == [8.0, 12.0]


def test_better_rows_come_more_often(spark):
    rows = spark.range(20000).select("id", F.lit("s").alias("source"), F.lit(1).alias("size"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("quality"))
    found = M.mixed(rows, F.col("source"), F.col("size"), F.col("quality"), M.row_digest(F.col("id")), share=0.2)
    even, odd = found.where("taken = 1").agg(F.count_if(F.expr("row.id % 2 = 0")), F.count_if(F.expr("row.id % 2 = 1"))).first()
    assert even + odd == 4000 and even > 2.5 * odd


def test_odd_rows(spark):
    got = mix(odd_documents(spark))
    assert len(got) == 7 and sum(n for *_, n in got) == sum({(s, t) for _, _, s, t, _ in got} and [round(t) for t in {(s, t): t for _, _, s, t, _ in got}.values()])
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(empty) == []
    # unusable qualities count as the least, the columns' names clash with the operator's own
    rows = spark.createDataFrame([(1, "a", 2, None), (2, "a", 3, float("nan")), (3, "a", 4, -1.0), (4, "a", None, 1.0)], "taken int, _source string, _size int, _key double")
    found = M.mixed(rows, F.col("_source"), F.col("_size"), F.col("_key"), M.row_digest(F.col("taken")))
    assert sum(r.taken for r in found.collect()) == 14 and found.columns == ["row", "size", "source_size", "target", "taken"]


def test_reruns_agree_whatever_the_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert in_order(mix(docs)) == in_order(mix(docs.repartition(13)))
