import re

from pyspark.sql import functions as F

from tidewater.llm import decontaminate as D

from .helpers import odd_documents, same_as_oracle


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    """Every window of every document looked up among the items' windows."""
    windows = {}
    for item_id, item in items:
        v = words(item)
        size = min(10, len(v))
        for s in range(len(v) - size + 1 if v else 0):
            windows.setdefault(tuple(v[s : s + size]), set()).add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for p in range(len(w) - size + 1):
                found = windows.get(tuple(w[p : p + size]))
                if found:
                    hit |= set(range(p, p + size))
                    ids |= found
        out.append((doc_id, len(w), len(hit), tuple(sorted(ids))))
    return sorted(out, key=str)


def test_oracle(spark, sf):
    same_as_oracle(spark, sf, "op8_benchmark_decontamination")


def test_brute_force_and_odd_rows(spark):
    passage = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    texts = [
        "before " + passage.upper() + ", after",
        "x " + " ".join(passage.split()[:9]) + " y",
        "!alpha! beta-gamma delta epsilon zeta eta theta iota KAPPA",
        "tiny item here; Ünïcode wörds 漢字 too",
        "a a a a a a a a a a a a a a a",
        "A" * 30_000 + " " + passage,
    ]
    items = [(1, passage), (None, "tiny item"), (3, ""), (4, None), (5, "a a a a a a a a a a a"), (5, "WÖRDS 漢字"), (7, "never seen words only"), (1, passage)]
    docs = odd_documents(spark, texts)
    got = D.contamination(docs.select("doc_id", "text"), spark.createDataFrame(items, "item_id long, text string"))
    rows = sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got.collect()], key=str)
    assert rows == brute([(r.doc_id, r.text) for r in docs.collect()], items)


def test_no_items_and_no_documents(spark):
    docs = odd_documents(spark, ["one two three"]).select("doc_id", "text")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(docs, none).where("n_hit > 0").count() == 0
    assert D.contamination(docs, none).count() == docs.count()
    assert D.contamination(docs.limit(0), spark.createDataFrame([(1, "one two")], "item_id long, text string")).count() == 0


def test_proximity(spark):
    item = "red orange yellow green blue indigo violet black white grey brown"
    docs = [(1, "red orange yellow extra green blue indigo violet black white grey brown"), (2, "brown " + "filler " * 60 + "red"), (3, item)]
    got = D.proximity_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string"), slack=2)
    keys = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", D.text_key(F.col("text")).alias("key"))
    assert {r.doc_id for r in got.join(keys, "key").collect()} == {1, 3}
