import math
import random

from pyspark.sql import functions as F

from tidewater.llm import topk

from .helpers import same_as_oracle


def brute(rows, k=5):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(256 * x) for x in v]
    out = []
    for q, a in usable.items():
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q and len(a) == len(b))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_oracle(spark, sf):
    same_as_oracle(spark, sf, "op3_exact_topk")


def test_ties_copies_and_odd_vectors(spark):
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(260)]  # many ties and copies
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(300, 420)]
    rows += [(450, None), (500, [None, 1.0, 1.0, 1.0]), (550, [float("nan")] * 4), (600, [float("inf")] + [1.0] * 3), (650, []), (700, [3.0]), (701, [2.0])]
    rows += [(None, [1.0] * 4), (750, [3e6, -3e6, 2.5e6, 1.0]), (751, [2e6, 1e6, -3e6, 7.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, key string")
    got = sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute(rows)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    r = random.Random(2)
    rows = [(i, [r.gauss(0, 1) for _ in range(7)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(x.vec_id, list(x.embedding)) for x in df.collect()]
    assert sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()) == brute(rows)
