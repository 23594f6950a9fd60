import zlib
from itertools import product

import numpy as np

from tidewater.llm import langid as L
from tidewater.llm.queries import REGISTRY

from .helpers import odd_documents


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    sizes = np.asarray([5, 3, 1])
    scores, moves, start = rng.normal(size=(9, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    post, counts, logz = L.forward_backward(scores, sizes, moves, start, pairs=True)
    want, want_counts, want_z, at = np.zeros_like(post), np.zeros((3, 3)), 0.0, 0
    for n in sizes:
        paths = list(product(range(3), repeat=int(n)))
        w = np.asarray([np.exp(start[p[0]] + sum(scores[at + i, y] for i, y in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        want_z += np.log(w.sum())
        for p, x in zip(paths, w / w.sum()):
            for i, y in enumerate(p):
                want[at + i, y] += x
            for a, b in zip(p, p[1:]):
                want_counts[a, b] += x
        at += n
    assert np.allclose(post, want) and np.allclose(counts, want_counts) and np.isclose(logz, want_z)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = REGISTRY["op4_language_id"](spark, sf).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_switch_inside_a_text(spark):
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text").collect() if r.text]
    model = L.train([(r.text, r.lang) for r in docs[:400]])
    words = {c: [w for r in docs[400:] if r.lang == c for w in L.words_of(r.text)][:40] for c in ("en", "de")}
    scores = model.word_scores(words["en"] + words["de"])
    post = L.forward_backward(scores, np.asarray([len(scores)]), model.moves, model.start)
    labels = np.asarray(model.labels)[post.argmax(axis=1)]
    assert (labels[:40] == "en").mean() > 0.9 and (labels[40:] == "de").mean() > 0.9


def test_odd_rows(spark):
    docs = odd_documents(spark, ["the and of that with"] * 3 + ["der die und nicht ist"] * 3 + ["12 34 .", "²³"])
    docs = docs.withColumnRenamed("score", "other")
    model = L.train([("the and of that with this", "en"), ("der die und nicht ist ein", "de")] * 5)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(docs, model).collect()}
    assert got[0][0] == "en" and got[3][0] == "de"
    assert [got[i] for i in (6, 7, 8, 9, 10)] == [("und", 0.0)] * 5
    assert L.train([]) is None and {r.lang_pred for r in L.identify(docs, None).collect()} == {"und"}
    kept = L.accepted(docs, model)
    assert kept.columns == docs.columns and {6, 7, 8, 9, 10}.isdisjoint({r.doc_id for r in kept.collect()})
    assert L.fit(docs.where("lang IS NULL")) is None and L.identify(docs.limit(0), model).count() == 0


def test_long_texts_in_stretches_equal_one_walk(spark, monkeypatch):
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text").collect() if r.text]
    model = L.train([(r.text, r.lang) for r in docs[:200]])
    by_lang = {c: " ".join(r.text for r in docs[200:400] if r.lang == c) for c in ("en", "de")}
    texts = [by_lang["en"], by_lang["de"], by_lang["en"] + " " + by_lang["de"], None, "the end", ""]
    assert len(L.words_of(texts[2])) > 3 * L.LONG
    parts = L.predict(model, texts, {})
    monkeypatch.setattr(L, "LONG", 10**9)
    whole = L.predict(model, texts, {})
    assert parts[0] == whole[0] and np.allclose(parts[1], whole[1], atol=1e-3)
    monkeypatch.setattr(L, "WORDS_AT_ONCE", 1)  # one text at a time gives the same
    assert np.allclose(L.predict(model, texts, {})[1], whole[1])


def test_word_scores_are_rows_of_one_bounded_table(monkeypatch):
    """Scores of many words: one table no larger than the bound and one call's words, and the same rows after it was emptied."""
    model = L.train([("the quick brown fox", "en"), ("der schnelle braune fuchs", "de")], epochs=2)
    monkeypatch.setattr(L, "_CACHE_WORDS", 20)
    known = L.WordScores(model)
    letters = "abcdefgh"
    for i in range(8):
        words = [f"{letters[i]}{x}{y}" for x in letters for y in letters[:2]]
        assert np.allclose(known.of(words), model.word_scores(words))
        assert known.of(words[::-1]).shape == (16, 2)
        assert len(known.place) <= len(known.table) <= 20 + 16


def test_long_arrow_batches_are_worked_off_in_slices():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"n": list(range(2 * L.ROWS_AT_ONCE + 1))})
    parts = list(L._parts([batch]))
    assert [p.num_rows for p in parts] == [L.ROWS_AT_ONCE, L.ROWS_AT_ONCE, 1]
    assert [n for p in parts for n in p.column("n").to_pylist()] == batch.column("n").to_pylist()


def test_whole_texts_go_to_python_in_small_batches_unless_the_caller_says_otherwise(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    docs = spark.range(3000).selectExpr("id AS doc_id", "'ein Text' AS text", "'de' AS lang").coalesce(1)
    model = L.train([("ein Text", "de"), ("a text", "en")])
    try:
        for mine, want in ((None, "1000"), ("70", "70")):
            spark.conf.unset(key)
            if mine:
                spark.conf.set(key, mine)
            found = L.accepted(docs, model)
            assert spark.conf.get(key) == want and found.count() == 3000
    finally:
        spark.conf.unset(key)
        if before:
            spark.conf.set(key, before)
    assert L._CACHE_WORDS <= 100_000
