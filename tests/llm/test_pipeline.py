import corpus_pipeline as P
from tidewater.llm import common, decontaminate, langid, linededup

from .helpers import odd_documents
from .test_decontaminate import brute as hits_by_hand
from .test_linededup import brute_kept
from .test_nearup import brute_classes
from .test_packing import check_packing


def test_run_equals_stages_by_hand(spark, sf):
    docs = common.table(spark, sf, "documents")
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    langs, scores = langid.predict(model, [t for _, t in rows], {})
    rows = [r for r, c, s in zip(rows, langs, scores) if c != "und" and s >= langid.LEAST]
    assert len(rows) > 150
    rows = brute_kept(rows)
    classes = brute_classes(rows)
    rows = [r for r in rows if classes[r[0]] == r[0]]
    items = [(r.item_id, r.text) for r in common.table(spark, sf, "benchmark").collect()]
    hit = {h[0] for h in hits_by_hand(rows, items) if h[2]}
    rows = [r for r in rows if r[0] not in hit]
    check_packing(P.run(spark, sf).collect(), dict(rows))


def test_stages_keep_the_columns_of_documents(spark, sf):
    docs = odd_documents(spark, ["the first of these texts is a plain line of words", "another text with quite other words in it"])
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes, name
        ids = {r.doc_id for r in got.collect()}
        if name != "language id":  # too few rows to learn from
            assert {0, 1, 2, 3, 4, 5} <= ids, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name


def test_line_stage_updates_sizes(spark, sf):
    text = "one line that stands in both of the texts\n"
    docs = spark.createDataFrame([(1, text + "own words of the first", "en", "s", 64), (2, text + "words of the second", "en", "s", 61)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in P.without_repeated_lines(spark, docs, sf).collect()}
    assert got[1].n_chars == 64 and got[2].text == "words of the second" and got[2].n_chars == 19
    assert linededup.THRESHOLD == 2 and decontaminate.WINDOW == 10
