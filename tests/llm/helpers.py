"""Shared fixtures of the training-data tests: odd documents and the oracle comparison."""

from __future__ import annotations

import duckdb

from tools.check_oracle import digest

TABLES = "documents embeddings pages benchmark labels conversations".split()

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, line string, node long, comp long, score double, size int"


def odd_documents(spark, texts=()):
    """Nulls in every column, empty and very long texts, repeated rows, clashing column names."""
    long = " ".join(f"word{i % 997} and so on" for i in range(20_000))
    rows = [(i, t, "en", "s", len(t), None, "l", i, 1, 0.5, 3) for i, t in enumerate(texts)]
    n = len(rows)
    rows += [
        (n, None, None, None, None, None, None, None, None, None, None),
        (None, "a text without an id and with no other trouble at all", "en", None, None, "k", None, None, None, None, None),
        (n + 1, "", "en", "s", 0, "", "", 0, 0, 0.0, 0),
        (n + 2, " \n\n\t ", "en", "s", 5, "", "", 0, 0, 0.0, 0),
        (n + 3, long, "en", "s", len(long), "", "", 0, 0, 0.0, 0),
        (n + 4, "the very same row, twice\nand its second line is the same too", "en", "s", 9, "", "", 0, 0, 0.0, 0),
        (n + 4, "the very same row, twice\nand its second line is the same too", "en", "s", 9, "", "", 0, 0, 0.0, 0),
    ]
    return spark.createDataFrame(rows, ODD_SCHEMA)


def same_as_oracle(spark, sf, name):
    """A registered query's rows equal those of its SQL."""
    from tidewater.llm import oracle, queries

    df = queries.REGISTRY[name](spark, sf)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    result = con.execute(oracle.ORACLE[name])
    columns = [c[0] for c in result.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[:2] == digest(columns, result.fetchall())[:2]
