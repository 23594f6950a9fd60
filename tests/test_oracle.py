"""Registered queries against their DuckDB oracles on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tidewater import oracle as O
from tidewater import queries as Q
from tools.check_oracle import digest

LIBRARY = sorted(O.ORACLE)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in E.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(Q.REGISTRY) == set(O.ORACLE)


@pytest.mark.parametrize("name", LIBRARY)
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    orows = res.fetchall()
    ocols = [d[0] for d in res.description]
    assert digest(df.columns, srows)[:2] == digest(ocols, orows)[:2]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "claim_count" in df.columns


@pytest.mark.parametrize("name", ["cdc_scd1_events", "cdc_scd2_lines", "fact_header"])
def test_results_do_not_depend_on_session_time_zone(spark, sf, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, sf)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    res = con.execute(E.oracle_sql()[name])
    assert digest(df.columns, srows)[:2] == digest([d[0] for d in res.description], res.fetchall())[:2]
