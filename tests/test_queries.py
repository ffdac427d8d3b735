"""Every registered query against its DuckDB oracle at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from quarry.plans import analogue_sql, analogues, lifecycle, published
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(analogues.QUERIES) == set(analogue_sql.oracle()) and set(lifecycle.QUERIES) == set(lifecycle.oracle())
    assert set(published.QUERIES) == set(published.oracle())
    assert set(analogues.QUERIES) | set(lifecycle.QUERIES) | set(published.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(analogue_sql.oracle() | lifecycle.oracle() | published.oracle()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(srows, df.columns) == rows_of(res.fetchall(), dcols)


def test_run_isolation_logs_the_broken_source(spark):
    rows = {r["source"]: r for r in E.queries()["run_isolation"](spark, SF).collect()}
    assert rows["orders_broken"]["status"] == "error"
    assert rows["lineitem"]["status"] == "ok"
    r = rows["lineitem"]
    assert r["rows_in"] == r["rows_clean"] + r["rows_quarantined"] + r["rows_deduped"]
