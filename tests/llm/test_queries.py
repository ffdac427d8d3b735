"""The registered queries: names, oracles, columns."""

import duckdb
import pytest

import __spark_entry__ as E
from quarry.llm import queries
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = [k for k in E.queries() if k.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(res.fetchall(), columns)
