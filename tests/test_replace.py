"""Replacing a table, schema and all; exact integers; failing jobs; the stream's own checkpoint."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry import jobs
from quarry.functions import fixed_values as fv
from quarry.functions.scalar import to_long
from quarry.plans.silver import replace_table


def test_replacing_changes_the_schema(spark, fresh_db):
    t = f"{fresh_db['silver']}.t"
    replace_table(spark, spark.createDataFrame([(1,)], "a long"), t)
    replace_table(spark, spark.createDataFrame([(1, "x")], "a long, b string"), t)
    assert [tuple(r) for r in spark.table(t).collect()] == [(1, "x")]
    replace_table(spark, spark.createDataFrame([("one", "x")], "a string, b string"), t)
    assert [tuple(r) for r in spark.table(t).collect()] == [("one", "x")]
    replace_table(spark, spark.table(t).select("b"), t)             # its own input
    assert [tuple(r) for r in spark.table(t).collect()] == [("x",)]


def test_old_versions_go_by_age(spark, fresh_db):
    t = f"{fresh_db['silver']}.aged"
    first = replace_table(spark, spark.createDataFrame([(1,)], "a long"), t)
    second = replace_table(spark, spark.createDataFrame([(2,)], "a long"), t)
    assert os.path.isdir(first.removeprefix("file:")) and os.path.isdir(second.removeprefix("file:"))
    third = replace_table(spark, spark.createDataFrame([(3,)], "a long"), t, keep_hours=0)
    assert not os.path.isdir(first.removeprefix("file:")) and os.path.isdir(third.removeprefix("file:"))


def test_integers_are_exact(spark):
    texts = ["9007199254740993", "1,234,567,890,123,456,789", "-12", "12.9", "1e3", "99999999999999999999", "x", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(to_long("s", None)).collect()]
    assert got[:5] == [9007199254740993, 1234567890123456789, -12, 12, 1000] and got[5:] == [None, None, None]


def page(n, of):
    return json.dumps([{"page": n, "pages": of}, [{"date": "2020", "value": 1}]])


@pytest.mark.parametrize("pages", [[page(1, 3)], [page(1, 2), json.dumps([{"message": [{"id": "120"}]}])]])
def test_broken_pages_fail_and_are_logged(spark, monkeypatch, pages):
    folder = tempfile.mkdtemp()
    for i, p in enumerate(pages):
        with open(os.path.join(folder, f"{i}.json"), "w") as f:
            f.write(p)
    logged = []
    monkeypatch.setattr("quarry.operators.landing.log_failure", lambda s, source, *a, **k: logged.append(source))
    assert jobs.land_all(spark, None, folder, None, None) == 1 and len(logged) == 1


def test_a_sheet_without_values_fails(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(), "sheet.csv")
    with open(path, "w") as f:
        f.write(",".join(fv.METRIC_ID_COLUMNS) + ",01/12/2004\n" + ",".join("x" for _ in fv.METRIC_ID_COLUMNS) + ",\n")
    logged = []
    monkeypatch.setattr("quarry.operators.landing.log_failure", lambda s, source, *a, **k: logged.append(source))
    assert jobs.land_all(spark, None, None, None, path) == 1 and len(logged) == 1


def test_silver_without_bronze_counts_every_source(spark, monkeypatch):
    logged = []
    monkeypatch.setattr("quarry.plans.silver.log_silver", lambda s, rows, *a: logged.extend(rows))
    from quarry.plans.silver import SOURCES
    monkeypatch.setattr("quarry.plans.silver.SOURCES", [s for s in SOURCES if not spark.catalog.tableExists(s.bronze_table)])
    from quarry.plans import silver
    assert jobs.silver(spark, None, 1) == len(silver.SOURCES) == len(logged)
    assert all(r[-2] == "error" for r in logged)
