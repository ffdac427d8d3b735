"""Data tests over changes against full runs of the same tests."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quarry.functions import fixed_values as fv
from quarry.operators import incremental_tests as I
from quarry.operators.data_tests import accepted_range, not_null, relationships, run_data_tests, unique, unique_combination
from quarry.operators.landing import land
from quarry.plans import incremental
from quarry.plans import silver as S

TESTS = [unique("child", "id"), unique_combination("child", ["id", "fk"]), relationships("child", "fk", "parent", "pk"),
         not_null("child", "v"), accepted_range("child", "v", min_value=0, max_value=5), unique("parent", "pk")]


def frames(spark, child, parent):
    return {"child": spark.createDataFrame(child, "id long, fk int, v int"), "parent": spark.createDataFrame(parent, "pk long")}


def full(spark, child, parent):
    return {r["test_name"]: (r["failures"], r["status"]) for r in run_data_tests(frames(spark, child, parent), TESTS).collect()}


def shown(results):
    return {r["test_name"]: (r["failures"], r["status"]) for r in results}


def test_every_change_gives_the_failures_of_a_full_run(spark, fresh_db):
    rng, runs = random.Random(3), f"{fresh_db['meta']}.test_runs"
    child, parent = [], []
    for k, n in enumerate((30, 5, 0, 12)):
        more = [(rng.choice([rng.randrange(40), rng.randrange(40), None]), rng.choice([rng.randrange(12), None]), rng.choice([1, -1, 9, None])) for _ in range(n)]
        gone = rng.sample(child, min(len(child), 4 * k))
        new = [(rng.randrange(12),) for _ in range(4)]
        left = rng.sample(parent, min(len(parent), k))
        changes = {"child": frames(spark, more, [])["child"].withColumn(I.SIGN, F.lit(1))
                   .unionByName(frames(spark, gone, [])["child"].withColumn(I.SIGN, F.lit(-1))),
                   "parent": frames(spark, [], new)["parent"].withColumn(I.SIGN, F.lit(1))
                   .unionByName(frames(spark, [], left)["parent"].withColumn(I.SIGN, F.lit(-1)))}
        for row in gone:
            child.remove(row)
        for row in left:
            parent.remove(row)
        child, parent = child + more, parent + new
        for _ in range(2):          # given twice, counted once
            assert shown(I.update_tests(spark, changes, TESTS, str(k), runs, parts=8)) == full(spark, child, parent)


def test_a_duplicate_and_an_orphan_touch_their_parts_only(spark, fresh_db):
    runs = f"{fresh_db['meta']}.test_runs"
    base = frames(spark, [(i, i % 50, 1) for i in range(200)], [(i,) for i in range(50)])
    assert all(r["failures"] == 0 for r in I.update_tests(spark, base, TESTS, "a", runs, parts=32))
    got = shown(I.update_tests(spark, {"child": frames(spark, [(7, 77, 1)], [])["child"]}, TESTS, "b", runs, parts=32))
    assert got["unique_child_id"] == (1, "fail") and got["relationships_child_fk__parent_pk"] == (1, "fail")
    last = spark.table(runs).filter("change_key = 'b'").select(F.size("written").alias("n"), "test_name").collect()
    assert {r["n"] for r in last if r["test_name"].startswith(("unique_child", "rel"))} == {1}


def test_a_run_that_dies_changes_nothing(spark, fresh_db, monkeypatch):
    runs = f"{fresh_db['meta']}.test_runs"
    base = frames(spark, [(1, 1, 1), (1, 2, 1)], [(1,)])
    first = I.update_tests(spark, base, TESTS, "a", runs, parts=4)
    more = {"child": frames(spark, [(2, 9, 1), (2, 9, 1)], [])["child"]}
    with monkeypatch.context() as m:
        m.setattr(I.F, "count_if", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))     # after the write, before the log
        with pytest.raises(RuntimeError):
            I.update_tests(spark, more, TESTS, "b", runs, parts=4)
    assert I.update_tests(spark, {}, TESTS, "-", runs, parts=4) == first
    assert shown(I.update_tests(spark, more, TESTS, "b", runs, parts=4)) == full(
        spark, [(1, 1, 1), (1, 2, 1), (2, 9, 1), (2, 9, 1)], [(1,)])


def test_changes_of_incremental_silver_feed_the_tests(spark, fresh_db):
    sdef = S.SourceDef("s", f"{fresh_db['bronze']}.fx", f"{fresh_db['silver']}.fx", S.FX.key, S.fx_transform, S.fx_spec, tuple(fv.FX_COLUMNS))
    runs, log, tests = f"{fresh_db['meta']}.runs", f"{fresh_db['meta']}.log", [unique("fx", "currency_code"), not_null("fx", "mean_rate")]
    batches = [[("2026-07-01", "EURO", "1", "1", "1"), ("2026-07-02", "US DOLLAR", "1", "1", "1")], [("2026-07-03", "EURO", "2", "2", "2")],
               [("2026-07-03", "EURO", "3", "3", "3")]]         # the last makes a conflict: its key leaves silver
    for k, rows in enumerate(batches):
        land(spark, spark.createDataFrame(rows, ", ".join(f"{c} string" for c in fv.FX_COLUMNS)), "s", sdef.bronze_table,
             dt.datetime(2026, 7, 1 + k), log_table=log, buckets=2)
        incremental.update_silver(spark, sdef, dt.date(2026, 7, 15), runs_table=runs, parts=4)
        key, changed = incremental.last_changes(spark, sdef, runs)
        got = shown(I.update_tests(spark, {"fx": changed}, tests, key, f"{fresh_db['meta']}.test_runs", parts=4))
        want = {r["test_name"]: (r["failures"], r["status"]) for r in run_data_tests({"fx": incremental.silver_now(spark, sdef, runs)}, tests).collect()}
        assert got == want
    assert got["unique_fx_currency_code"] == (0, "pass")
