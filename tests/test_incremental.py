"""Incremental silver against a full build."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quarry.functions import fixed_values as fv
from quarry.operators.landing import land
from quarry.plans import incremental as I
from quarry.plans import silver as S

AS_OF = dt.date(2026, 7, 15)
LABELS = ["US DOLLAR", "EURO", " euro ", "no such label", "JPY (100)"]


def source(fresh_db):
    return S.SourceDef("cbk_fx_csv", f"{fresh_db['bronze']}.fx", f"{fresh_db['silver']}.fx", S.FX.key, S.fx_transform, S.fx_spec,
                       tuple(fv.FX_COLUMNS))


def batch(rng, n):
    """Few keys, so that copies, conflicts and faults meet across landings; some dates lie behind the first as_of."""
    out = []
    for _ in range(n):
        day = dt.date(2026, 7, 1) + dt.timedelta(days=rng.choice([0, 0, 0, 1, 2, 20, 21]))
        text = rng.choice([day.isoformat(), f"{day.day}/{day.month}/{day.year}", "x/y"])
        mean = rng.choice(["100", "100.0", " 100", "101", "-1", "n/a"])
        out.append((text, rng.choice(LABELS), mean, "99", "102"))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in fv.FX_COLUMNS))


def put(spark, sdef, log, rows, at):
    land(spark, frame(spark, rows), sdef.source, sdef.bronze_table, dt.datetime(2026, 7, 15, at), log_table=log, buckets=4)


def shown(silver, quarantine):
    return (sorted(map(str, silver.collect())), sorted(map(str, quarantine.drop("quarantined_at").collect())))


def full(spark, sdef, as_of):
    c = S.classify(spark.table(sdef.bronze_table), sdef, as_of)
    return shown(S.silver_rows(c), S.quarantine_rows(c, sdef.source, sdef.silver_table, dt.datetime(2026, 1, 1))), S.accounting(c).first().asDict()


def incremental(spark, sdef, runs):
    return shown(I.silver_now(spark, sdef, runs), I.quarantine_now(spark, sdef, runs)), I.accounting_now(spark, sdef, runs)


@pytest.mark.parametrize("sizes", [(40, 1, 25), (1, 60), (12, 12, 12, 12)])
def test_any_split_of_the_landings_equals_a_full_build(spark, fresh_db, sizes):
    rng, sdef, runs, log = random.Random(sum(sizes)), source(fresh_db), f"{fresh_db['meta']}.runs", f"{fresh_db['meta']}.log"
    for k, n in enumerate(sizes):
        put(spark, sdef, log, batch(rng, n), k)
        stats = I.update_silver(spark, sdef, AS_OF, runs_table=runs, parts=8, failed_parts=3)
        rows, counts = full(spark, sdef, AS_OF)
        assert incremental(spark, sdef, runs) == (rows, counts)
        assert {c: stats[c] for c in counts} == counts and stats["touched"] > 0
    assert I.update_silver(spark, sdef, AS_OF, runs_table=runs, parts=8, failed_parts=3)["touched"] == 0
    later = AS_OF + dt.timedelta(days=10)               # dates that lay in the future are valid now
    before = I.accounting_now(spark, sdef, runs)
    put(spark, sdef, log, batch(rng, 5), 20)
    I.update_silver(spark, sdef, later, runs_table=runs, parts=8, failed_parts=3)
    assert incremental(spark, sdef, runs) == full(spark, sdef, later)
    assert I.accounting_now(spark, sdef, runs) != before
    I.update_silver(spark, sdef, AS_OF, runs_table=runs, parts=8, failed_parts=3)       # an earlier date: built anew
    assert incremental(spark, sdef, runs) == full(spark, sdef, AS_OF)
    assert I.committed(spark, sdef.silver_table, runs)[0]["reset"]


def test_only_touched_parts_and_new_landings_are_read(spark, fresh_db, monkeypatch):
    sdef, runs, log = source(fresh_db), f"{fresh_db['meta']}.runs", f"{fresh_db['meta']}.log"
    days = [(f"2026-{m:02d}-{d:02d}", "EURO", "100", "99", "101") for m in (1, 2, 3) for d in range(1, 28)]
    put(spark, sdef, log, days, 1)
    I.update_silver(spark, sdef, AS_OF, runs_table=runs, parts=16)
    put(spark, sdef, log, [("2026-01-01", "EURO", "200", "199", "201")], 2)
    asked, files = [], []
    monkeypatch.setattr(I, "read_parts", lambda s, t, where, f=I.read_parts: asked.append(dict(where)) or f(s, t, where))
    monkeypatch.setattr(I, "rows_of_landings", lambda b, l, f=I.rows_of_landings: files.append(f(b, l)) or files[-1])
    stats = I.update_silver(spark, sdef, AS_OF, runs_table=runs, parts=16)
    assert stats["touched"] == 1 and [len(a) for a in asked] == [0, 1]          # one part of sixteen
    assert stats["rows_quarantined"] == 2                                       # the key moved from clean to conflict
    assert files[0].count() == 1
    plan = files[0]._jdf.queryExecution().executedPlan().toString()
    assert "file_modification_time" in plan


def test_a_landing_that_began_early_and_ended_late_is_taken_in(spark, fresh_db):
    sdef, runs, log = source(fresh_db), f"{fresh_db['meta']}.runs", f"{fresh_db['meta']}.log"
    put(spark, sdef, log, [("2026-07-02", "EURO", "100", "99", "101")], 9)
    I.update_silver(spark, sdef, AS_OF, runs_table=runs)
    put(spark, sdef, log, [("2026-07-03", "EURO", "100", "99", "101")], 3)      # an earlier time than the last one taken
    assert I.update_silver(spark, sdef, AS_OF, runs_table=runs)["rows_in"] == 2


@pytest.mark.parametrize("broken", ["scratch_table", "resolved", "_commit"])
def test_a_build_that_dies_leaves_the_old_pair(spark, fresh_db, monkeypatch, broken):
    rng, sdef, runs, log = random.Random(4), source(fresh_db), f"{fresh_db['meta']}.runs", f"{fresh_db['meta']}.log"
    put(spark, sdef, log, batch(rng, 30), 1)
    I.update_silver(spark, sdef, AS_OF, runs_table=runs, parts=4)
    old = incremental(spark, sdef, runs)
    put(spark, sdef, log, batch(rng, 30), 2)

    def die(*a, **k):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(I, broken, die)
        with pytest.raises(RuntimeError):
            I.update_silver(spark, sdef, AS_OF, runs_table=runs, parts=4)
    assert incremental(spark, sdef, runs) == old
    I.update_silver(spark, sdef, AS_OF, runs_table=runs, parts=4)
    assert incremental(spark, sdef, runs) == full(spark, sdef, AS_OF)
    gone = I.drop_superseded(spark, sdef.silver_table, runs, keep_hours=0)
    assert len(gone) >= (broken == "_commit")
    assert incremental(spark, sdef, runs) == full(spark, sdef, AS_OF)


def test_empty_bronze_and_rows_without_a_landing(spark, fresh_db):
    sdef, runs = source(fresh_db), f"{fresh_db['meta']}.runs"
    empty = frame(spark, []).select("*", F.lit("s").alias("_source"), F.lit(None).cast("timestamp_ntz").alias("_ingested_at"),
                                    F.lit("h").alias("_source_row_hash"))
    stats = I.update_silver(spark, sdef, AS_OF, bronze=empty, runs_table=runs)
    assert stats["rows_in"] == 0 and I.classified_now(spark, sdef, runs, empty).count() == 0
    with pytest.raises(ValueError):
        I.update_silver(spark, sdef, AS_OF, runs_table=runs,
                        bronze=frame(spark, batch(random.Random(1), 2)).select("*", *[F.col(c) for c in ()], F.lit("s").alias("_source"),
                                                                                F.lit(None).cast("timestamp_ntz").alias("_ingested_at"),
                                                                                F.lit("h").alias("_source_row_hash")))


def test_a_hot_key_is_split_among_files(spark, fresh_db):
    """A third of all rows are versions of one key: they share a part, but not a task's memory."""
    sdef, runs, log = source(fresh_db), f"{fresh_db['meta']}.runs", f"{fresh_db['meta']}.log"
    rows = [("2026-07-01", "EURO", f"{100 + i}", "99", "200") for i in range(300)]
    rows += [(f"{2001 + i % 25}-{1 + i % 12:02d}-{1 + i % 28:02d}", "EURO", "100", "99", "101") for i in range(600)]
    put(spark, sdef, log, rows[::2], 1)
    I.update_silver(spark, sdef, AS_OF, runs_table=runs)
    put(spark, sdef, log, rows[1::2], 2)
    I.update_silver(spark, sdef, AS_OF, runs_table=runs)
    assert incremental(spark, sdef, runs) == full(spark, sdef, AS_OF)
