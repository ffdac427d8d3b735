"""Landing with an index of row hashes against plain landing."""

import datetime as dt
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import hash_index as X
from quarry.operators import landing as L


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b string")


def rows(rng, n, wide=400):
    return [(str(rng.randrange(wide)), rng.choice(["x", None])) for _ in range(n)]


def test_counts_and_rows_equal_plain_landing(spark, fresh_db):
    rng, log = random.Random(2), f"{fresh_db['meta']}.log"
    plain, indexed = f"{fresh_db['bronze']}.plain", f"{fresh_db['bronze']}.indexed"
    for k, n in enumerate((60, 1, 150, 0)):
        batch, at = frame(spark, rows(rng, n)), dt.datetime(2026, 1, 1 + k)
        a = L.land(spark, batch, "s", plain, at, log_table=log, buckets=4)
        b = L.land(spark, batch, "s", indexed, at, log_table=log, buckets=4, indexed=True)
        assert (a.rows_received, a.rows_inserted, a.rows_skipped) == (b.rows_received, b.rows_inserted, b.rows_skipped)
    assert sorted(map(str, spark.table(plain).collect())) == sorted(map(str, spark.table(indexed).collect()))
    again = L.land(spark, spark.table(indexed).select("a", "b"), "s", indexed, log_table=log, indexed=True)
    assert again.rows_inserted == 0 and again.rows_received == spark.table(indexed).count()


def test_files_read_follow_the_batch_not_the_table(spark, fresh_db, monkeypatch):
    t, log = f"{fresh_db['bronze']}.t", f"{fresh_db['meta']}.log"
    for k in range(4):
        L.land(spark, frame(spark, [(f"{k}/{i}", "x") for i in range(200)]), "s", t, log_table=log, buckets=8, indexed=True)
    opened = []
    monkeypatch.setattr(X, "_hashes_of", lambda s, files, f=X._hashes_of: opened.append(list(files)) or f(s, files))
    r = L.land(spark, frame(spark, [("1/5", "x"), ("new", "x")]), "s", t, log_table=log, indexed=True)
    assert (r.rows_inserted, r.rows_skipped) == (1, 1)
    assert len(spark.table(t).inputFiles()) > 30
    unindexed, confirmed = opened[0], opened[1]         # files of the landing before, then those that may match
    assert len(unindexed) <= 8 and 1 <= len(confirmed) <= 2
    opened.clear()
    r = L.land(spark, frame(spark, [("another", "x")]), "s", t, log_table=log, indexed=True)
    assert r.rows_inserted == 1 and sum(map(len, opened)) <= 2


@pytest.mark.parametrize("event", ["plain landing", "compaction", "more buckets", "lost index entries"])
def test_files_that_the_index_does_not_know_are_read(spark, fresh_db, monkeypatch, event):
    t, log = f"{fresh_db['bronze']}.t", f"{fresh_db['meta']}.log"
    L.land(spark, frame(spark, [(str(i), "x") for i in range(50)]), "s", t, log_table=log, buckets=4, indexed=True)
    if event == "plain landing":
        L.land(spark, frame(spark, [(str(i), "x") for i in range(50, 80)]), "s", t, log_table=log)
    elif event == "lost index entries":     # the job died before it wrote them
        with monkeypatch.context() as m:
            m.setattr(X, "refresh", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError):
                L.land(spark, frame(spark, [("0", "x")]), "s", t, log_table=log, indexed=True)
        L.land(spark, frame(spark, [(str(i), "x") for i in range(50, 80)]), "s", t, log_table=log)
    else:
        L.land(spark, frame(spark, [(str(i), "x") for i in range(50, 80)]), "s", t, log_table=log, indexed=True)
        L.compact_bronze(spark, t, buckets=4 if event == "compaction" else 8)
    r = L.land(spark, frame(spark, [(str(i), "x") for i in range(100)]), "s", t, log_table=log, indexed=True)
    assert (r.rows_inserted, r.rows_skipped) == (20, 80)
    X.rebuild(spark, t, L.table_buckets(spark, t))
    assert {r[0] for r in X.read_index(spark, t).select("file").collect()} == {f.rsplit("/", 1)[1] for f in spark.table(t).inputFiles()}
    assert spark.table(t).select(F.count_distinct(L.HASH)).first()[0] == spark.table(t).count() == 100


def test_filters_never_deny_what_they_hold():
    rng = np.random.default_rng(1)
    texts = ["%064x" % int(x) for x in rng.integers(0, 2 ** 62, 5000)] + ["", "no hash", "0" * 32]
    import hashlib
    real = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    for own in (real, texts):
        pairs = X.words(pa.array(own))
        assert X.may_hold(X.build(pairs), pairs).all()
    others = X.words(pa.array([hashlib.sha256(f"x{i}".encode()).hexdigest() for i in range(20_000)]))
    assert X.may_hold(X.build(X.words(pa.array(real))), others).mean() < 0.002
