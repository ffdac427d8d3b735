import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.operators.landing import land, landing_counts, log_failure


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b string")


def test_lands_rows_with_metadata(spark, fresh_db):
    t = f"{fresh_db['bronze']}.t"
    log = f"{fresh_db['meta']}.ingestion_log"
    r = land(spark, frame(spark, [("1", "x"), ("2", "y")]), "test_src", t, log_table=log)
    assert (r.rows_received, r.rows_inserted, r.rows_skipped) == (2, 2, 0)
    rows = spark.table(t).orderBy("a").collect()
    assert (rows[0]["a"], rows[0]["b"], rows[0]["_source"]) == ("1", "x", "test_src")
    assert len(rows[0]["_source_row_hash"]) == 64


def test_landing_again_inserts_only_unseen_rows(spark, fresh_db):
    t = f"{fresh_db['bronze']}.t"
    log = f"{fresh_db['meta']}.ingestion_log"
    first = land(spark, frame(spark, [("1", "x"), ("1", "x"), ("2", "y")]), "s", t, log_table=log)
    assert (first.rows_received, first.rows_inserted, first.rows_skipped) == (3, 2, 1)
    again = land(spark, frame(spark, [("1", "x"), ("2", "y")]), "s", t, log_table=log)
    assert (again.rows_inserted, again.rows_skipped) == (0, 2)
    more = land(spark, frame(spark, [("1", "x"), ("3", "z")]), "s", t, log_table=log)
    assert more.rows_inserted == 1
    assert spark.table(t).count() == 3
    assert spark.table(log).filter("status = 'ok'").count() == 3


def test_changed_columns_fail_loudly(spark, fresh_db):
    t = f"{fresh_db['bronze']}.t"
    log = f"{fresh_db['meta']}.ingestion_log"
    land(spark, frame(spark, [("1", "x")]), "s", t, log_table=log)
    with pytest.raises(ValueError):
        land(spark, spark.createDataFrame([("1", "x")], "b string, a string"), "s", t, log_table=log)


def test_failure_is_logged_with_its_whole_message(spark, fresh_db):
    log = f"{fresh_db['meta']}.ingestion_log"
    log_failure(spark, "src_bad", "bronze.t", "boom" * 1000, log_table=log)
    r = spark.table(log).first()
    assert r["status"] == "error" and len(r["detail"]) > 2000 and r["rows_inserted"] == 0


def test_landing_counts_without_writing(spark):
    target = frame(spark, [("1", "x")])
    from quarry.operators.landing import new_rows
    landed = new_rows(target, "s", dt.datetime(2026, 1, 1))
    r = landing_counts(frame(spark, [("1", "x"), ("2", "y"), ("2", "y")]), "s", dt.datetime(2026, 1, 2), landed).first()
    assert (r["rows_received"], r["rows_inserted"], r["rows_skipped"]) == (3, 1, 2)


def test_bucketed_target_is_not_shuffled_by_the_anti_join(spark, fresh_db):
    t = f"{fresh_db['bronze']}.t"
    log = f"{fresh_db['meta']}.ingestion_log"
    land(spark, frame(spark, [(str(i), "x") for i in range(50)]), "s", t, log_table=log)
    from quarry.operators.landing import HASH, new_rows
    plan = new_rows(frame(spark, [("1", "x")]), "s", dt.datetime(2026, 1, 2), spark.table(t)) \
        ._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("Bucketed: true" in line for line in scans)


def test_compaction_keeps_rows_buckets_and_idempotence(spark, fresh_db):
    from quarry.operators.landing import compact_bronze
    t = f"{fresh_db['bronze']}.t"
    log = f"{fresh_db['meta']}.ingestion_log"
    for i in range(3):
        land(spark, frame(spark, [(str(j), str(i)) for j in range(20)]), "s", t, log_table=log)
    before = sorted(tuple(r) for r in spark.table(t).select("a", "b", "_source_row_hash").collect())
    compact_bronze(spark, t)
    after = sorted(tuple(r) for r in spark.table(t).select("a", "b", "_source_row_hash").collect())
    assert before == after and len(after) == 60
    again = land(spark, frame(spark, [("0", "0"), ("new", "x")]), "s", t, log_table=log)
    assert again.rows_inserted == 1 and spark.table(t).count() == 61
    import datetime as dt
    from quarry.operators.landing import new_rows
    plan = new_rows(frame(spark, [("1", "x")]), "s", dt.datetime(2026, 1, 2), spark.table(t)) \
        ._jdf.queryExecution().executedPlan().toString()
    assert all("Bucketed: true" in line for line in plan.splitlines() if "FileScan" in line)


def test_a_table_that_outgrew_its_buckets_gets_more(spark, fresh_db):
    from quarry.operators.landing import compact_bronze, table_buckets
    t, log = f"{fresh_db['bronze']}.grown", f"{fresh_db['meta']}.ingestion_log"
    land(spark, frame(spark, [(str(j), "x") for j in range(100)]), "s", t, log_table=log, buckets=4)
    files = lambda: len(spark.table(t).inputFiles())
    assert table_buckets(spark, t) == 4 and files() <= 4
    land(spark, frame(spark, [(str(j), "y") for j in range(100)]), "s", t, log_table=log)
    assert files() <= 8                                     # one file a bucket and landing
    compact_bronze(spark, t, buckets=16)
    assert table_buckets(spark, t) == 16 and spark.table(t).count() == 200 and files() <= 16
    assert land(spark, frame(spark, [("1", "x"), ("n", "n")]), "s", t, log_table=log).rows_inserted == 1


def test_compaction_refuses_a_table_that_is_not_bucketed(spark, fresh_db):
    from quarry.operators.landing import compact_bronze
    t = f"{fresh_db['bronze']}.plain"
    frame(spark, [("1", "x")]).write.saveAsTable(t)
    with pytest.raises(ValueError):
        compact_bronze(spark, t)


def test_one_exchange_serves_grouping_join_and_write(spark, fresh_db, monkeypatch):
    """Full rows are shuffled once, into as many partitions as the table has buckets."""
    t, log = f"{fresh_db['bronze']}.once", f"{fresh_db['meta']}.ingestion_log"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    land(spark, frame(spark, [(str(i), "x") for i in range(50)]), "s", t, log_table=log, buckets=12)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    from quarry.operators import landing
    plans = []

    class Watched:
        def __init__(self, spark, n):
            self.inner = landing_shuffled(spark, n)

        def __enter__(self):
            self.inner.__enter__()
            payload = landing.landing_payload(frame(spark, [("1", "x")]), "s", dt.datetime(2026, 1, 2))
            groups = payload.groupBy(landing.HASH).agg(*[F.first(c).alias(c) for c in payload.columns if c != landing.HASH])
            seen = spark.table(t).select(landing.HASH, F.lit(True).alias("_seen"))
            plans.append(groups.join(seen, landing.HASH, "left")._jdf.queryExecution().executedPlan().toString())

        def __exit__(self, *a):
            return self.inner.__exit__(*a)

    landing_shuffled = landing.shuffled_into
    monkeypatch.setattr(landing, "shuffled_into", Watched)
    assert land(spark, frame(spark, [("1", "x"), ("new", "y")]), "s", t, log_table=log).rows_inserted == 1
    assert plans[0].count("Exchange hashpartitioning") == 1 and ", 12)" in plans[0].split("Exchange hashpartitioning")[1]


def test_a_batch_with_a_key_lands_and_logs_once(spark, fresh_db):
    t, log = f"{fresh_db['bronze']}.keyed", f"{fresh_db['meta']}.ingestion_log"
    rows = frame(spark, [("1", "x"), ("1", "x"), ("2", "y")])
    first = land(spark, rows, "s", t, log_table=log, batch_key="k")
    again = land(spark, rows, "s", t, log_table=log, batch_key="k")
    assert first == again and (first.rows_received, first.rows_inserted) == (3, 2)
    assert spark.table(log).count() == 1
    assert land(spark, rows, "s", t, log_table=log, batch_key="other").rows_inserted == 0 and spark.table(log).count() == 2
