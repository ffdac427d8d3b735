"""One key holding a third of all rows: results stay whole and exact, and the hot group is
reduced before it is shuffled (partial aggregation), never gathered by a window."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import serving as sv
from quarry.operators.dedup import resolve_duplicates
from quarry.operators.landing import landing_counts


def skewed(spark, n=30000):
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 1000).alias("v"),
        F.col("id").alias("seq"))
    return base


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_group_with_hot_key(spark):
    df = skewed(spark)
    out = sv.latest_per(df, ["k"], ["seq"], ["v"])
    hot = out.filter("k = 0").first()
    assert hot["seq"] == 29997 and hot["v"] == 997
    assert out.count() == 20001
    p = plan(out)
    assert "partial_max" in p and "Window" not in p


def test_collapse_and_conflict_with_hot_key(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(1.5)).otherwise(F.lit(2.5)).alias("x"),
        F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz").alias("_ingested_at"),
        F.sha2(F.col("id").cast("string"), 256).alias("_source_row_hash"))
    out = resolve_duplicates(df, ["k"])
    hot = out.filter("k = 0").collect()
    assert len(hot) == 1 and hot[0]["_copies"] == 10000 and hot[0]["_status"] == "clean"
    assert out.agg(F.sum("_copies")).first()[0] == n
    # the hot key with two versions: both conflict, copies still all accounted for
    df2 = df.withColumn("x", F.when((F.col("k") == 0) & (F.col("_source_row_hash") < "8"), F.lit(9.0)).otherwise(F.col("x")))
    hot2 = resolve_duplicates(df2, ["k"]).filter("k = 0").collect()
    assert sorted(r["_status"] for r in hot2) == ["conflict", "conflict"]
    assert sum(r["_copies"] for r in hot2) == 10000
    p = plan(out)
    assert "Window" not in p and ("partial_min" in p or "partial_count" in p)


def test_landing_dedups_a_hot_group_of_copies(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("a"))
    r = landing_counts(df, "s", dt.datetime(2026, 1, 1)).first()
    assert (r["rows_received"], r["rows_inserted"], r["rows_skipped"]) == (30000, 20001, 9999)


def test_adaptive_skew_join_is_on(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_top_n_of_a_hot_key_is_cut_before_the_exchange(spark):
    """A key with a third of all rows sends n rows a task: the group limit stands below the exchange."""
    from quarry.operators.serving import latest_n_per
    df = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 10).alias("v"), F.col("id"))
    top = latest_n_per(df, ["k"], ["v", "id"], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") >= 3 and plan.rindex("Exchange hashpartitioning(k") < first
    rows = {}
    for r in top.collect():
        rows.setdefault(r["k"], []).append((r["rank"], r["v"], r["id"]))
    want = {}
    for i in range(30_000):
        want.setdefault(None if i % 3 == 0 else 7 if i % 3 == 1 else i % 50, []).append((i % 10, i))
    assert {k: sorted(v) for k, v in rows.items()} == {
        k: [(n + 1, *x) for n, x in enumerate(sorted(v, reverse=True)[:3])] for k, v in want.items()}
