import pytest
from pyspark.sql import functions as F

from quarry.functions import fixed_values as fv
from quarry.operators import serving as sv
from quarry.operators.dedup import collapse_only, duplicate_keys
from quarry.plans.gold import materialize
from quarry.sources.tabular import literal_table, require_nonempty


def test_relational_helpers(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("b", 1, None), (" ", 3, 1.0)], "k string, t int, v double")
    assert sv.select_as(df, {"key": "k", "val": F.col("v") * 2}).columns == ["key", "val"]
    assert sv.drop_blank_rows(df.select("k"), ["k"]).count() == 3
    m = {r["k"]: (r["mean"], r["n"]) for r in sv.mean_and_count(df, ["k"], "v", "mean", "n").collect()}
    assert m["a"] == (3.0, 2) and m["b"] == (None, 1)
    t = sv.total(df, F.col("k") == "a", "v").first()
    assert (t["n_rows"], t["conditional_sum"]) == (4, 6.0)
    assert [tuple(r) for r in sv.series_by(df, "k", "t", "v").filter("k = 'a'").collect()] == [("a", 1, 2.0), ("a", 2, 4.0)]
    assert [r["t"] for r in sv.sample_rows(df, ["t", "k"], 2).collect()] == [1, 1]
    assert sv.known_codes(fv.CURRENCY_LABELS)[:3] == ["AED", "AUD", "BIF"] and len(sv.known_codes(fv.CURRENCY_LABELS)) == 21


def test_size_checked_broadcast(spark):
    small = literal_table(spark, [("x", 1)], ["a", "b"])
    big = spark.range(10_000_000).withColumn("a", F.col("id").cast("string"))
    j1 = spark.range(10).withColumn("a", F.col("id").cast("string")).join(sv.broadcast_if_small(small), "a")
    assert "BroadcastHashJoin" in j1._jdf.queryExecution().executedPlan().toString()
    assert sv.broadcast_if_small(big, max_bytes=1024) is big


def test_collapse_only_and_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "x", "h2"), (1, "x", "h1"), (1, "y", "h3")], "k int, v string, _source_row_hash string")
    c = collapse_only(df, order=("_source_row_hash",)).orderBy("v").collect()
    assert [(r["v"], r["_source_row_hash"]) for r in c] == [("x", "h1"), ("y", "h3")]
    assert duplicate_keys(df, ["k"]).first()["n"] == 3


def test_require_nonempty_and_materialize(spark, fresh_db):
    with pytest.raises(ValueError):
        require_nonempty(spark.range(0), "melt")
    df = spark.range(3)
    materialize(spark, df, "stg.numbers", "view")
    assert spark.table("stg_numbers").count() == 3
    materialize(spark, df, f"{fresh_db['gold']}.numbers", "table")
    assert spark.table(f"{fresh_db['gold']}.numbers").count() == 3
    with pytest.raises(ValueError):
        materialize(spark, df, "x", "other")


def test_top_level_api():
    import quarry
    for name in quarry.__all__:
        assert callable(getattr(quarry, name)), name
