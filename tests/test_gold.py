import datetime as dt

from pyspark.sql import functions as F

from quarry.functions import fixed_values as fv
from quarry.operators.data_tests import accepted_range, not_null, relationships, run_data_tests, unique, unique_combination
from quarry.operators.reconcile import reconcile
from quarry.plans import gold as G


def test_calendar_spine_covers_all_sources(spark):
    a = spark.createDataFrame([(dt.date(2001, 3, 1),), (dt.date(2010, 1, 1),)], "d date")
    b = spark.createDataFrame([(dt.date(2026, 5, 1),)], "m date")
    dim = G.dim_date([(a, "d"), (b, "m")])
    assert dim.count() == 9193
    r = dim.filter(F.col("date_key") == 20160217).first()
    assert (r["year"], r["quarter"], r["month"], r["month_name"], r["day_of_month"]) == (2016, 1, 2, "February", 17)
    assert (r["month_start"], r["quarter_start"]) == (dt.date(2016, 2, 1), dt.date(2016, 1, 1))


def test_stg_fx_normalises_quotes(spark):
    silver = spark.createDataFrame(
        [(dt.date(2016, 10, 11), "UGX", fv.UNITS_PER_HOME, 1, 33.6379, 33.5567, 33.7191, "h1"),
         (dt.date(2016, 10, 11), "JPY", fv.HOME_PER_UNIT, 100, 97.7463, 97.6, 97.9, "h2")],
        "rate_date date, currency_code string, quote_basis string, units_per_quote long, mean_rate double, "
        "buy_rate double, sell_rate double, _source_row_hash string")
    out = {r["currency_code"]: r for r in G.fact_exchange_rate(G.stg_fx(silver)).collect()}
    assert round(out["UGX"]["kes_per_unit_buy"], 10) == 0.0296567821
    assert round(out["JPY"]["kes_per_unit_mean"], 6) == 0.977463
    assert out["JPY"]["date_key"] == 20161011


def _series(spark, year, days, level):
    start = dt.date(year, 1, 1)
    return [(start + dt.timedelta(days=i), level) for i in range(days)]


def test_reconcile_coverage_and_tolerance(spark):
    rows = _series(spark, 2017, 199, 100.0) + _series(spark, 2018, 200, 100.0) + _series(spark, 2019, 250, 100.0) \
        + _series(spark, 2020, 250, 100.0)
    daily = spark.createDataFrame(rows, "d date, rate double").withColumn("year", F.year("d"))
    annual = spark.createDataFrame([(2017, 100.0), (2018, 100.0 / 1.0099), (2019, 100.0 / 1.0101), (2020, 100.0)],
                                   "year long, value double")
    out = {r["year"]: r for r in reconcile(daily, annual, "year", "rate", "value", 200, 0.01).collect()}
    assert sorted(out) == [2018, 2019, 2020]          # 199-day year is not compared
    assert out[2018]["within_tolerance"] and not out[2019]["within_tolerance"]
    assert out[2020]["relative_difference"] == 0.0 and out[2019]["days"] == 250


def test_data_tests_report_failures(spark):
    dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    fact = spark.createDataFrame([(1, 5.0), (3, -1.0), (None, 0.5)], "k int, v double")
    res = {r["test_name"]: (r["failures"], r["status"]) for r in run_data_tests(
        {"dim": dim, "fact": fact},
        [unique("dim", "k"), not_null("dim", "k"), relationships("fact", "k", "dim", "k"),
         accepted_range("fact", "v", min_value=0, inclusive=False), unique_combination("fact", ["k", "v"]),
         accepted_range("fact", "v", min_value=0, max_value=1, label="v_unit")]).collect()}
    assert res["unique_dim_k"] == (1, "fail")
    assert res["not_null_dim_k"] == (1, "fail")
    assert res["relationships_fact_k__dim_k"] == (1, "fail")
    assert res["accepted_range_fact_v"] == (1, "fail")
    assert res["unique_combination_fact_k__v"] == (0, "pass")
    assert res["v_unit"] == (2, "fail")


def test_recon_flagship_gate_has_passes_and_failures_at_smallest_scale(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).collect()
    assert rows and all(r["trading_days"] >= 200 for r in rows)
    assert {r["within_tolerance"] for r in rows} == {True, False}
