import datetime as dt
import hashlib

from quarry.functions import fixed_values as fv
from quarry.functions.scalar import (date_key, invert_quote, month_name, month_number, norm_label, parse_date,
                                     row_hash, strip, to_long, to_number)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_norm_label_collapses_case_and_whitespace(spark):
    assert one(spark, norm_label("v"), "  us \t dollar ") == "US DOLLAR"
    assert one(spark, norm_label("v"), None) == ""


def test_strip_removes_tabs_and_no_break_spaces(spark):
    assert one(spark, strip("v"), "\t Sub-Saharan Africa  ") == "Sub-Saharan Africa"


def test_to_number_rejects_what_a_bare_cast_accepts(spark):
    values = ["1,234.5", " 12 ", "NaN", "1d", "inf", "", None, "-8.5", ".5", "1e3", "abc"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r["n"] for r in df.select(to_number("v").alias("n")).collect()]
    assert got == [1234.5, 12.0, None, None, None, None, None, -8.5, 0.5, 1000.0, None]
    assert one(spark, to_number("v", commas=False), "1,234") is None


def test_to_long_truncates_and_uses_sentinel(spark):
    df = spark.createDataFrame([("564,330",), ("12.9",), ("x",)], "v string")
    assert [r[0] for r in df.select(to_long("v", -1)).collect()] == [564330, 12, -1]


def test_parse_date_iso_then_day_first(spark):
    df = spark.createDataFrame([(v,) for v in ["2024-01-03", "11/10/2016", "2016-1-5", "Date", "31/02/2016", None]],
                               "v string")
    got = [r[0] for r in df.select(parse_date("v")).collect()]
    assert got == [dt.date(2024, 1, 3), dt.date(2016, 10, 11), dt.date(2016, 1, 5), None, None, None]


def test_month_number(spark):
    df = spark.createDataFrame([("May",), (" december ",), ("Maytember",), (None,)], "v string")
    assert [r[0] for r in df.select(month_number("v", fv.MONTH_NAMES)).collect()] == [5, 12, None, None]


def test_row_hash_is_boundary_safe_and_null_is_empty(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None), ("a", "")], "a string, b string")
    h = [r[0] for r in df.select(row_hash(["a", "b"])).collect()]
    assert h[0] != h[1]
    assert h[2] == h[3]
    assert h[0] == hashlib.sha256("ab\x1fc".encode()).hexdigest()
    assert all(len(x) == 64 for x in h)


def test_date_key_and_month_name(spark):
    df = spark.createDataFrame([(dt.date(2016, 10, 11),)], "d date")
    r = df.select(date_key("d").alias("k"), month_name("d").alias("m")).first()
    assert (r["k"], r["m"]) == (20161011, "October")


def test_inverse_quote_swaps_bid_and_ask(spark):
    df = spark.createDataFrame([(33.6379, 33.5567, 33.7191, fv.UNITS_PER_HOME, 1),
                                (97.7463, 97.0, 98.0, fv.HOME_PER_UNIT, 100),
                                (1.0, 1.0, 1.0, "OTHER", 1)],
                               "m double, b double, s double, basis string, units long")
    m, b, s = invert_quote("m", "b", "s", "basis", "units", fv.HOME_PER_UNIT, fv.UNITS_PER_HOME)
    rows = df.select(m.alias("m"), b.alias("b"), s.alias("s")).collect()
    assert round(rows[0]["m"], 10) == 0.0297283719
    assert round(rows[0]["b"], 10) == 0.0296567821
    assert round(rows[0]["s"], 10) == 0.0298003081
    assert round(rows[1]["m"], 6) == 0.977463
    assert rows[2]["m"] is None
