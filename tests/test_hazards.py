"""The measured hazards of the survey, pinned."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions import fixed_values as fv
from quarry.functions.scalar import invert_quote
from quarry.operators.checks import Check, ColumnSpec, RowCheck, TableSpec, validate
from quarry.operators.dedup import resolve_duplicates
from quarry.sources import parse_ragged_lines


def test_empty_field_stays_empty_and_missing_field_is_null(spark):
    r = parse_ragged_lines(spark.createDataFrame([("a,,c",)], "value string"), fv.FX_COLUMNS).first()
    assert (r["currency_raw"], r["buy_raw"], r["sell_raw"]) == ("", None, None)


def test_survivor_is_earliest_then_smallest_hash(spark):
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    df = spark.createDataFrame([(1, 5.0, t2, "a"), (1, 5.0, t1, "z"), (1, 5.0, t1, "m")],
                               "k int, v double, _ingested_at timestamp_ntz, _source_row_hash string")
    r = resolve_duplicates(df, ["k"]).first()
    assert (r["_source_row_hash"], r["_copies"], r["_status"]) == ("m", 3, "clean")


def test_negative_zero_and_zero_are_one_version(spark):
    df = spark.createDataFrame([(1, 0.0, "a"), (1, -0.0, "b")], "k int, v double, _source_row_hash string")
    out = resolve_duplicates(df, ["k"], order=("_source_row_hash",)).collect()
    assert len(out) == 1 and out[0]["_copies"] == 2


def test_inversion_by_zero_gives_null_not_an_error(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, fv.UNITS_PER_HOME, 1)],
                               "m double, b double, s double, basis string, units long")
    m, b, s = invert_quote("m", "b", "s", "basis", "units", fv.HOME_PER_UNIT, fv.UNITS_PER_HOME)
    assert tuple(df.select(m, b, s).first()) == (None, None, None)


def test_reasons_are_code_point_sorted_and_nulls_skip_value_checks(spark):
    spec = TableSpec(columns=(ColumnSpec("b", "double", checks=(Check.greater_than(0),)),
                              ColumnSpec("a", "double", nullable=True, checks=(Check.greater_than(0),)),
                              ColumnSpec("Z", "double", checks=(Check.in_range(0, 1),))),
                     row_checks=(RowCheck("a_lte_b", lambda: F.col("a") <= F.col("b"), ("a", "b")),))
    df = spark.createDataFrame([(-1.0, None, 5.0), (-1.0, 2.0, 0.5)], "b double, a double, Z double")
    r = [x["_reasons"] for x in validate(df, spec).collect()]
    assert r[0] == "Z: in_range(0, 1); b: greater_than(0)"           # null a: no value or row check
    assert r[1] == "a_lte_b; b: greater_than(0)"
