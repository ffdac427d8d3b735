import json
import os
import tempfile

import pytest

from quarry.functions import fixed_values as fv
from quarry.sources import (assert_complete_pages, extract_html_table, flatten_paged_json, melt_wide,
                            parse_ragged_lines, read_paged_json, read_ragged_csv, read_seed)
from quarry.sources.tabular import SchemaMismatch


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_ragged_csv_file(spark):
    """Short, long, blank, repeated, quoted and multi-line records of one file."""
    path = os.path.join(tempfile.mkdtemp(), "rates.csv")
    with open(path, "w", newline="") as f:
        f.write('k1,"Unit, A",1.5,1.4,1.6\r\n \r\nk2,short\nk3,u,1,2,3,extra,"more, still"\n , ,,\n'
                'k1,"Unit, A",1.5,1.4,1.6\r\nk4,"line one\nline two",4,5,6\nk5,6" pipe,"a""b"c,x,y\n')
    rows = [tuple(r) for r in read_ragged_csv(spark, path, fv.FX_COLUMNS).collect()]
    assert rows == [("k1", "Unit, A", "1.5", "1.4", "1.6"), ("k2", "short", None, None, None),
                    ("k3", "u", "1", "2", "3,extra,more, still"), ("k1", "Unit, A", "1.5", "1.4", "1.6"),
                    ("k4", "line one\nline two", "4", "5", "6"), ("k5", '6" pipe', 'a"bc', "x", "y")]


def test_ragged_lines_empty_overflow_null_and_very_long(spark):
    texts = ["p,q,r,s,,,t", None, "", ",".join(['"f"'] * 30_000), "v,w,\"never closed, to the end"]
    rows = [tuple(r) for r in parse_ragged_lines(lines(spark, texts), fv.FX_COLUMNS).collect()]
    assert rows == [("p", "q", "r", "s", ",,t"), ("f",) * 4 + (",".join(["f"] * 29_996),),
                    ("v", "w", "never closed, to the end", None, None)]


def test_paged_json_skips_null_pages_and_reads_nested(spark):
    rec = {"indicator": {"id": "PA.NUS.FCRF", "value": "rate"}, "country": {"id": "KE", "value": "Kenya"},
           "countryiso3code": "KEN", "date": "2023", "value": 139.846383759617, "unit": "", "obs_status": ""}
    docs = [json.dumps([{"page": 1, "pages": 2}, [rec, {"date": "2024"}]]), json.dumps([{"page": 2, "pages": 2}, None]),
            json.dumps({"message": "x"})]
    fields = dict(zip(fv.INDICATOR_COLUMNS, ["indicator.id", "indicator.value", "countryiso3code", "country.value",
                                             "date", "value", "unit", "obs_status"]))
    out = flatten_paged_json(lines(spark, docs), fields).collect()
    assert len(out) == 2
    assert out[0]["value"] == "139.846383759617" and out[0]["country_name"] == "Kenya"
    assert out[1]["indicator_id"] is None and out[1]["year"] == "2024"
    d = tempfile.mkdtemp()
    for i, doc in enumerate(docs[:2]):
        with open(os.path.join(d, f"p{i}.json"), "w") as f:
            f.write(doc)
    assert read_paged_json(spark, d, fields).count() == 2
    with pytest.raises(ValueError):
        assert_complete_pages(lines(spark, docs))
    assert assert_complete_pages(lines(spark, docs[:2]))["pages_seen"] == 2


def _page(headers, rows, table_id="table_1"):
    th = "".join(f"<th>{h}</th>" for h in headers)
    body = "".join("<tr>" + "".join(f"<td> {c} </td>" for c in r) + "</tr>" for r in rows)
    return (f"<html><table id='other'><tr><td>x</td></tr></table><table id='{table_id}'><thead><tr><th></th></tr>"
            f"<tr>{th}</tr></thead><tbody>{body}</tbody></table></html>")


def test_html_table_rows_and_loud_failures(spark):
    good = _page(fv.MOBILE_HEADERS, [["2026", "May", "564,330", "94.09", "214.33", "681.45"],
                                     ["2026", "April", "560,000", "93.1", "210.0", "670.2"]])
    pages = spark.createDataFrame([(1, good)], "id long, html string")
    rows = extract_html_table(pages, "html", fv.MOBILE_TABLE_ID, fv.MOBILE_HEADERS, fv.MOBILE_COLUMNS, "id").collect()
    assert [r["month_raw"] for r in rows] == ["May", "April"] and rows[0]["active_agents_raw"] == "564,330"
    bad = [("no table", "<html></html>"), ("headers changed", _page(["Year", "Mth"], [["1", "2"]])),
           ("cells", _page(fv.MOBILE_HEADERS, [["2026", "May"]])), ("no rows", _page(fv.MOBILE_HEADERS, []))]
    for _, html in bad:
        df = spark.createDataFrame([(2, html)], "id long, html string")
        with pytest.raises(Exception):
            extract_html_table(df, "html", fv.MOBILE_TABLE_ID, fv.MOBILE_HEADERS, fv.MOBILE_COLUMNS, "id").collect()
    q = extract_html_table(spark.createDataFrame(bad, "id string, html string"), "html", fv.MOBILE_TABLE_ID,
                           fv.MOBILE_HEADERS, fv.MOBILE_COLUMNS, "id", on_error="quarantine").collect()
    assert len(q) == 4 and all(r["error"] for r in q)


def test_melt_wide_drops_blanks_and_requires_ids(spark):
    ids = fv.METRIC_ID_COLUMNS
    wide = spark.createDataFrame(
        [("Active", "Region", "Sub-Saharan Africa ", "A", "U", "M", "12", "  ", None),
         ("Active", "Subregion", "East", "A", "U", "M", "-3", "x", "5")],
        ", ".join(f"`{c}` string" for c in ids + ["01/03/2001", "01/06/2001", "01/12/2004"]))
    long = melt_wide(wide, ids, "period_raw", "value_raw", fv.METRIC_COLUMNS).collect()
    assert len(long) == 4
    assert {r["period_raw"] for r in long} == {"01/03/2001", "01/06/2001", "01/12/2004"}
    assert long[0]["geo_name_raw"] == "Sub-Saharan Africa "
    with pytest.raises(SchemaMismatch, match="Metric"):
        melt_wide(wide.drop("Metric"), ids, "period_raw", "value_raw")


def test_seed_reads_empty_as_null(spark):
    from quarry.plans.gold import DATA_DIR
    cur = read_seed(spark, os.path.join(DATA_DIR, "currency_ref.csv"),
                    "currency_code string, currency_name string, country_iso3 string").collect()
    assert len(cur) == 22
    assert {r["currency_code"]: r["country_iso3"] for r in cur}["USD"] is None


def test_pages_are_counted_for_each_request(spark):
    """Page 2 of one request does not stand for a missing page 2 of the other."""
    from pyspark.sql import functions as F
    def doc(code, page, pages):
        return json.dumps([{"page": page, "pages": pages}, [{"indicator": {"id": code}}]])
    request = F.get_json_object("value", "$[1][0].indicator.id")
    docs = [doc("a", 1, 2), doc("b", 1, 2), doc("b", 2, 2)]
    assert assert_complete_pages(lines(spark, docs))["pages_seen"] == 2
    with pytest.raises(ValueError, match="a 1 of 2"):
        assert_complete_pages(lines(spark, docs), request=request)
    assert assert_complete_pages(lines(spark, [*docs, doc("a", 2, 2)]), request=request)["pages_seen"] == 4
    assert assert_complete_pages(lines(spark, []), request=request)["documents"] == 0
