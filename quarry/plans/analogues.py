"""The operators exercised over the supplied tables (TPC-H-like star + events + documents).

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over whole tables.
Inputs that the operators expect to be messy (ragged text lines, paged JSON, HTML pages,
noisy labels, mixed date formats, injected faults) are *derived from the tables* by
deterministic rules, so the work grows with the data. Matching DuckDB SQL lives in
:mod:`quarry.plans.analogue_sql`.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import (date_key, invert_quote, month_number, month_start,
                                     parse_date, row_hash, to_long, to_number, truncate)
from quarry.functions import fixed_values as fv
from quarry.operators import serving as sv
from quarry.operators.checks import Check, ColumnSpec, RowCheck, TableSpec, split, validate
from quarry.operators.data_tests import (accepted_range, not_null, relationships, run_data_tests, unique,
                                         unique_combination)
from quarry.operators.dedup import STATUS
from quarry.operators.landing import landing_counts, new_rows
from quarry.operators.reconcile import reconcile
from quarry.plans import gold
from quarry.plans.silver import SourceDef, accounting, classify, quarantine_rows, silver_rows
from quarry.sources.html_table import extract_html_table
from quarry.operators.evidence import infer_date_order
from quarry.sources.paged_json import flatten_paged_json, page_summary
from quarry.sources.ragged_csv import parse_ragged_lines
from quarry.sources.tabular import literal_table, melt_wide, union_all

# --- fixed values: run parameters of the analogue builds -------------------------------
INGESTED_FIRST = dt.datetime(2026, 1, 1, 0, 0, 0)
INGESTED_SECOND = dt.datetime(2026, 1, 2, 0, 0, 0)
LINEITEM_AS_OF = dt.date(2001, 6, 30)
ORDERS_AS_OF = dt.date(2001, 12, 31)
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# noisy part-type labels (normalised form) -> code; ECONOMY is deliberately unmapped
TYPE_CODES = [
    ("LARGE", "LRG"), ("LARGE GRADE", "LRG-G"),
    ("MEDIUM", "MED"), ("MEDIUM GRADE", "MED-G"),
    ("PROMO", "PRM"), ("PROMO GRADE", "PRM-G"),
    ("SMALL", "SML"), ("SMALL GRADE", "SML-G"),
    ("STANDARD", "STD"), ("STANDARD GRADE", "STD-G"),
]
HTML_HEADERS = ["Key", "Name", "Brand", "Size"]
HTML_COLUMNS = ["key_raw", "name_raw", "brand_raw", "size_raw"]
RAGGED_COLUMNS = ["key_raw", "name_raw", "brand_raw", "type_raw", "rest_raw"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(rows: DataFrame, tasks_per_core: int = 4) -> DataFrame:
    """Rows dealt out evenly, so that costly work on the rows of a small file (its row group is read by
    one task) fills all cores."""
    return rows.repartition(tasks_per_core * rows.sparkSession.sparkContext.defaultParallelism)


def dec2(c) -> Column:
    """Two-decimal text rendering of a number (same text in every engine)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("decimal(18,2)").cast("string")


def iso(c) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


def listed(c: str, values: list[str]) -> Column:
    """A column whose values must be among ``values``: any other one, or null, fails the query."""
    return F.when(F.col(c).isin(values), F.col(c)).otherwise(
        F.raise_error(F.concat(F.lit(f"{c}: unlisted value "), F.coalesce(F.col(c), F.lit("null")))))


# ---------------------------------------------------------------------------------------
# landing


def land_first_batch(spark, d):
    """Documents (text, lang, source) as a first landing: metadata, content hash, in-batch repeats collapsed."""
    docs = table(spark, d, "documents").select("text", "lang", "source")
    return new_rows(docs, "documents", INGESTED_FIRST)


def land_incremental(spark, d):
    """Orders landed in two overlapping date batches: the second batch's received / inserted / skipped."""
    orders = table(spark, d, "orders")
    first = orders.filter(F.col("o_orderdate") < F.lit(dt.datetime(1999, 1, 1)))
    second = orders.filter(F.col("o_orderdate") >= F.lit(dt.datetime(1998, 1, 1)))
    landed = new_rows(first, "orders", INGESTED_FIRST)
    return landing_counts(second, "orders", INGESTED_SECOND, target=landed)


# ---------------------------------------------------------------------------------------
# sources


def ragged_lines(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    fields = F.array(
        F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_brand"), F.col("p_type"),
        F.col("p_size").cast("string"),
        F.concat(F.lit('"'), F.col("p_brand"), F.lit(", size "), F.col("p_size").cast("string"), F.lit('"')),
        F.lower("p_type"))
    k = F.lit(3) + (F.col("p_partkey") % 5).cast("int")
    key = F.col("p_partkey").cast("string")
    odd = F.col("p_partkey") % 17
    line = (F.when(odd == 0, F.lit(" , , ,"))
            # quotes inside a field; text behind a closing quote; a quoted line break and a second
            # record; an unclosed quote; a line of very many quoted fields
            .when(odd == 1, F.concat(key, F.lit(',5" pipe,3" pipe,c')))
            .when(odd == 2, F.concat(key, F.lit(',"abc"def, "x, y",z')))
            .when(odd == 3, F.concat(key, F.lit(',"two\nlines",b\n'), key, F.lit(",next")))
            .when(odd == 4, F.concat(key, F.lit(',a,"open, never closed')))
            .when((odd == 5) & (F.col("p_partkey") < 100),
                  F.concat(key, F.lit(",n,b,t,"), F.array_join(F.array_repeat(F.lit('"f"'), 20_000), ",")))
            .otherwise(F.array_join(F.slice(fields, F.lit(1), k), ",")))
    return p.select(line.alias("value"))


def ragged_fold(spark, d):
    """Part rows rendered as headerless records of 2 to 20,004 fields with every kind of quote, parsed back."""
    return parse_ragged_lines(ragged_lines(spark, d), RAGGED_COLUMNS)


def json_flatten(spark, d):
    """Event properties read as paged records; a number keeps its source text, a missing path is null."""
    ev = table(spark, d, "events")
    return flatten_paged_json(
        ev.select("event_id", "event_type", F.concat(F.lit("[{}, ["), F.col("props"), F.lit("]]")).alias("value")),
        {"k": "k", "missing_id": "missing.id"}, keep=("event_id", "event_type"))


def paged_documents(spark, d) -> DataFrame:
    o = table(spark, d, "orders")

    def record(ind_id: str, value: Column) -> Column:
        return F.struct(
            F.struct(F.lit(ind_id).alias("id"), F.col("o_orderpriority").alias("value")).alias("indicator"),
            F.struct(F.lit("X").alias("id"), F.col("o_orderstatus").alias("value")).alias("country"),
            F.col("o_custkey").cast("string").alias("countryiso3code"),
            F.year("o_orderdate").cast("string").alias("date"),
            value.alias("value"), F.lit("").alias("unit"), F.lit(None).cast("string").alias("obs_status"))

    meta = F.to_json(F.struct(((F.col("o_orderkey") % 7) + 1).alias("page"), F.lit(7).alias("pages"),
                              F.col("o_orderkey").alias("order")))
    records = F.when(F.col("o_orderstatus") == "P", F.lit("null")).otherwise(
        F.to_json(F.array(record("ORD", F.col("o_totalprice")), record("CUST", F.lit(None).cast("double"))),
                  {"ignoreNullFields": "false"}))
    doc = F.when(F.col("o_orderkey") % 10 == 3, F.lit('{"message": "bad request"}')).otherwise(
        F.concat(F.lit("["), meta, F.lit(","), records, F.lit("]")))
    return o.select("o_orderkey", doc.alias("value"))


PAGED_FIELDS = {
    "indicator_id": "indicator.id", "indicator_name": "indicator.value", "country_iso3": "countryiso3code",
    "country_name": "country.value", "year": "date", "value": "value", "unit": "unit", "obs_status": "obs_status",
}


def json_array_explode(spark, d):
    """One paged document per order (null record lists, error envelopes), flattened to rows."""
    return flatten_paged_json(paged_documents(spark, d), PAGED_FIELDS, keep=("o_orderkey",))


def page_check(spark, d):
    """Page-envelope summary of the paged order documents, those of a priority as one request."""
    docs = paged_documents(spark, d).join(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey")
    return page_summary(docs, request=F.col("o_orderpriority"))


def date_order_evidence(spark, d):
    """Orders published twice: ISO dates, then a day-first slash rendering of every order;
    each reading of the slash dates is matched against the ISO rows."""
    o = table(spark, d, "orders")
    iso = o.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_raw"))
    slash = o.select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "dd/MM/yyyy").alias("date_raw"))
    return infer_date_order(iso.unionByName(slash), "date_raw", ["o_orderkey", "o_totalprice"])


def html_pages(spark, d) -> DataFrame:
    p = spread(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size"))
    name_header = F.when(F.col("p_partkey") % 31 == 0, F.lit("Label")).otherwise(F.lit("Name"))
    html = F.concat(
        F.lit("<html><body><p>part "), F.col("p_partkey").cast("string"),
        F.lit('</p><table id="decoy"><tr><td>x</td></tr></table><table id="parts"><thead><tr><th></th><th>Key</th><th>'),
        name_header, F.lit("</th><th>Brand</th><th> Size </th></tr></thead><tbody><tr><td> "),
        F.col("p_partkey").cast("string"), F.lit(" </td><td>"), F.col("p_name"), F.lit("</td><td>"), F.col("p_brand"),
        F.lit("</td><td>"), F.col("p_size").cast("string"), F.lit("</td></tr><tr><td>"),
        F.col("p_partkey").cast("string"), F.lit("-b</td><td>\n"), F.upper("p_name"), F.lit("\t</td><td>"),
        F.col("p_brand"), F.lit("</td><td>0</td></tr></tbody></table></body></html>"))
    return p.select(F.col("p_partkey"), html.alias("html"))


def html_rows(spark, d):
    """One HTML page per part (a decoy table, padded cells, some changed headers), table rows extracted."""
    return extract_html_table(html_pages(spark, d), "html", "parts", HTML_HEADERS, HTML_COLUMNS,
                              id_col="p_partkey", on_error="quarantine")


def html_page_scan(spark, d):
    """The extractor over the supplied raw web pages (whole documents), two of three with a table put before the
    footer; pages without the wanted table or with other headers are reported, not dropped."""
    p = F.col("page_id")
    row = F.concat(F.lit("<tr><td> "), p.cast("string"), F.lit(" </td><td>page <i>of</i> A&amp;B</td><td>"),
                   F.length("url").cast("string"), F.lit("</td><td>\n&lt;"), p.cast("string"), F.lit("&gt;</td></tr>"))
    head = F.concat(F.lit('<table id="parts"><thead><tr><th>Key</th><th>'), F.when(p % 10 == 0, F.lit("Title")).otherwise(F.lit("Name")),
                    F.lit("</th><th>Brand</th><th>Size</th></tr></thead><tbody>"))
    tables = F.concat(head, row, F.when(p % 3 == 2, row).otherwise(F.lit("")), F.lit("</tbody></table><footer>"))
    html = F.when(p % 3 != 0, F.replace(F.col("html"), F.lit("<footer>"), tables)).otherwise(F.col("html"))
    return extract_html_table(table(spark, d, "pages").select("page_id", html.alias("html")), "html", "parts", HTML_HEADERS,
                              HTML_COLUMNS, id_col="page_id", on_error="quarantine")


def melt_wide_q(spark, d):
    """Quarterly order counts per segment as a wide sheet with blank cells, melted back to long rows."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey).withColumn("c_mktsegment", listed("c_mktsegment", SEGMENTS))
    quarter = F.date_format(F.trunc("o_orderdate", "quarter"), "dd/MM/yyyy").alias("period_raw")
    wide = (j.groupBy(quarter, "o_orderstatus").pivot("c_mktsegment", SEGMENTS).agg(F.count(F.lit(1))))
    # the exported sheet: counts as text, some cells blank
    sheet = wide.select("period_raw", "o_orderstatus", *[
        F.when(F.col(s) % 7 == 0, F.lit("  ")).otherwise(F.col(s).cast("string")).alias(s) for s in SEGMENTS])
    return melt_wide(sheet, ["period_raw", "o_orderstatus"], "segment", "value_raw")


def union_sources(spark, d):
    """Customer and supplier balances as one frame."""
    c = table(spark, d, "customer").select(F.lit("customer").alias("party"), F.col("c_custkey").alias("party_key"),
                                           F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
                                           F.col("c_acctbal").alias("acctbal"))
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("party"), F.col("s_suppkey").alias("party_key"),
                                           F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
                                           F.col("s_acctbal").alias("acctbal"))
    return union_all([c, s])


def label_lookup(spark, d):
    """Noisy part-type labels (case, runs of blanks, tabs) normalised and mapped to codes."""
    p = table(spark, d, "part")
    v = (F.col("p_partkey") % 4).cast("int")
    raw = (F.when(v == 0, F.col("p_type")).when(v == 1, F.lower("p_type"))
           .when(v == 2, F.concat(F.lit("  "), F.col("p_type"), F.lit("   grade\t")))
           .otherwise(F.concat(F.lower("p_type"), F.lit("  Grade"))))
    labels = p.select("p_partkey", raw.alias("label_raw"))
    codes = literal_table(spark, TYPE_CODES, ["label", "type_code"])
    # normalised-label lookup; the code table is broadcast only because its size is proven small
    return sv.lookup(labels, "label_raw", codes).select("p_partkey", "label_raw", "label", "type_code")


def mixed_dates(spark, d):
    """Order dates rendered ISO, day-first or as junk, parsed back."""
    o = table(spark, d, "orders")
    v = (F.col("o_orderkey") % 3).cast("int")
    raw = (F.when(v == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
           .when(v == 1, F.date_format("o_orderdate", "d/M/yyyy")).otherwise(F.lit("not a date")))
    return o.select("o_orderkey", raw.alias("date_raw")).withColumn("order_date", parse_date("date_raw"))


def month_names(spark, d):
    """Order month names in mixed case and padding (plus junk) to the first of the month."""
    o = table(spark, d, "orders")
    v = (F.col("o_orderkey") % 4).cast("int")
    name = F.date_format("o_orderdate", "MMMM")
    raw = (F.when(v == 0, name).when(v == 1, F.concat(F.lit("  "), F.upper(name), F.lit(" ")))
           .when(v == 2, F.lower(name)).otherwise(F.lit("Maytember")))
    out = o.select("o_orderkey", F.year("o_orderdate").cast("string").alias("year_raw"), raw.alias("month_raw"))
    return out.withColumn("period_month", month_start(to_number("year_raw", commas=False),
                                                      month_number("month_raw", fv.MONTH_NAMES)))


def number_parse(spark, d):
    """Order prices with thousands separators, plain, and junk (n/a, NaN, 1d) parsed; truncation to units."""
    o = table(spark, d, "orders")
    v = (F.col("o_orderkey") % 5).cast("int")
    raw = (F.when(v == 0, F.format_number("o_totalprice", 2)).when(v == 1, dec2("o_totalprice"))
           .when(v == 2, F.lit("n/a")).when(v == 3, F.lit("NaN")).otherwise(F.lit("1d")))
    x = o.select("o_orderkey", raw.alias("price_raw"))
    return x.select("o_orderkey", to_number("price_raw").alias("price"), to_long("price_raw", -1).alias("price_units"))


# ---------------------------------------------------------------------------------------
# silver over lineitem: injected faults, exact re-published copies, natural conflicts

LINEITEM_RAW = ["l_orderkey_raw", "l_linenumber_raw", "l_quantity_raw", "l_extendedprice_raw", "l_discount_raw",
                "l_tax_raw", "l_returnflag_raw", "l_shipdate_raw"]


def lineitem_bronze(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    k = F.col("l_orderkey")
    qty = F.when((F.col("l_linenumber") == 7) & (k % 10 == 0), F.concat(F.lit("-"), dec2("l_quantity"))).otherwise(
        dec2("l_quantity"))
    price = F.when(k % 13 == 0, F.lit("n/a")).otherwise(dec2("l_extendedprice"))
    tax = F.when(k % 23 == 0, F.lit("NaN")).otherwise(dec2("l_tax"))
    flag = F.when(k % 17 == 0, F.lower("l_returnflag")).otherwise(F.col("l_returnflag"))
    ship = (F.when(k % 19 == 0, F.lit("Date")).when(k % 11 == 0, F.date_format("l_shipdate", "d/M/yyyy"))
            .otherwise(iso("l_shipdate")))
    raw = li.select(k.cast("string").alias("l_orderkey_raw"), F.col("l_linenumber").cast("string").alias("l_linenumber_raw"),
                    qty.alias("l_quantity_raw"), price.alias("l_extendedprice_raw"), dec2("l_discount").alias("l_discount_raw"),
                    tax.alias("l_tax_raw"), flag.alias("l_returnflag_raw"), ship.alias("l_shipdate_raw"))
    first = raw.withColumn("_ingested_at", F.lit(INGESTED_FIRST))
    # the same facts re-published later with a cosmetic difference (leading blank in the price)
    republished = (raw.filter(F.col("l_returnflag_raw") == "A")
                   .withColumn("l_extendedprice_raw", F.concat(F.lit(" "), F.col("l_extendedprice_raw")))
                   .withColumn("_ingested_at", F.lit(INGESTED_SECOND)))
    both = first.unionByName(republished)
    return both.select(*LINEITEM_RAW, F.lit("lineitem").alias("_source"),
                       F.col("_ingested_at").cast("timestamp_ntz").alias("_ingested_at"),
                       row_hash(LINEITEM_RAW).alias("_source_row_hash"))


def lineitem_transform(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        to_long("l_orderkey_raw", None, commas=False).alias("l_orderkey"),
        to_long("l_linenumber_raw", None, commas=False).cast("int").alias("l_linenumber"),
        to_number("l_quantity_raw").alias("l_quantity"),
        to_number("l_extendedprice_raw").alias("l_extendedprice"),
        to_number("l_discount_raw").alias("l_discount"),
        to_number("l_tax_raw").alias("l_tax"),
        F.col("l_returnflag_raw").alias("l_returnflag"),
        parse_date("l_shipdate_raw").alias("l_shipdate"),
        *[c for c in bronze.columns if c.startswith("_")])


def lineitem_spec(as_of: dt.date) -> TableSpec:
    return TableSpec(columns=(
        ColumnSpec("l_orderkey", "bigint"),
        ColumnSpec("l_linenumber", "int", checks=(Check.in_range(1, 7),)),
        ColumnSpec("l_quantity", "double", checks=(Check.in_range(1, 50),)),
        ColumnSpec("l_extendedprice", "double", checks=(Check.greater_than(0),)),
        ColumnSpec("l_discount", "double", checks=(Check.in_range(0, 0.1),)),
        ColumnSpec("l_tax", "double", checks=(Check.in_range(0, 0.08),)),
        ColumnSpec("l_returnflag", "string", checks=(Check.isin(["A", "N", "R"]),)),
        ColumnSpec("l_shipdate", "date", checks=(Check.in_range(dt.date(1995, 1, 1), as_of),)),
    ), row_checks=(RowCheck("discount_within_tax_margin",
                            lambda: F.col("l_discount") <= F.col("l_tax") + F.lit(0.02), ("l_discount", "l_tax")),))


LINEITEM = SourceDef("lineitem", "bronze.lineitem", "silver.lineitem", ("l_orderkey", "l_linenumber"),
                     lineitem_transform, lineitem_spec, tuple(LINEITEM_RAW))


def lineitem_classified(spark, d) -> DataFrame:
    return classify(lineitem_bronze(spark, d), LINEITEM, LINEITEM_AS_OF, stored=False)


def validate_clean(spark, d):
    """Lineitem with injected faults: the rows passing every check, typed."""
    clean, _ = split(validate(lineitem_transform(lineitem_bronze(spark, d)), lineitem_spec(LINEITEM_AS_OF)))
    return clean.drop("_source", "_ingested_at")


def validate_quarantine(spark, d):
    """Lineitem with injected faults: failed rows with all reasons and fields of the original payload."""
    from quarry.operators.quarantine import with_raw
    from quarry.operators.landing import payload_columns
    b = lineitem_bronze(spark, d)
    _, failed = split(validate(lineitem_transform(with_raw(b, payload_columns(b))), lineitem_spec(LINEITEM_AS_OF)))
    q = quarantine_rows(failed.withColumn(STATUS, F.lit("failed")), "lineitem", "silver.lineitem", INGESTED_SECOND)
    payload = F.from_json("raw_payload", "l_quantity_raw string, l_shipdate_raw string, l_tax_raw string")
    return q.select("reasons", "_source_row_hash", payload.alias("p")).select(
        "reasons", "_source_row_hash", F.col("p.l_quantity_raw").alias("payload_quantity"),
        F.col("p.l_shipdate_raw").alias("payload_shipdate"), F.col("p.l_tax_raw").alias("payload_tax"))


def quarantine_by_reason(spark, d):
    """Quarantined lineitem rows (failed and conflicting) counted per reason."""
    q = quarantine_rows(lineitem_classified(spark, d), "lineitem", "silver.lineitem", INGESTED_SECOND)
    return sv.count_by(q, "reasons")


def quarantine_sample(spark, d):
    """The first six quarantined rows by reason, source and hash."""
    q = quarantine_rows(lineitem_classified(spark, d), "lineitem", "silver.lineitem", INGESTED_SECOND)
    return q.orderBy("reasons", "source", "_source_row_hash").limit(6).select(
        "source", "reasons", "_source_row_hash", truncate("reasons", 24).alias("reasons_start"))


def conflict_quarantine(spark, d):
    """Lineitem business keys with more than one version: every surviving version."""
    c = lineitem_classified(spark, d)
    return c.filter(F.col(STATUS) == "conflict").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "_source_row_hash",
        F.col("_reasons").alias("reasons"))


def silver_accounting(spark, d):
    """Rows in / clean / quarantined / deduped of the lineitem build."""
    return accounting(lineitem_classified(spark, d))


# orders re-published in a second date format; pending orders revised (conflicts)
ORDERS_RAW = ["o_orderkey_raw", "o_custkey_raw", "o_orderstatus_raw", "o_totalprice_raw", "o_orderdate_raw"]


def orders_bronze(spark, d) -> DataFrame:
    o = table(spark, d, "orders")

    def render(date_fmt: str, price: Column, at: dt.datetime) -> DataFrame:
        return o.select(F.col("o_orderkey").cast("string").alias("o_orderkey_raw"),
                        F.col("o_custkey").cast("string").alias("o_custkey_raw"),
                        F.col("o_orderstatus").alias("o_orderstatus_raw"), price.alias("o_totalprice_raw"),
                        F.date_format("o_orderdate", date_fmt).alias("o_orderdate_raw"),
                        F.lit(at).cast("timestamp_ntz").alias("_ingested_at"))

    revised = F.when(F.col("o_orderstatus") == "P", dec2(F.col("o_totalprice") + F.lit(1))).otherwise(dec2("o_totalprice"))
    both = render("yyyy-MM-dd", dec2("o_totalprice"), INGESTED_FIRST).unionByName(
        render("d/M/yyyy", revised, INGESTED_SECOND))
    return both.select(*ORDERS_RAW, F.lit("orders").alias("_source"), "_ingested_at",
                       row_hash(ORDERS_RAW).alias("_source_row_hash"))


def orders_transform(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        to_long("o_orderkey_raw", None, commas=False).alias("o_orderkey"),
        to_long("o_custkey_raw", None, commas=False).alias("o_custkey"),
        F.col("o_orderstatus_raw").alias("o_orderstatus"),
        to_number("o_totalprice_raw").alias("o_totalprice"),
        parse_date("o_orderdate_raw").alias("o_orderdate"),
        *[c for c in bronze.columns if c.startswith("_")])


def orders_spec(as_of: dt.date) -> TableSpec:
    return TableSpec(columns=(
        ColumnSpec("o_orderkey", "bigint"), ColumnSpec("o_custkey", "bigint"),
        ColumnSpec("o_orderstatus", "string", checks=(Check.isin(["F", "O", "P"]),)),
        ColumnSpec("o_totalprice", "double", checks=(Check.greater_than(0),)),
        ColumnSpec("o_orderdate", "date", checks=(Check.in_range(dt.date(1992, 1, 1), as_of),)),
    ))


ORDERS = SourceDef("orders", "bronze.orders", "silver.orders", ("o_orderkey",), orders_transform, orders_spec,
                   tuple(ORDERS_RAW))


def dedup_collapse(spark, d):
    """Orders republished in a second date format: exact copies collapse, revised orders are excluded."""
    return silver_rows(classify(orders_bronze(spark, d), ORDERS, ORDERS_AS_OF))


def run_isolation(spark, d):
    """Accounting of three source builds, one of which cannot be planned (missing column)."""
    broken = SourceDef("orders_broken", "bronze.orders_broken", "silver.orders_broken", ("o_orderkey",),
                       orders_transform, orders_spec, tuple(ORDERS_RAW))
    builds = [(LINEITEM, lineitem_bronze(spark, d), LINEITEM_AS_OF), (ORDERS, orders_bronze(spark, d), ORDERS_AS_OF),
              (broken, orders_bronze(spark, d).drop("o_totalprice_raw"), ORDERS_AS_OF)]
    parts = []
    for sdef, bronze, as_of in builds:
        try:
            acc = accounting(classify(bronze, sdef, as_of))
            parts.append(acc.select(F.lit(sdef.source).alias("source"), F.lit(sdef.silver_table).alias("target_table"),
                                    "*", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("detail")))
        except Exception as exc:  # noqa: BLE001 - isolation: log and go on
            err = literal_table(spark, [(sdef.source, sdef.silver_table, 0, 0, 0, 0, "error", type(exc).__name__)],
                                ["source", "target_table", "rows_in", "rows_clean", "rows_quarantined",
                                 "rows_deduped", "status", "detail"]).select(
                "source", "target_table", *[F.col(c).cast("long") for c in
                                            ["rows_in", "rows_clean", "rows_quarantined", "rows_deduped"]],
                "status", "detail")
            parts.append(err)
    return union_all(parts)


# ---------------------------------------------------------------------------------------
# gold


def unit_normalize(spark, d):
    """Unit prices under two quote conventions and lot sizes, normalised (bid and ask swapped on inversion)."""
    li = table(spark, d, "lineitem")
    basis = (F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit("OTHER"))
             .when(F.col("l_returnflag") == "R", F.lit(fv.UNITS_PER_HOME)).otherwise(F.lit(fv.HOME_PER_UNIT)))
    units = F.when(F.col("l_linenumber") == 1, F.lit(100)).otherwise(F.lit(1)).cast("long")
    mean = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    q = li.select("l_orderkey", "l_linenumber", basis.alias("quote_basis"), units.alias("units_per_quote"),
                  mean.alias("mean_rate"), (mean * (F.lit(1) - F.col("l_discount"))).alias("buy_rate"),
                  (mean * (F.lit(1) + F.col("l_tax"))).alias("sell_rate"))
    m, b, s = invert_quote("mean_rate", "buy_rate", "sell_rate", "quote_basis", "units_per_quote",
                           fv.HOME_PER_UNIT, fv.UNITS_PER_HOME)
    return q.select("l_orderkey", "l_linenumber", "quote_basis", m.alias("unit_mean"), b.alias("unit_buy"),
                    s.alias("unit_sell"))


def dim_date_df(spark, d) -> DataFrame:
    return gold.dim_date([(table(spark, d, "orders"), "o_orderdate"), (table(spark, d, "lineitem"), "l_shipdate"),
                          (table(spark, d, "events"), "ts")])


def dim_date(spark, d):
    """Calendar spine over the date range of orders, lineitem and events."""
    return dim_date_df(spark, d)


def dims_df(spark, d) -> DataFrame:
    n = table(spark, d, "nation")
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("subregion"))
    return sv.join_dim(n, r, "n_regionkey").select("n_nationkey", "n_name", "subregion")


def dims(spark, d):
    """Nation dimension with its region."""
    return dims_df(spark, d)


def fact_daily_df(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(date_key("l_shipdate").alias("date_key"), "l_orderkey", "l_linenumber", "l_extendedprice",
                     "l_returnflag")


def fact_daily(spark, d):
    """Lineitem at day grain with its date key."""
    return fact_daily_df(spark, d)


def fact_monthly(spark, d):
    """Orders at month grain."""
    o = table(spark, d, "orders")
    m = o.groupBy(F.trunc("o_orderdate", "month").alias("month_start")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price"))
    return m.select(date_key("month_start").alias("date_key"), F.lit("ALL").alias("country_iso3"), "n_orders",
                    "total_price")


def fact_annual(spark, d):
    """Average order value per status and year."""
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_orderstatus").alias("indicator_code"), F.year("o_orderdate").alias("year")).agg(
        F.round(F.avg("o_totalprice"), 6).alias("value")).select(
        "indicator_code", F.lit("ALL").alias("country_iso3"), "year", "value")


def fact_quarterly(spark, d):
    """Order counts per quarter and market segment."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    g = j.groupBy(F.trunc("o_orderdate", "quarter").alias("q"), "c_mktsegment").agg(F.count(F.lit(1)).alias("value"))
    return g.select(date_key("q").alias("date_key"), F.lit("orders").alias("measure"),
                    F.lit("Segment").alias("geo_view"), F.col("c_mktsegment").alias("geo_name"), "value")


def recon_df(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    # one scan: per-day partial sums feed both the daily series and the annual figure
    days = li.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(
        F.sum("l_extendedprice").alias("s"), F.count(F.lit(1)).alias("n"))
    days = days.withColumn("year", F.year("day"))
    daily = days.select("year", F.try_divide(F.col("s"), F.col("n")).alias("daily_mean"))
    annual = days.groupBy("year").agg(F.try_divide(F.sum("s"), F.sum("n")).alias("annual_mean"))
    out = reconcile(daily, annual, "year", "daily_mean", "annual_mean", fv.MIN_COVERAGE_DAYS, fv.RECON_TOLERANCE,
                    names=("daily_avg_rate", "annual_avg_rate", "trading_days"))
    return out


def recon_yearly(spark, d):
    """Yearly mean of daily mean prices against the yearly mean of all rows, days >= 200, 1% gate."""
    r = recon_df(spark, d)
    return r.select("year", F.round("daily_avg_rate", 6).alias("daily_avg_rate"),
                    F.round("annual_avg_rate", 6).alias("annual_avg_rate"), "trading_days",
                    F.round("relative_difference", 6).alias("relative_difference"), "within_tolerance")


DATA_TESTS = [
    unique("dim_date", "date_key"), not_null("dim_date", "date_key"),
    unique("dim_date", "calendar_date"), not_null("dim_date", "calendar_date"),
    unique("dims", "n_nationkey"), not_null("dims", "n_nationkey"),
    unique_combination("fact_daily", ["l_orderkey", "l_linenumber"]),
    not_null("fact_daily", "date_key"), relationships("fact_daily", "date_key", "dim_date", "date_key"),
    not_null("fact_daily", "l_extendedprice"), accepted_range("fact_daily", "l_extendedprice", min_value=0, inclusive=False),
    relationships("customer", "c_nationkey", "dims", "n_nationkey"),
    unique("recon", "year"), not_null("recon", "relative_difference"),
    accepted_range("recon", "relative_difference", min_value=0, max_value=0.01),
    accepted_range("fact_daily", "l_extendedprice", min_value=0, max_value=50000,
                   label="accepted_range_fact_daily_l_extendedprice_upto_50000"),
]


def data_tests(spark, d):
    """Declarative tests over the analogue star schema, including deliberately failing ones."""
    models = {"dim_date": dim_date_df(spark, d), "dims": dims_df(spark, d), "fact_daily": fact_daily_df(spark, d),
              "customer": table(spark, d, "customer"), "recon": recon_df(spark, d)}
    return run_data_tests(models, DATA_TESTS)


# ---------------------------------------------------------------------------------------
# serving


def latest_row(spark, d):
    """The last event."""
    ev = table(spark, d, "events")
    return sv.latest(ev.select("event_id", "ts", "user_id", "event_type", "value"), ["ts", "event_id"])


def latest_per_group(spark, d):
    """The last event of every user (ties broken by event id)."""
    ev = table(spark, d, "events")
    return sv.latest_per(ev, ["user_id"], ["ts", "event_id"], ["event_type", "value"])


def monthly_order_value(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy(F.trunc("o_orderdate", "month").alias("month_start")).agg(F.sum("o_totalprice").alias("value"))


def trailing_12(spark, d):
    """The last twelve months of order value, ascending."""
    t = sv.last_n(monthly_order_value(spark, d), ["month_start"], 12)
    return t.select("month_start", F.round("value", 2).alias("value"))


def convert_monthly_exact(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    rate = sv.period_mean(li.select(F.trunc("l_shipdate", "month").alias("month_start"),
                                    F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price")),
                          "month_start", "unit_price", "unit_rate")
    value = monthly_order_value(spark, d).withColumnRenamed("month_start", "month")
    j = value.join(rate, value.month == rate.month_start)
    return j.select("month", "value", "unit_rate", F.try_divide(F.col("value"), F.col("unit_rate")).alias("converted"))


def convert_monthly(spark, d):
    """Monthly order value converted at that month's mean unit price."""
    return convert_monthly_exact(spark, d).select("month", F.round("value", 2).alias("value"), F.round("unit_rate", 6).alias("unit_rate"),
                                                  F.round("converted", 6).alias("converted"))


def run_rate(spark, d):
    """Latest converted month and the total of the trailing twelve converted months."""
    conv = convert_monthly_exact(spark, d)
    latest = sv.latest(conv.dropna(subset=["converted"]), ["month"]).select(
        F.col("month").alias("latest_month"), F.round("converted", 6).alias("latest_converted"))
    trailing = sv.trailing_sum(conv, "month", "converted", 12).select(
        F.round("trailing_12_converted", 6).alias("trailing_12_converted"), F.col("n_periods"))
    return sv.combine_rows([latest, trailing])


def pivot_series_q(spark, d):
    """Order counts per year and region, one column per region."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = sv.join_dim(sv.join_dim(o.join(c, o.o_custkey == c.c_custkey), n, "c_nationkey"), r, "n_regionkey")
    j = j.withColumn("r_name", listed("r_name", REGIONS))
    p = sv.pivot_series(j.withColumn("year", F.year("o_orderdate")), "year", "r_name", F.count(F.lit(1)), REGIONS)
    return p.select("year", *[F.coalesce(F.col(f"`{x}`"), F.lit(0)).cast("long").alias(x) for x in REGIONS])


def first_last_q(spark, d):
    """First and last month (and count in thousands) of each priority's monthly series."""
    o = table(spark, d, "orders")
    m = o.groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("month_start")).agg(
        F.count(F.lit(1)).alias("n"))
    m = m.withColumn("n_thousands", sv.scale("n", 1000.0))
    return sv.first_last(m, ["o_orderpriority"], "month_start", ["n_thousands"])


def coverage_span(spark, d):
    """Span and totals of the order facts."""
    o = table(spark, d, "orders").withColumn("order_date", F.col("o_orderdate").cast("date"))
    return o.agg(F.min("order_date").alias("min_order_date"), F.max("order_date").alias("max_order_date"),
                 F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("o_orderstatus") == "F").alias("n_finished"),
                 F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).cast("long").alias("n_open"))


def silver_log_from_events(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select(F.col("event_type").alias("target_table"), F.col("ts").alias("built_at"), "event_id",
                     F.col("user_id").alias("rows_in"), F.floor("value").cast("long").alias("rows_clean"),
                     (F.col("user_id") % 7).alias("rows_quarantined"),
                     F.when(F.col("value") < 5, F.lit("error")).otherwise(F.lit("ok")).alias("status"))


def silver_report(spark, d):
    """Events read as a run log: per table the maxima of ok runs and the latest ok run."""
    log = silver_log_from_events(spark, d).filter(F.col("status") == "ok")
    cols = ["built_at", "rows_in", "rows_clean", "rows_quarantined"]
    mx = sv.max_by_group(log, "target_table", cols).select(F.lit("max").alias("mode"), "target_table", *cols)
    lt = sv.latest_per(log, ["target_table"], ["built_at", "event_id"], cols).select(
        F.lit("latest").alias("mode"), "target_table", *cols)
    return mx.unionByName(lt)


def feed_document(spark, d):
    """Nested latest-known document (latest event, latest per type, 12-month trend), flattened."""
    ev = table(spark, d, "events")
    latest = sv.latest(ev.select("event_id", "ts", "value"), ["ts", "event_id"]).select(
        F.struct("event_id", F.round("value", 4).alias("value"), F.col("ts").cast("string").alias("as_of")).alias("latest"))
    per_type = sv.latest_per(ev.withColumn("event_type", listed("event_type", EVENT_TYPES)), ["event_type"], ["ts", "event_id"], ["value"])
    by_type = per_type.agg(F.map_from_entries(F.collect_list(F.struct(
        "event_type", F.struct(F.round("value", 4).alias("value"), F.col("ts").cast("string").alias("as_of"))))).alias("by_type"))
    trend = sv.last_n(monthly_order_value(spark, d), ["month_start"], 12).agg(F.sort_array(F.collect_list(F.struct(
        F.col("month_start").cast("string").alias("month"), F.round("value", 2).alias("value")))).alias("trend"))
    doc = sv.combine_rows([latest, by_type, trend]).select(
        F.lit(1).alias("schema_version"), F.struct("latest", "by_type").alias("events"), "trend")
    return doc.select("schema_version", F.col("events.latest.event_id").alias("latest_event_id"),
                      F.col("events.latest.value").alias("latest_value"),
                      F.size("events.by_type").alias("n_types"),
                      F.col("events.by_type")["purchase"]["as_of"].alias("purchase_as_of"),
                      F.size("trend").alias("trend_months"), F.col("trend")[0]["month"].alias("trend_first_month"),
                      F.element_at("trend", -1)["value"].alias("trend_last_value"))


# Survey operator IDs exercised by each registered query:
#   land_first_batch SNK1 STR6 PRJ4 | land_incremental JN5 FLT7 AG14 | ragged_fold SRC1 STR9 FLT5
#   json_flatten SRC2 JS1 | json_array_explode SRC2 FLT6 AR1 | page_check SRC4
#   date_order_evidence JN10 | html_rows, html_page_scan SRC5 | melt_wide SRC6 FLT4 PRJ2
#   union_sources SRC3 ST1 | label_lookup STR1 JN7 | mixed_dates DT1 DT2 | month_names STR5 DT3
#   number_parse STR3 STR4 MT7 | validate_clean VQ1-VQ5 | validate_quarantine VQ4 VQ7 AG8 JS2 JS3
#   quarantine_by_reason AG6 QY14 | quarantine_sample SL4 QY15 | dedup_collapse VQ8 WN3
#   conflict_quarantine VQ9 WN4 | silver_accounting AG13 ST2 ST3 | unit_normalize GD1 PRJ9 MT1 MT2
#   dim_date GD3 AG4 JN9 DT4-DT8 | dims GD4 JN1 | fact_* GD2 GD5-GD8 PRJ3
#   recon_yearly GD9 JN2 FLT3 MT3 QY16 | data_tests DQ1-DQ6 JN6 AG12
#   latest_row QY1 QY3 SL1 | latest_per_group QY2 QY5 WN1 WN2 | trailing_12 QY4 SL2
#   convert_monthly QY9 AG2 JN3 | run_rate QY10 AG9 | pivot_series QY11 AG10 JN4
#   first_last QY12 SL5 MT6 | coverage_span QY7 QY8 AG3 AG5 | silver_report QY13 AG7
#   feed_document QY6 MP1 SNK9 | run_isolation TR5 TR6 SNK7
QUERIES = {
    "land_first_batch": land_first_batch,
    "land_incremental": land_incremental,
    "ragged_fold": ragged_fold,
    "json_flatten": json_flatten,
    "json_array_explode": json_array_explode,
    "page_check": page_check,
    "date_order_evidence": date_order_evidence,
    "html_rows": html_rows,
    "html_page_scan": html_page_scan,
    "melt_wide": melt_wide_q,
    "union_sources": union_sources,
    "label_lookup": label_lookup,
    "mixed_dates": mixed_dates,
    "month_names": month_names,
    "number_parse": number_parse,
    "validate_clean": validate_clean,
    "validate_quarantine": validate_quarantine,
    "quarantine_by_reason": quarantine_by_reason,
    "quarantine_sample": quarantine_sample,
    "dedup_collapse": dedup_collapse,
    "conflict_quarantine": conflict_quarantine,
    "silver_accounting": silver_accounting,
    "unit_normalize": unit_normalize,
    "dim_date": dim_date,
    "dims": dims,
    "fact_daily": fact_daily,
    "fact_monthly": fact_monthly,
    "fact_annual": fact_annual,
    "fact_quarterly": fact_quarterly,
    "recon_yearly": recon_yearly,
    "data_tests": data_tests,
    "latest_row": latest_row,
    "latest_per_group": latest_per_group,
    "trailing_12": trailing_12,
    "convert_monthly": convert_monthly,
    "run_rate": run_rate,
    "pivot_series": pivot_series_q,
    "first_last": first_last_q,
    "coverage_span": coverage_span,
    "silver_report": silver_report,
    "feed_document": feed_document,
    "run_isolation": run_isolation,
}
