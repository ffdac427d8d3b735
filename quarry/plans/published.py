"""The four published feeds over the supplied tables: their transforms and specs, gold and the feed document.

Raw feed rows are derived from ``orders`` by fixed rules (several renderings, faults, copies and
revisions), so they grow with the table; landing, classification, gold and serving are the production code.
The DuckDB SQL at the end states the results on its own.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import fixed_values as fv
from quarry.operators.dedup import COPIES, STATUS
from quarry.operators.landing import land, new_rows
from quarry.operators.serving import combine_rows
from quarry.plans import analogue_sql as sql
from quarry.plans import gold, serve, silver
from quarry.plans.analogues import INGESTED_FIRST, dec2, table
from quarry.plans.lifecycle import namespaces

# --- fixed values: the derived feeds ---------------------------------------------------
AS_OF = dt.date(2012, 6, 30)
LABELS = [label for label, _, _, _ in fv.CURRENCY_LABELS]
COUNTRIES = ["KEN", "RWA", "TZA", "UGA", "USA"]
CODES = ["FX.OWN.TOTL.ZS", "PA.NUS.FCRF", "XX.OTHER"]
VIEWS = ["Region", "Subregion", "World"]


def _pick(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def _orders(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select("*", F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.year("o_orderdate").alias("y"))


def fx_raw(spark, d) -> DataFrame:
    o, k = _orders(spark, d), F.col("k")
    day = F.add_months("o_orderdate", 120)          # ten years on: some days lie behind AS_OF
    date = (F.when(k % 41 == 0, F.lit("Date")).when(k % 3 == 1, F.date_format(day, "d/M/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd")))
    label = _pick(LABELS, F.col("c") % len(LABELS))
    noisy = F.when(k % 37 == 0, F.lit("NO SUCH LABEL")).when(k % 4 == 1, F.concat(F.lit("  "), F.lower(label), F.lit("\t"))).otherwise(label)
    low, high = dec2(F.col("o_totalprice") - 1), dec2(F.col("o_totalprice") + 1)
    swapped = k % 29 == 0
    return o.select(date.alias("date_raw"), noisy.alias("currency_raw"), dec2("o_totalprice").alias("mean_raw"),
                    F.when(swapped, high).otherwise(low).alias("buy_raw"), F.when(swapped, low).otherwise(high).alias("sell_raw"))


def indicator_raw(spark, d) -> DataFrame:
    o, k = _orders(spark, d), F.col("k")
    value = F.when(k % 1999 == 0, F.col("y") + 1).otherwise(F.col("y")) * 10 + F.col("c") % 5
    return o.select(
        _pick(CODES, k % 3).alias("indicator_id"), F.lit("name").alias("indicator_name"), _pick(COUNTRIES, F.col("c") % 5).alias("country_iso3"),
        F.lit("country").alias("country_name"), F.when(k % 31 == 0, F.lit("n/a")).otherwise(F.col("y").cast("string")).alias("year"),
        F.when(F.col("o_orderstatus") != "P", value.cast("string")).alias("value"), F.lit("").alias("unit"),
        F.when(k % 2 == 0, F.lit("A")).alias("obs_status"))


def mobile_raw(spark, d) -> DataFrame:
    o, k = _orders(spark, d), F.col("k")
    month = F.month("o_orderdate")
    name = F.element_at(F.array(*[F.lit(m) for m in fv.MONTH_NAMES]), month)
    agents = (F.when(k % 59 == 0, F.lit("-7")).when(k % 1999 == 0, F.lit("1")).when(k % 2 == 0, F.format_number(month * 1000, 0))
              .otherwise((month * 1000).cast("string")))
    return o.select((F.col("y") + 12).cast("string").alias("year_raw"),
                    F.when(k % 53 == 0, F.lit("Brumaire")).when(k % 2 == 0, F.lower(name)).otherwise(name).alias("month_raw"),
                    agents.alias("active_agents_raw"), F.concat(month.cast("string"), F.lit(".5")).alias("registered_accounts_millions_raw"),
                    F.lit("190").alias("agent_cico_volume_million_raw"), F.concat((F.col("y") % 100 + 1).cast("string"), F.lit(".25"))
                    .alias("agent_cico_value_ksh_billions_raw"))


def metric_raw(spark, d) -> DataFrame:
    o, k = _orders(spark, d), F.col("k")
    quarter = F.trunc(F.add_months("o_orderdate", 120), "quarter")
    return o.select(F.lit(" Accounts").alias("measure_raw"), _pick(VIEWS, F.col("c") % 3).alias("geo_view_raw"),
                    F.concat(F.lit("Area "), (F.col("c") % 50).cast("string"), F.lit(" ")).alias("geo_name_raw"),
                    F.col("o_orderpriority").alias("attribute_raw"), F.lit("Accounts").alias("unit_raw"), F.col("o_orderstatus").alias("metric_raw"),
                    F.when(k % 43 == 0, F.lit("Q1")).otherwise(F.date_format(quarter, "dd/MM/yyyy")).alias("period_raw"),
                    F.when(k % 47 == 0, F.lit("-1")).otherwise(F.date_format(quarter, "yyyyMM")).alias("value_raw"))


RAW = {silver.FX.source: fx_raw, silver.INDICATOR.source: indicator_raw, silver.MOBILE.source: mobile_raw, silver.METRIC.source: metric_raw}


def _classified(spark, d, sdef) -> DataFrame:
    """The rows of one feed as landed, classified: typed values, hash, status, copies and reasons."""
    rows = silver.classify(new_rows(RAW[sdef.source](spark, d), sdef.source, INGESTED_FIRST), sdef, AS_OF)
    values = [c for c in rows.columns if not c.startswith("_")]
    return rows.select(*values, "_source_row_hash", F.col(STATUS).alias("status"), F.col(COPIES).alias("copies"), F.col("_reasons").alias("reasons"))


def published_rates(spark, d):
    """Exchange rates: labels, date formats and quote sides of the FX feed."""
    return _classified(spark, d, silver.FX)


def published_indicators(spark, d):
    """Annual indicators: listed codes and countries, missing values, revisions."""
    return _classified(spark, d, silver.INDICATOR)


def published_payments(spark, d):
    """Monthly payment statistics: month names, numbers with commas, negative counts."""
    return _classified(spark, d, silver.MOBILE)


def published_metrics(spark, d):
    """Quarterly metrics: padded labels, listed views, quarter dates."""
    return _classified(spark, d, silver.METRIC)


def published_feed(spark, d):
    """All four feeds landed, built by run_all, gold published, and the feed document read off its tables."""
    names = namespaces(spark)
    placed = [dataclasses.replace(s, bronze_table=f"{names['bronze']}.{s.source}", silver_table=f"{names['silver']}.{s.source}")
              for s in silver.SOURCES]
    for s in placed:
        land(spark, RAW[s.source](spark, d), s.source, s.bronze_table, INGESTED_FIRST, f"{names['meta']}.ingestion_log")
    silver.run_all(spark, placed, AS_OF, f"{names['meta']}.silver_log", f"{names['silver']}.quarantine")
    at = {s.source: spark.table(s.silver_table) for s in placed}
    models = gold.build_gold(spark, *[at[s.source] for s in (silver.FX, silver.MOBILE, silver.INDICATOR, silver.METRIC)])
    gold.publish_gold(spark, {n: m for n, m in models.items() if n != "recon_usd_rate_yearly"}, names["silver"])
    g = {n: spark.table(f"{names['silver']}.{n}") for n in ("fact_exchange_rate", "fact_mobile_money", "fact_worldbank_indicator",
                                                           "fact_gsma_metric", "dim_date", "dim_country", "dim_currency")}
    doc = serve.feed(g["fact_exchange_rate"], g["fact_mobile_money"], g["fact_worldbank_indicator"], g["dim_date"], "now").select(
        F.col("fx.kes_per_usd.mean").alias("usd_mean"), F.col("fx.kes_per_usd.as_of").alias("usd_as_of"),
        F.array_join(F.array_sort(F.map_keys("fx.regional_units_per_kes")), ",").alias("regional_codes"),
        F.col("kenya_mobile_money.as_of_month").alias("latest_month"), F.col("kenya_mobile_money.active_agents").alias("active_agents"),
        F.size("kenya_mobile_money.cico_value_ksh_billions_last_12m").alias("trend_months"),
        F.col("account_ownership.KEN.pct_adults_15plus").alias("ken_ownership"), F.col("account_ownership.KEN.as_of_year").alias("ken_year"))
    counts = [g[n].agg(F.count(F.lit(1)).alias(f"n_{n}")) for n in g]
    return combine_rows([doc, *counts])


def published_series(spark, d):
    """The series behind the published charts: ownership by country and year, accounts against agents by month."""
    at = {s.source: silver.silver_rows(silver.classify(new_rows(RAW[s.source](spark, d), s.source, INGESTED_FIRST), s, AS_OF))
          for s in silver.SOURCES}
    g = gold.build_gold(spark, *[at[s.source] for s in (silver.FX, silver.MOBILE, silver.INDICATOR, silver.METRIC)])
    own = serve.ownership_series(g["fact_worldbank_indicator"], g["dim_country"])
    months = serve.saturation_series(g["fact_mobile_money"], g["dim_date"])
    none = F.lit(None).cast("double")
    return own.select(F.col("country_name").alias("series"), F.col("year").cast("string").alias("period"), "value", none.alias("agents_thousands")) \
        .unionAll(months.select(F.lit("accounts"), F.col("month").cast("string"), "registered_accounts_millions", "active_agents_thousands"))


QUERIES = {
    "published_series": published_series,
    "published_rates": published_rates,
    "published_indicators": published_indicators,
    "published_payments": published_payments,
    "published_metrics": published_metrics,
    "published_feed": published_feed,
}


# ---------------------------------------------------------------------------------------
# the same in SQL


def _listing(values: list[str]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _classified_sql(p: str, raw: str, columns: list[str], typed: dict[str, str], key: tuple, reasons: list[str]) -> str:
    """CTEs ``{p}_rows`` (values, hash, status, copies, reasons) of a feed whose raw rows ``raw`` selects."""
    values = ", ".join(typed)
    conflict = silver.conflict_reason(key).replace("'", "''")
    return f"""
{p}_b AS (SELECT *, {sql.hash_of(columns)} AS _source_row_hash FROM (SELECT DISTINCT {", ".join(columns)} FROM ({raw}))),
{p}_t AS (SELECT {", ".join(f"{e} AS {c}" for c, e in typed.items())}, _source_row_hash FROM {p}_b),
{p}_v AS (SELECT *, {sql.reasons_expr(reasons)} AS reasons FROM {p}_t),
{p}_g AS (SELECT {values}, min(_source_row_hash) AS _source_row_hash, count(*) AS copies FROM {p}_v WHERE reasons IS NULL GROUP BY {values}),
{p}_k AS (SELECT {", ".join(key)}, count(*) AS nv FROM {p}_g GROUP BY {", ".join(key)}),
{p}_rows AS (SELECT {values}, _source_row_hash, CASE WHEN nv > 1 THEN 'conflict' ELSE 'clean' END AS status, copies,
                    CASE WHEN nv > 1 THEN '{conflict}' END AS reasons FROM {p}_g JOIN {p}_k USING ({", ".join(key)})
             UNION ALL SELECT {values}, _source_row_hash, 'failed', 1, reasons FROM {p}_v WHERE reasons IS NOT NULL)"""


def _label_case(part: int) -> str:
    label = r"upper(trim(regexp_replace(currency_raw, '\s+', ' ', 'g')))"
    quoted = [(x[0], f"'{x[part]}'" if isinstance(x[part], str) else str(x[part])) for x in fv.CURRENCY_LABELS]
    return f"(CASE {label} " + " ".join(f"WHEN '{a}' THEN {b}" for a, b in quoted) + " END)"


def _ctes() -> dict[str, str]:
    nn, chk, num, dec = sql.nn, sql.chk, sql.num, sql.dec2
    as_of = f"DATE '{AS_OF}'"
    base = "(SELECT *, o_orderkey AS k, o_custkey AS c, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(o_orderdate + INTERVAL 10 YEAR AS DATE) AS later FROM orders)"
    low, high = dec("o_totalprice - 1"), dec("o_totalprice + 1")
    label = f"{_listing(LABELS)}[CAST(c % {len(LABELS)} AS INTEGER) + 1]"
    fx = _classified_sql("fx", f"""SELECT CASE WHEN k % 41 = 0 THEN 'Date' WHEN k % 3 = 1 THEN strftime(later, '%-d/%-m/%Y') ELSE strftime(later, '%Y-%m-%d') END AS date_raw,
 CASE WHEN k % 37 = 0 THEN 'NO SUCH LABEL' WHEN k % 4 = 1 THEN '  ' || lower({label}) || chr(9) ELSE {label} END AS currency_raw,
 {dec('o_totalprice')} AS mean_raw, CASE WHEN k % 29 = 0 THEN {high} ELSE {low} END AS buy_raw,
 CASE WHEN k % 29 = 0 THEN {low} ELSE {high} END AS sell_raw FROM {base}""", fv.FX_COLUMNS, {
        "rate_date": sql.date2("date_raw"), "currency_code": _label_case(1), "quote_basis": _label_case(2),
        "units_per_quote": f"CAST(coalesce({_label_case(3)}, -1) AS BIGINT)", "mean_rate": num("mean_raw"), "buy_rate": num("buy_raw"),
        "sell_rate": num("sell_raw")}, silver.FX.key, [
        nn("rate_date"), chk("rate_date", f"rate_date BETWEEN DATE '2000-01-01' AND {as_of}", f"in_range(2000-01-01, {AS_OF})"),
        nn("currency_code"), nn("quote_basis"), nn("mean_rate"), chk("mean_rate", "mean_rate > 0", "greater_than(0)"), nn("buy_rate"),
        chk("buy_rate", "buy_rate > 0", "greater_than(0)"), nn("sell_rate"), chk("sell_rate", "sell_rate > 0", "greater_than(0)"),
        "CASE WHEN buy_rate > sell_rate THEN 'buy_rate_lte_sell_rate' END"])
    indicator = _classified_sql("ind", f"""SELECT {_listing(CODES)}[CAST(k % 3 AS INTEGER) + 1] AS indicator_id, 'name' AS indicator_name,
 {_listing(COUNTRIES)}[CAST(c % 5 AS INTEGER) + 1] AS country_iso3, 'country' AS country_name,
 CASE WHEN k % 31 = 0 THEN 'n/a' ELSE CAST(y AS VARCHAR) END AS year,
 CASE WHEN o_orderstatus <> 'P' THEN CAST(CASE WHEN k % 1999 = 0 THEN y + 1 ELSE y END * 10 + c % 5 AS VARCHAR) END AS value, '' AS unit,
 CASE WHEN k % 2 = 0 THEN 'A' END AS obs_status FROM {base}""", fv.INDICATOR_COLUMNS, {
        "indicator_code": "indicator_id", "country_iso3": "country_iso3", "year": f"CAST(coalesce({num('year', False)}, -1) AS BIGINT)",
        "value": num("value", False)}, silver.INDICATOR.key, [
        chk("indicator_code", f"list_contains({_listing(fv.INDICATOR_CODES)}, indicator_code)", f"isin({fv.INDICATOR_CODES})"),
        chk("country_iso3", f"list_contains({_listing(fv.INDICATOR_COUNTRIES)}, country_iso3)", f"isin({fv.INDICATOR_COUNTRIES})"),
        chk("year", "year BETWEEN 1960 AND 2030", "in_range(1960, 2030)"), nn("value"),
        chk("value", "value >= 0", "greater_than_or_equal_to(0)")])
    number = f"list_position({_listing(fv.MONTH_NAMES)}, upper(month_raw))"
    mobile = _classified_sql("mob", f"""SELECT CAST(y + 12 AS VARCHAR) AS year_raw, CASE WHEN k % 53 = 0 THEN 'Brumaire' WHEN k % 2 = 0 THEN lower(m) ELSE m END AS month_raw,
 CASE WHEN k % 59 = 0 THEN '-7' WHEN k % 1999 = 0 THEN '1' WHEN k % 2 = 0 THEN format('{{:,}}', n * 1000) ELSE CAST(n * 1000 AS VARCHAR) END AS active_agents_raw,
 CAST(n AS VARCHAR) || '.5' AS registered_accounts_millions_raw, '190' AS agent_cico_volume_million_raw,
 CAST(y % 100 + 1 AS VARCHAR) || '.25' AS agent_cico_value_ksh_billions_raw
 FROM (SELECT *, month(o_orderdate) AS n, {_listing(fv.MONTH_NAMES)}[month(o_orderdate)] AS m FROM {base})""", fv.MOBILE_COLUMNS, {
        "period_month": f"CASE WHEN {number} > 0 THEN make_date(CAST(year_raw AS BIGINT), {number}, 1) END",
        "active_agents": f"CAST(coalesce({num('active_agents_raw')}, -1) AS BIGINT)",
        **{c: num(f"{c}_raw") for c in ("registered_accounts_millions", "agent_cico_volume_million", "agent_cico_value_ksh_billions")}},
        silver.MOBILE.key, [
        nn("period_month"), chk("period_month", f"period_month BETWEEN DATE '2007-03-01' AND {as_of}", f"in_range(2007-03-01, {AS_OF})"),
        chk("active_agents", "active_agents >= 0", "greater_than_or_equal_to(0)"),
        chk("registered_accounts_millions", "registered_accounts_millions BETWEEN 0 AND 500", "in_range(0, 500)")])
    text = ["measure", "geo_view", "geo_name", "attribute", "unit", "metric"]
    quarter = "CAST(date_trunc('quarter', later) AS DATE)"
    metric = _classified_sql("met", f"""SELECT ' Accounts' AS measure_raw, {_listing(VIEWS)}[CAST(c % 3 AS INTEGER) + 1] AS geo_view_raw,
 'Area ' || CAST(c % 50 AS VARCHAR) || ' ' AS geo_name_raw, o_orderpriority AS attribute_raw, 'Accounts' AS unit_raw, o_orderstatus AS metric_raw,
 CASE WHEN k % 43 = 0 THEN 'Q1' ELSE strftime({quarter}, '%d/%m/%Y') END AS period_raw,
 CASE WHEN k % 47 = 0 THEN '-1' ELSE strftime({quarter}, '%Y%m') END AS value_raw FROM {base}""", fv.METRIC_COLUMNS, {
        **{c: f"trim({c}_raw)" for c in text}, "period_quarter": "CAST(try_strptime(period_raw, '%d/%m/%Y') AS DATE)", "value": num("value_raw", False)},
        silver.METRIC.key, [
        chk("geo_view", "geo_view IN ('Region', 'Subregion')", "isin(['Region', 'Subregion'])"), nn("period_quarter"),
        chk("period_quarter", f"period_quarter BETWEEN DATE '2001-01-01' AND {as_of}", f"in_range(2001-01-01, {AS_OF})"), nn("value"),
        chk("value", "value >= 0", "greater_than_or_equal_to(0)")])
    return {"fx": fx, "ind": indicator, "mob": mobile, "met": metric}


def oracle() -> dict[str, str]:
    c = _ctes()
    q = {name: f"WITH {c[p]} SELECT * FROM {p}_rows" for name, p in (
        ("published_rates", "fx"), ("published_indicators", "ind"), ("published_payments", "mob"), ("published_metrics", "met"))}
    clean = {p: f"(SELECT * FROM {p}_rows WHERE status = 'clean')" for p in c}
    regional = _listing(fv.REGIONAL_CURRENCIES)
    names = ", ".join("('" + "', '".join(r.split(",")[:2]) + "')" for r in _seed("country_ref"))
    q["published_series"] = f"""WITH {c['ind']}, {c['mob']},
names(country_iso3, country_name) AS (VALUES {names})
SELECT country_name AS series, CAST(year AS VARCHAR) AS period, value, CAST(NULL AS DOUBLE) AS agents_thousands
FROM {clean['ind']} JOIN names USING (country_iso3) WHERE indicator_code = '{fv.OWNERSHIP_INDICATOR}'
UNION ALL SELECT 'accounts', CAST(period_month AS VARCHAR), registered_accounts_millions, active_agents / 1000.0 FROM {clean['mob']}"""
    q["published_feed"] = "WITH " + ",".join(c.values()) + f""",
days AS (SELECT rate_date AS d FROM {clean['fx']} UNION ALL SELECT period_month FROM {clean['mob']} UNION ALL SELECT period_quarter FROM {clean['met']}),
usd AS (SELECT * FROM {clean['fx']} WHERE currency_code = 'USD' ORDER BY rate_date DESC LIMIT 1),
latest AS (SELECT * FROM {clean['mob']} ORDER BY period_month DESC LIMIT 1),
ken AS (SELECT * FROM {clean['ind']} WHERE indicator_code = '{fv.OWNERSHIP_INDICATOR}' AND country_iso3 = 'KEN' ORDER BY year DESC LIMIT 1)
SELECT (SELECT round(mean_rate, 4) FROM usd) AS usd_mean, (SELECT CAST(rate_date AS VARCHAR) FROM usd) AS usd_as_of,
       (SELECT string_agg(DISTINCT currency_code, ',' ORDER BY currency_code) FROM {clean['fx']} WHERE list_contains({regional}, currency_code)) AS regional_codes,
       (SELECT CAST(period_month AS VARCHAR) FROM latest) AS latest_month, (SELECT active_agents FROM latest) AS active_agents,
       CAST(least(12, (SELECT count(*) FROM {clean['mob']})) AS INTEGER) AS trend_months,
       (SELECT round(value, 1) FROM ken) AS ken_ownership, (SELECT CAST(year AS INTEGER) FROM ken) AS ken_year,
       (SELECT count(*) FROM {clean['fx']}) AS n_fact_exchange_rate, (SELECT count(*) FROM {clean['mob']}) AS n_fact_mobile_money,
       (SELECT count(*) FROM {clean['ind']}) AS n_fact_worldbank_indicator, (SELECT count(*) FROM {clean['met']}) AS n_fact_gsma_metric,
       (SELECT max(d) - min(d) + 1 FROM days) AS n_dim_date, {len(_seed('country_ref'))} AS n_dim_country, {len(_seed('currency_ref'))} AS n_dim_currency"""
    q["published_feed"] = q["published_feed"].replace(" AS n_dim_country", "::BIGINT AS n_dim_country").replace(" AS n_dim_currency", "::BIGINT AS n_dim_currency")
    return q


def _seed(name: str) -> list[str]:
    """Rows of a seed file, without its header."""
    with open(f"{gold.DATA_DIR}/{name}.csv") as f:
        return f.read().split("\n")[1:-1]
