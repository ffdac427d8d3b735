"""DuckDB SQL for the analogue queries: an independent statement of each expected result.

Parameters shared with :mod:`quarry.plans.analogues` (fixed values): first landing at
2026-01-01 00:00:00, second at 2026-01-02 00:00:00; lineitem dates valid up to 2001-06-30,
order dates up to 2001-12-31.
"""

from __future__ import annotations

NUM_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def num(x: str, commas: bool = True) -> str:
    s = f"trim(replace({x}, ',', ''))" if commas else f"trim({x})"
    return f"(CASE WHEN regexp_full_match({s}, '{NUM_PATTERN}') THEN TRY_CAST({s} AS DOUBLE) END)"


def date2(x: str) -> str:
    return f"CAST(coalesce(try_strptime({x}, '%Y-%m-%d'), try_strptime({x}, '%d/%m/%Y')) AS DATE)"


def hash_of(cols: list[str]) -> str:
    return "sha256(concat_ws(chr(31), " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + "))"


def dec2(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)"


def reasons_expr(parts: list[str]) -> str:
    arr = "list_sort(list_distinct([" + ", ".join(parts) + "]))"
    return f"(CASE WHEN len({arr}) > 0 THEN array_to_string({arr}, '; ') END)"


def nn(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '{c}: not_nullable' END"


def chk(c: str, cond: str, name: str) -> str:
    esc = name.replace("'", "''")
    return f"CASE WHEN {c} IS NOT NULL AND NOT ({cond}) THEN '{c}: {esc}' END"


LI_RAW = ["l_orderkey_raw", "l_linenumber_raw", "l_quantity_raw", "l_extendedprice_raw", "l_discount_raw",
          "l_tax_raw", "l_returnflag_raw", "l_shipdate_raw"]
LI_VALUES = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
             "l_shipdate"]

LI_REASONS = reasons_expr([
    nn("l_orderkey"), nn("l_linenumber"), chk("l_linenumber", "l_linenumber >= 1 AND l_linenumber <= 7", "in_range(1, 7)"),
    nn("l_quantity"), chk("l_quantity", "l_quantity >= 1 AND l_quantity <= 50", "in_range(1, 50)"),
    nn("l_extendedprice"), chk("l_extendedprice", "l_extendedprice > 0", "greater_than(0)"),
    nn("l_discount"), chk("l_discount", "l_discount >= 0 AND l_discount <= 0.1", "in_range(0, 0.1)"),
    nn("l_tax"), chk("l_tax", "l_tax >= 0 AND l_tax <= 0.08", "in_range(0, 0.08)"),
    nn("l_returnflag"), chk("l_returnflag", "l_returnflag IN ('A', 'N', 'R')", "isin(['A', 'N', 'R'])"),
    nn("l_shipdate"), chk("l_shipdate", "l_shipdate >= DATE '1995-01-01' AND l_shipdate <= DATE '2001-06-30'",
                          "in_range(1995-01-01, 2001-06-30)"),
    "CASE WHEN l_discount IS NOT NULL AND l_tax IS NOT NULL AND NOT (l_discount <= l_tax + 0.02) "
    "THEN 'discount_within_tax_margin' END",
])

LINEITEM_CTE = f"""
li_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey_raw,
         CAST(l_linenumber AS VARCHAR) AS l_linenumber_raw,
         CASE WHEN l_linenumber = 7 AND l_orderkey % 10 = 0 THEN '-' || {dec2('l_quantity')} ELSE {dec2('l_quantity')} END AS l_quantity_raw,
         CASE WHEN l_orderkey % 13 = 0 THEN 'n/a' ELSE {dec2('l_extendedprice')} END AS l_extendedprice_raw,
         {dec2('l_discount')} AS l_discount_raw,
         CASE WHEN l_orderkey % 23 = 0 THEN 'NaN' ELSE {dec2('l_tax')} END AS l_tax_raw,
         CASE WHEN l_orderkey % 17 = 0 THEN lower(l_returnflag) ELSE l_returnflag END AS l_returnflag_raw,
         CASE WHEN l_orderkey % 19 = 0 THEN 'Date' WHEN l_orderkey % 11 = 0 THEN strftime(l_shipdate, '%-d/%-m/%Y')
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS l_shipdate_raw,
         TIMESTAMP '2026-01-01 00:00:00' AS _ingested_at
  FROM lineitem),
li_bronze AS (
  SELECT *, {hash_of(LI_RAW)} AS _source_row_hash FROM (
    SELECT * FROM li_raw
    UNION ALL
    SELECT l_orderkey_raw, l_linenumber_raw, l_quantity_raw, ' ' || l_extendedprice_raw, l_discount_raw, l_tax_raw,
           l_returnflag_raw, l_shipdate_raw, TIMESTAMP '2026-01-02 00:00:00'
    FROM li_raw WHERE l_returnflag_raw = 'A')),
li_typed AS (
  SELECT CAST({num('l_orderkey_raw', False)} AS BIGINT) AS l_orderkey,
         CAST({num('l_linenumber_raw', False)} AS INTEGER) AS l_linenumber,
         {num('l_quantity_raw')} AS l_quantity,
         {num('l_extendedprice_raw')} AS l_extendedprice,
         {num('l_discount_raw')} AS l_discount,
         {num('l_tax_raw')} AS l_tax,
         l_returnflag_raw AS l_returnflag,
         {date2('l_shipdate_raw')} AS l_shipdate,
         _ingested_at, _source_row_hash, {", ".join(LI_RAW)}
  FROM li_bronze),
li_validated AS (SELECT *, {LI_REASONS} AS reasons FROM li_typed),
li_versions AS (
  SELECT {", ".join(LI_VALUES)},
         arg_min(_source_row_hash, strftime(_ingested_at, '%Y%m%d%H%M%S') || _source_row_hash) AS _source_row_hash,
         count(*) AS copies
  FROM li_validated WHERE reasons IS NULL GROUP BY {", ".join(LI_VALUES)}),
li_keyed AS (SELECT l_orderkey, l_linenumber, count(*) AS nv FROM li_versions GROUP BY l_orderkey, l_linenumber),
li_classified AS (
  SELECT v.*, CASE WHEN k.nv > 1 THEN 'conflict' ELSE 'clean' END AS status,
         CASE WHEN k.nv > 1 THEN 'conflicting duplicate on business key [''l_orderkey'', ''l_linenumber'']' END AS reasons
  FROM li_versions v JOIN li_keyed k USING (l_orderkey, l_linenumber)
  UNION ALL
  SELECT {", ".join(LI_VALUES)}, _source_row_hash, 1 AS copies, 'failed' AS status, reasons
  FROM li_validated WHERE reasons IS NOT NULL)
"""

O_RAW = ["o_orderkey_raw", "o_custkey_raw", "o_orderstatus_raw", "o_totalprice_raw", "o_orderdate_raw"]
O_VALUES = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
O_REASONS = reasons_expr([
    nn("o_orderkey"), nn("o_custkey"), nn("o_orderstatus"),
    chk("o_orderstatus", "o_orderstatus IN ('F', 'O', 'P')", "isin(['F', 'O', 'P'])"),
    nn("o_totalprice"), chk("o_totalprice", "o_totalprice > 0", "greater_than(0)"),
    nn("o_orderdate"), chk("o_orderdate", "o_orderdate >= DATE '1992-01-01' AND o_orderdate <= DATE '2001-12-31'",
                           "in_range(1992-01-01, 2001-12-31)"),
])

ORDERS_CTE = f"""
o_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey_raw, CAST(o_custkey AS VARCHAR) AS o_custkey_raw,
         o_orderstatus AS o_orderstatus_raw, {dec2('o_totalprice')} AS o_totalprice_raw,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate_raw, TIMESTAMP '2026-01-01 00:00:00' AS _ingested_at
  FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN {dec2('o_totalprice + 1')} ELSE {dec2('o_totalprice')} END,
         strftime(o_orderdate, '%-d/%-m/%Y'), TIMESTAMP '2026-01-02 00:00:00'
  FROM orders),
o_typed AS (
  SELECT CAST({num('o_orderkey_raw', False)} AS BIGINT) AS o_orderkey,
         CAST({num('o_custkey_raw', False)} AS BIGINT) AS o_custkey,
         o_orderstatus_raw AS o_orderstatus, {num('o_totalprice_raw')} AS o_totalprice,
         {date2('o_orderdate_raw')} AS o_orderdate, _ingested_at, {hash_of(O_RAW)} AS _source_row_hash
  FROM o_raw),
o_validated AS (SELECT *, {O_REASONS} AS reasons FROM o_typed),
o_versions AS (
  SELECT {", ".join(O_VALUES)},
         arg_min(_source_row_hash, strftime(_ingested_at, '%Y%m%d%H%M%S') || _source_row_hash) AS _source_row_hash
  FROM o_validated WHERE reasons IS NULL GROUP BY {", ".join(O_VALUES)}),
o_keyed AS (SELECT o_orderkey, count(*) AS nv FROM o_versions GROUP BY o_orderkey)
"""

DIM_DATE_CTE = """
bounds AS (
  SELECT least((SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem),
               (SELECT min(CAST(ts AS DATE)) FROM events)) AS lo,
         greatest((SELECT max(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem),
                  (SELECT max(CAST(ts AS DATE)) FROM events)) AS hi),
spine AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS calendar_date FROM bounds),
dim_date AS (
  SELECT CAST(strftime(calendar_date, '%Y%m%d') AS INTEGER) AS date_key, calendar_date,
         CAST(extract(year FROM calendar_date) AS INTEGER) AS year,
         CAST(extract(quarter FROM calendar_date) AS INTEGER) AS quarter,
         CAST(extract(month FROM calendar_date) AS INTEGER) AS month,
         strftime(calendar_date, '%B') AS month_name,
         CAST(extract(day FROM calendar_date) AS INTEGER) AS day_of_month,
         CAST(date_trunc('month', calendar_date) AS DATE) AS month_start,
         CAST(date_trunc('quarter', calendar_date) AS DATE) AS quarter_start
  FROM spine)
"""

RECON_CTE = """
days AS (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_extendedprice) AS s, count(*) AS n FROM lineitem GROUP BY 1),
d_year AS (SELECT CAST(year(day) AS INTEGER) AS year, avg(s / n) AS daily_avg_rate, count(*) AS trading_days,
                  sum(s) / sum(n) AS annual_avg_rate FROM days GROUP BY 1),
recon AS (SELECT year, daily_avg_rate, annual_avg_rate, trading_days,
                 abs(daily_avg_rate - annual_avg_rate) / annual_avg_rate AS relative_difference
          FROM d_year WHERE trading_days >= 200)
"""

MONTHLY_VALUE = "monthly AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, sum(o_totalprice) AS value FROM orders GROUP BY 1)"


def _type_codes_values() -> str:
    from quarry.plans.analogues import TYPE_CODES
    return ", ".join(f"('{a}', '{b}')" for a, b in TYPE_CODES)


def _data_tests_sql() -> str:
    t = []

    def add(name, model, sql_count):
        t.append(f"SELECT '{name}' AS test_name, '{model}' AS model, CAST(({sql_count}) AS BIGINT) AS failures")

    add("unique_dim_date_date_key", "dim_date",
        "SELECT count(*) FROM (SELECT date_key FROM dim_date WHERE date_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    add("not_null_dim_date_date_key", "dim_date", "SELECT count(*) FROM dim_date WHERE date_key IS NULL")
    add("unique_dim_date_calendar_date", "dim_date",
        "SELECT count(*) FROM (SELECT calendar_date FROM dim_date WHERE calendar_date IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    add("not_null_dim_date_calendar_date", "dim_date", "SELECT count(*) FROM dim_date WHERE calendar_date IS NULL")
    add("unique_dims_n_nationkey", "dims",
        "SELECT count(*) FROM (SELECT n_nationkey FROM nation WHERE n_nationkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    add("not_null_dims_n_nationkey", "dims",
        "SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey IS NULL")
    add("unique_combination_fact_daily_l_orderkey__l_linenumber", "fact_daily",
        "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)")
    add("not_null_fact_daily_date_key", "fact_daily", "SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL")
    add("relationships_fact_daily_date_key__dim_date_date_key", "fact_daily",
        "SELECT count(*) FROM lineitem WHERE l_shipdate IS NOT NULL AND CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) "
        "NOT IN (SELECT date_key FROM dim_date WHERE date_key IS NOT NULL)")
    add("not_null_fact_daily_l_extendedprice", "fact_daily", "SELECT count(*) FROM lineitem WHERE l_extendedprice IS NULL")
    add("accepted_range_fact_daily_l_extendedprice", "fact_daily",
        "SELECT count(*) FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_extendedprice <= 0")
    add("relationships_customer_c_nationkey__dims_n_nationkey", "customer",
        "SELECT count(*) FROM customer WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN "
        "(SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey IS NOT NULL)")
    add("unique_recon_year", "recon",
        "SELECT count(*) FROM (SELECT year FROM recon WHERE year IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    add("not_null_recon_relative_difference", "recon", "SELECT count(*) FROM recon WHERE relative_difference IS NULL")
    add("accepted_range_recon_relative_difference", "recon",
        "SELECT count(*) FROM recon WHERE relative_difference IS NOT NULL AND (relative_difference < 0 OR relative_difference > 0.01)")
    add("accepted_range_fact_daily_l_extendedprice_upto_50000", "fact_daily",
        "SELECT count(*) FROM lineitem WHERE l_extendedprice IS NOT NULL AND (l_extendedprice < 0 OR l_extendedprice > 50000)")
    body = "\nUNION ALL\n".join(t)
    return ("WITH " + DIM_DATE_CTE + ", " + RECON_CTE + ", tests AS (" + body + ")\n"
            "SELECT test_name, model, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM tests")


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["land_first_batch"] = f"""
SELECT DISTINCT text, lang, source, 'documents' AS _source, TIMESTAMP '2026-01-01 00:00:00' AS _ingested_at,
       {hash_of(['text', 'lang', 'source'])} AS _source_row_hash
FROM documents"""
    ocols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    q["land_incremental"] = f"""
WITH b1 AS (SELECT DISTINCT {hash_of(ocols)} AS h FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
     b2 AS (SELECT {hash_of(ocols)} AS h FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT CAST(count(*) AS BIGINT) AS rows_received,
       CAST(count(DISTINCT h) FILTER (WHERE h NOT IN (SELECT h FROM b1)) AS BIGINT) AS rows_inserted,
       CAST(count(*) - count(DISTINCT h) FILTER (WHERE h NOT IN (SELECT h FROM b1)) AS BIGINT) AS rows_skipped
FROM b2"""
    q["ragged_fold"] = """
WITH p AS (SELECT *, 3 + p_partkey % 5 AS k FROM part
           WHERE p_partkey % 17 > 5 OR (p_partkey % 17 = 5 AND p_partkey >= 100))
SELECT CAST(p_partkey AS VARCHAR) AS key_raw, p_name AS name_raw, p_brand AS brand_raw,
       CASE WHEN k >= 4 THEN p_type END AS type_raw,
       CASE k WHEN 5 THEN CAST(p_size AS VARCHAR)
              WHEN 6 THEN CAST(p_size AS VARCHAR) || ',' || p_brand || ', size ' || CAST(p_size AS VARCHAR)
              WHEN 7 THEN CAST(p_size AS VARCHAR) || ',' || p_brand || ', size ' || CAST(p_size AS VARCHAR) || ',' || lower(p_type)
       END AS rest_raw
FROM p
UNION ALL SELECT CAST(p_partkey AS VARCHAR), '5" pipe', '3" pipe', 'c', NULL FROM part WHERE p_partkey % 17 = 1
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'abcdef', ' "x', ' y"', 'z' FROM part WHERE p_partkey % 17 = 2
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'two' || chr(10) || 'lines', 'b', NULL, NULL FROM part WHERE p_partkey % 17 = 3
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'next', NULL, NULL, NULL FROM part WHERE p_partkey % 17 = 3
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'a', 'open, never closed', NULL, NULL FROM part WHERE p_partkey % 17 = 4
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'n', 'b', 't', rtrim(repeat('f,', 20000), ',') FROM part
          WHERE p_partkey % 17 = 5 AND p_partkey < 100"""
    q["json_flatten"] = """
SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing_id FROM events"""
    q["json_array_explode"] = """
WITH o AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 3 AND o_orderstatus <> 'P'),
r AS (SELECT o_orderkey, 'ORD' AS indicator_id, CAST(o_totalprice AS VARCHAR) AS value, o.* EXCLUDE (o_orderkey) FROM o
      UNION ALL
      SELECT o_orderkey, 'CUST', NULL, o.* EXCLUDE (o_orderkey) FROM o)
SELECT o_orderkey, indicator_id, o_orderpriority AS indicator_name, CAST(o_custkey AS VARCHAR) AS country_iso3,
       o_orderstatus AS country_name, CAST(year(o_orderdate) AS VARCHAR) AS year, value, '' AS unit,
       CAST(NULL AS VARCHAR) AS obs_status
FROM r"""
    q["page_check"] = """
SELECT o_orderpriority AS request, count(*) AS documents, count(*) FILTER (WHERE o_orderkey % 10 = 3) AS error_documents,
       CAST(7 AS BIGINT) AS declared_pages,
       count(DISTINCT CASE WHEN o_orderkey % 10 <> 3 THEN CAST(o_orderkey % 7 + 1 AS VARCHAR) END) AS pages_seen
FROM orders GROUP BY o_orderpriority"""
    q["date_order_evidence"] = """
WITH s AS (SELECT * FROM orders),
r AS (
  SELECT 'day_first' AS reading, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS d FROM s
  UNION ALL
  SELECT 'month_first', o_orderkey, o_totalprice,
         CASE WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) END
  FROM s)
SELECT reading, count(*) AS slash_rows, count(d) AS parseable,
       CAST(count(*) FILTER (WHERE d IS NOT NULL AND EXISTS (
           SELECT 1 FROM orders o WHERE o.o_orderkey = r.o_orderkey AND o.o_totalprice = r.o_totalprice
                                  AND CAST(o.o_orderdate AS DATE) = r.d)) AS BIGINT) AS matches,
       CAST(count(*) FILTER (WHERE d IS NOT NULL AND EXISTS (
           SELECT 1 FROM orders o WHERE o.o_orderkey = r.o_orderkey AND o.o_totalprice = r.o_totalprice
                                  AND CAST(o.o_orderdate AS DATE) = r.d)) AS DOUBLE) / count(*) AS match_rate
FROM r GROUP BY reading"""
    q["html_rows"] = """
SELECT p_partkey, 1 AS row_number, CAST(p_partkey AS VARCHAR) AS key_raw, p_name AS name_raw, p_brand AS brand_raw,
       CAST(p_size AS VARCHAR) AS size_raw, CAST(NULL AS VARCHAR) AS error
FROM part WHERE p_partkey % 31 <> 0
UNION ALL
SELECT p_partkey, 2, CAST(p_partkey AS VARCHAR) || '-b', upper(p_name), p_brand, '0', NULL
FROM part WHERE p_partkey % 31 <> 0
UNION ALL
SELECT p_partkey, NULL, NULL, NULL, NULL, NULL, 'table headers changed: [''Key'', ''Label'', ''Brand'', ''Size'']'
FROM part WHERE p_partkey % 31 = 0"""
    q["html_page_scan"] = """
WITH p AS (SELECT *, page_id % 3 <> 0 AND html LIKE '%<footer>%' AS has FROM pages)
SELECT page_id, CAST(i AS INTEGER) AS row_number, CAST(page_id AS VARCHAR) AS key_raw, 'page of A&B' AS name_raw,
       CAST(length(url) AS VARCHAR) AS brand_raw, '<' || CAST(page_id AS VARCHAR) || '>' AS size_raw, CAST(NULL AS VARCHAR) AS error
FROM p, unnest(range(1, 1 + page_id % 3)) AS t(i) WHERE has AND page_id % 10 <> 0
UNION ALL SELECT page_id, NULL, NULL, NULL, NULL, NULL, CASE WHEN has THEN 'table headers changed: [''Key'', ''Title'', ''Brand'', ''Size'']'
       ELSE 'table#parts not found' END FROM p WHERE NOT has OR page_id % 10 = 0"""
    q["melt_wide"] = """
SELECT strftime(date_trunc('quarter', o_orderdate), '%d/%m/%Y') AS period_raw, o_orderstatus,
       c_mktsegment AS segment, CAST(count(*) AS VARCHAR) AS value_raw
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2, 3 HAVING count(*) % 7 <> 0"""
    q["union_sources"] = """
SELECT 'customer' AS party, c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"""
    q["label_lookup"] = f"""
WITH l AS (
  SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type)
                    WHEN 2 THEN '  ' || p_type || '   grade' || chr(9) ELSE lower(p_type) || '  Grade' END AS label_raw
  FROM part),
n AS (SELECT *, trim(regexp_replace(upper(coalesce(label_raw, '')), '\\s+', ' ', 'g')) AS label FROM l),
codes(label, type_code) AS (VALUES {_type_codes_values()})
SELECT p_partkey, label_raw, n.label, type_code FROM n LEFT JOIN codes ON n.label = codes.label"""
    q["mixed_dates"] = """
SELECT o_orderkey,
       CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%-d/%-m/%Y')
            ELSE 'not a date' END AS date_raw,
       CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS order_date
FROM orders"""
    q["month_names"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year_raw,
       CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%B') WHEN 1 THEN '  ' || upper(strftime(o_orderdate, '%B')) || ' '
            WHEN 2 THEN lower(strftime(o_orderdate, '%B')) ELSE 'Maytember' END AS month_raw,
       CASE WHEN o_orderkey % 4 < 3 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS period_month
FROM orders"""
    q["number_parse"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 2 THEN o_totalprice END AS price,
       CASE WHEN o_orderkey % 5 < 2 THEN CAST(trunc(o_totalprice) AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS price_units
FROM orders"""
    li = "WITH " + LINEITEM_CTE
    q["validate_clean"] = li + f"SELECT {', '.join(LI_VALUES)}, _source_row_hash FROM li_validated WHERE reasons IS NULL"
    q["validate_quarantine"] = li + """
SELECT reasons, _source_row_hash, l_quantity_raw AS payload_quantity, l_shipdate_raw AS payload_shipdate,
       l_tax_raw AS payload_tax
FROM li_validated WHERE reasons IS NOT NULL"""
    q["quarantine_by_reason"] = li + "SELECT reasons, count(*) AS n FROM li_classified WHERE status <> 'clean' GROUP BY 1"
    q["quarantine_sample"] = li + """
SELECT 'lineitem' AS source, reasons, _source_row_hash, substr(reasons, 1, 24) AS reasons_start FROM li_classified WHERE status <> 'clean'
ORDER BY reasons, source, _source_row_hash LIMIT 6"""
    q["conflict_quarantine"] = li + """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, _source_row_hash, reasons
FROM li_classified WHERE status = 'conflict'"""
    q["silver_accounting"] = li + """
SELECT CAST(sum(copies) AS BIGINT) AS rows_in, CAST(count(*) FILTER (WHERE status = 'clean') AS BIGINT) AS rows_clean,
       CAST(count(*) FILTER (WHERE status <> 'clean') AS BIGINT) AS rows_quarantined,
       CAST(sum(copies - 1) AS BIGINT) AS rows_deduped
FROM li_classified"""
    zero = "CAST(0 AS BIGINT)"
    q["run_isolation"] = "WITH " + LINEITEM_CTE.rstrip().rstrip(",") + ",\n" + ORDERS_CTE.strip() + f"""
SELECT 'lineitem' AS source, 'silver.lineitem' AS target_table, CAST(sum(copies) AS BIGINT) AS rows_in,
       CAST(count(*) FILTER (WHERE status = 'clean') AS BIGINT) AS rows_clean,
       CAST(count(*) FILTER (WHERE status <> 'clean') AS BIGINT) AS rows_quarantined,
       CAST(sum(copies - 1) AS BIGINT) AS rows_deduped, 'ok' AS status, CAST(NULL AS VARCHAR) AS detail
FROM li_classified
UNION ALL
SELECT 'orders', 'silver.orders', r.n, v.clean, r.bad + v.conflicts, r.n - r.bad - v.clean - v.conflicts, 'ok', NULL
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE reasons IS NOT NULL) AS bad FROM o_validated) r,
     (SELECT count(*) FILTER (WHERE nv = 1) AS clean, CAST(sum(CASE WHEN nv > 1 THEN nv ELSE 0 END) AS BIGINT) AS conflicts
      FROM o_keyed) v
UNION ALL
SELECT 'orders_broken', 'silver.orders_broken', {zero}, {zero}, {zero}, {zero}, 'error', 'SchemaMismatch'"""
    q["dedup_collapse"] = "WITH " + ORDERS_CTE + f"""
SELECT {', '.join('v.' + c for c in O_VALUES)}, v._source_row_hash
FROM o_versions v JOIN o_keyed k USING (o_orderkey) WHERE k.nv = 1"""
    q["unit_normalize"] = """
WITH q AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'OTHER' WHEN l_returnflag = 'R' THEN 'UNITS_PER_KES'
              ELSE 'KES_PER_UNIT' END AS quote_basis,
         CASE WHEN l_linenumber = 1 THEN 100 ELSE 1 END AS units,
         l_extendedprice / l_quantity AS m, (l_extendedprice / l_quantity) * (1 - l_discount) AS b,
         (l_extendedprice / l_quantity) * (1 + l_tax) AS s
  FROM lineitem)
SELECT l_orderkey, l_linenumber, quote_basis,
       CASE quote_basis WHEN 'KES_PER_UNIT' THEN m / units WHEN 'UNITS_PER_KES' THEN 1.0 / m END AS unit_mean,
       CASE quote_basis WHEN 'KES_PER_UNIT' THEN b / units WHEN 'UNITS_PER_KES' THEN 1.0 / s END AS unit_buy,
       CASE quote_basis WHEN 'KES_PER_UNIT' THEN s / units WHEN 'UNITS_PER_KES' THEN 1.0 / b END AS unit_sell
FROM q"""
    q["dim_date"] = "WITH " + DIM_DATE_CTE + " SELECT * FROM dim_date"
    q["dims"] = "SELECT n_nationkey, n_name, r_name AS subregion FROM nation JOIN region ON n_regionkey = r_regionkey"
    q["fact_daily"] = """
SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, l_orderkey, l_linenumber, l_extendedprice, l_returnflag
FROM lineitem"""
    q["fact_monthly"] = """
SELECT CAST(strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS INTEGER) AS date_key, 'ALL' AS country_iso3,
       count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY date_trunc('month', o_orderdate)"""
    q["fact_annual"] = """
SELECT o_orderstatus AS indicator_code, 'ALL' AS country_iso3, CAST(year(o_orderdate) AS INTEGER) AS year,
       round(avg(o_totalprice), 6) AS value
FROM orders GROUP BY 1, 3"""
    q["fact_quarterly"] = """
SELECT CAST(strftime(date_trunc('quarter', o_orderdate), '%Y%m%d') AS INTEGER) AS date_key, 'orders' AS measure,
       'Segment' AS geo_view, c_mktsegment AS geo_name, count(*) AS value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY date_trunc('quarter', o_orderdate), c_mktsegment"""
    q["recon_yearly"] = "WITH " + RECON_CTE + """
SELECT year, round(daily_avg_rate, 6) AS daily_avg_rate, round(annual_avg_rate, 6) AS annual_avg_rate, trading_days,
       round(relative_difference, 6) AS relative_difference, relative_difference <= 0.01 AS within_tolerance
FROM recon"""
    q["data_tests"] = _data_tests_sql()
    q["latest_row"] = """
SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1"""
    q["latest_per_group"] = """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""
    q["trailing_12"] = "WITH " + MONTHLY_VALUE + """
SELECT month_start, round(value, 2) AS value FROM (SELECT * FROM monthly ORDER BY month_start DESC LIMIT 12)"""
    q["convert_monthly"] = "WITH " + MONTHLY_VALUE + """,
rate AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, avg(l_extendedprice / l_quantity) AS unit_rate
         FROM lineitem GROUP BY 1)
SELECT m.month_start AS month, round(m.value, 2) AS value, round(r.unit_rate, 6) AS unit_rate,
       round(m.value / r.unit_rate, 6) AS converted
FROM monthly m JOIN rate r ON m.month_start = r.month_start"""
    q["run_rate"] = "WITH " + MONTHLY_VALUE + """,
rate AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, avg(l_extendedprice / l_quantity) AS unit_rate
         FROM lineitem GROUP BY 1),
conv AS (SELECT m.month_start AS month, m.value / r.unit_rate AS converted
         FROM monthly m JOIN rate r ON m.month_start = r.month_start),
last12 AS (SELECT * FROM conv WHERE converted IS NOT NULL ORDER BY month DESC LIMIT 12)
SELECT (SELECT max(month) FROM conv WHERE converted IS NOT NULL) AS latest_month,
       (SELECT round(arg_max(converted, month), 6) FROM conv WHERE converted IS NOT NULL) AS latest_converted,
       (SELECT round(sum(converted), 6) FROM last12) AS trailing_12_converted,
       (SELECT count(*) FROM last12) AS n_periods"""
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    q["pivot_series"] = "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, " + ", ".join(
        f"count(*) FILTER (WHERE r_name = '{r}') AS \"{r}\"" for r in regions) + """
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
GROUP BY 1"""
    q["first_last"] = """
WITH m AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, count(*) / 1000.0 AS n_thousands
           FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, min(month_start) AS first_month_start, max(month_start) AS last_month_start,
       arg_min(n_thousands, month_start) AS first_n_thousands, arg_max(n_thousands, month_start) AS last_n_thousands
FROM m GROUP BY 1"""
    q["coverage_span"] = """
SELECT min(CAST(o_orderdate AS DATE)) AS min_order_date, max(CAST(o_orderdate AS DATE)) AS max_order_date,
       count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_finished,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_open
FROM orders"""
    q["silver_report"] = """
WITH log AS (
  SELECT event_type AS target_table, ts AS built_at, event_id, user_id AS rows_in,
         CAST(floor(value) AS BIGINT) AS rows_clean, user_id % 7 AS rows_quarantined
  FROM events WHERE NOT (value < 5))
SELECT 'max' AS mode, target_table, max(built_at) AS built_at, max(rows_in) AS rows_in, max(rows_clean) AS rows_clean,
       max(rows_quarantined) AS rows_quarantined
FROM log GROUP BY target_table
UNION ALL
SELECT 'latest', target_table, built_at, rows_in, rows_clean, rows_quarantined FROM (
  SELECT *, row_number() OVER (PARTITION BY target_table ORDER BY built_at DESC, event_id DESC) AS rn FROM log) WHERE rn = 1"""
    q["feed_document"] = "WITH " + MONTHLY_VALUE + """,
latest AS (SELECT event_id, round(value, 4) AS value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1),
types AS (SELECT count(DISTINCT event_type) AS n FROM events),
purchase AS (SELECT CAST(max(ts) AS VARCHAR) AS as_of FROM events WHERE event_type = 'purchase'),
trend AS (SELECT * FROM monthly ORDER BY month_start DESC LIMIT 12)
SELECT 1 AS schema_version, (SELECT event_id FROM latest) AS latest_event_id, (SELECT value FROM latest) AS latest_value,
       CAST((SELECT n FROM types) AS INTEGER) AS n_types, (SELECT as_of FROM purchase) AS purchase_as_of,
       CAST((SELECT count(*) FROM trend) AS INTEGER) AS trend_months,
       (SELECT CAST(min(month_start) AS VARCHAR) FROM trend) AS trend_first_month,
       (SELECT round(arg_max(value, month_start), 2) FROM trend) AS trend_last_value"""
    return q
