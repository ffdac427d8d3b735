"""Command-line jobs: land the four feeds, build silver, build gold and run its tests, publish
the feed. Each step is an ordinary Spark application (``spark-submit -m`` or ``python -m``).

    python -m quarry.jobs land   --fx FILE --indicator DIR --mobile FILE --metric FILE
    python -m quarry.jobs silver [--as-of YYYY-MM-DD] [--parallel N]
    python -m quarry.jobs gold
    python -m quarry.jobs feed   --out PATH/latest.json
    python -m quarry.jobs all    (every option above)
    python -m quarry.jobs stream --fx-dir DIR --checkpoint PATH   (new FX files, landed once)

A failing source is logged and the run goes on; the exit status is non-zero when any source
or any data test failed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.functions import fixed_values as fv


def _spark(master: str | None) -> SparkSession:
    from quarry.session import ensure_databases, ensure_warehouse, get_spark
    spark = get_spark(master, app_name="quarry-jobs")
    ensure_warehouse(spark)
    ensure_databases(spark)
    return spark


def land_all(spark: SparkSession, fx: str | None, indicator: str | None, mobile: str | None,
             metric: str | None, buckets: int | None = None, indexed: bool = False) -> int:
    from quarry.operators.landing import BUCKETS, land, log_failure
    from quarry.sources import (assert_complete_pages, extract_html_table, flatten_paged_json, melt_wide,
                                read_ragged_csv)
    from quarry.sources.tabular import require_nonempty

    def indicator_rows():
        paths = ["indicator.id", "indicator.value", "countryiso3code", "country.value", "date", "value",
                 "unit", "obs_status"]
        docs = spark.read.text(indicator, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
        # the pages of a request are files whose names differ in their number alone
        request = F.regexp_replace("file", r"[0-9]+\.\w+$", "")
        assert_complete_pages(docs, request=request)
        return flatten_paged_json(docs, dict(zip(fv.INDICATOR_COLUMNS, paths)))

    def mobile_rows():
        pages = spark.read.text(mobile, wholetext=True).withColumnRenamed("value", "html")
        return extract_html_table(pages, "html", fv.MOBILE_TABLE_ID, fv.MOBILE_HEADERS, fv.MOBILE_COLUMNS) \
            .select(*fv.MOBILE_COLUMNS)

    def metric_rows():
        sheet = spark.read.csv(metric, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        rows = melt_wide(sheet, fv.METRIC_ID_COLUMNS, "period_raw", "value_raw", fv.METRIC_COLUMNS)
        return require_nonempty(rows, "the metric sheet")

    feeds = [("cbk_fx_csv", "bronze.cbk_fx_rates", fx, lambda: read_ragged_csv(spark, fx, fv.FX_COLUMNS)),
             ("worldbank_api", "bronze.worldbank_indicators", indicator, indicator_rows),
             ("cbk_mobile_html", "bronze.cbk_mobile_payments", mobile, mobile_rows),
             ("gsma_xlsx", "bronze.gsma_mobile_money", metric, metric_rows)]
    failures = 0
    for source, table, path, read in feeds:
        if not path:
            continue
        try:
            r = land(spark, read(), source, table, buckets=buckets or BUCKETS, indexed=indexed)
            print(f"{source}: received {r.rows_received}, inserted {r.rows_inserted}, skipped {r.rows_skipped}")
        except Exception as exc:  # noqa: BLE001 - a failing source is logged, the others go on
            failures += 1
            log_failure(spark, source, table, repr(exc))
            print(f"{source}: FAILED {exc!r}", file=sys.stderr)
    return failures


def silver(spark: SparkSession, as_of: dt.date | None, parallel: int) -> int:
    from quarry.plans.silver import SOURCES, run_all
    return run_all(spark, SOURCES, as_of, parallel=parallel)       # a source without bronze table fails and is logged


def gold(spark: SparkSession) -> int:
    from quarry.operators.data_tests import run_data_tests
    from quarry.plans.gold import build_gold, gold_tests, publish_gold
    models = build_gold(spark, spark.table("silver.fx_rates_daily"), spark.table("silver.mobile_payments_monthly"),
                        spark.table("silver.worldbank_annual"), spark.table("silver.gsma_metrics_quarterly"))
    publish_gold(spark, models)
    results = run_data_tests({n: spark.table(f"gold.{n}") for n in models}, gold_tests()).collect()
    failed = [r for r in results if r["status"] != "pass"]
    for r in failed:
        print(f"data test failed: {r['test_name']} ({r['failures']} rows)", file=sys.stderr)
    print(f"data tests: {len(results) - len(failed)} of {len(results)} passed")
    return len(failed)


def feed(spark: SparkSession, out: str) -> str:
    from quarry.plans.serve import feed as build_feed, write_feed
    from quarry.operators.landing import utc_now
    g = {n: spark.table(f"gold.{n}") for n in ("fact_exchange_rate", "fact_mobile_money",
                                               "fact_worldbank_indicator", "dim_date")}
    return write_feed(build_feed(g["fact_exchange_rate"], g["fact_mobile_money"], g["fact_worldbank_indicator"],
                                 g["dim_date"], utc_now().isoformat(timespec="seconds")), out)


def stream_fx(spark: SparkSession, folder: str, checkpoint: str) -> None:
    """Land new headerless FX files from ``folder`` (each file once; replays insert nothing)."""
    from quarry.sources import read_ragged_csv
    from quarry.streaming import land_stream
    land_stream(spark, folder, "", "cbk_fx_csv", "bronze.cbk_fx_rates", checkpoint=checkpoint,
                read_files=lambda session, paths: read_ragged_csv(session, paths, fv.FX_COLUMNS))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quarry.jobs")
    ap.add_argument("step", choices=["land", "silver", "gold", "feed", "all", "stream"])
    ap.add_argument("--fx-dir")
    ap.add_argument("--checkpoint")
    ap.add_argument("--master")
    ap.add_argument("--fx")
    ap.add_argument("--indicator")
    ap.add_argument("--mobile")
    ap.add_argument("--metric")
    ap.add_argument("--as-of", type=dt.date.fromisoformat)
    ap.add_argument("--parallel", type=int, default=1)
    ap.add_argument("--indexed", action="store_true", help="keep an index of row hashes beside the bronze tables")
    ap.add_argument("--buckets", type=int, help="buckets of bronze tables that this run creates")
    ap.add_argument("--out")
    a = ap.parse_args(argv)
    spark = _spark(a.master)
    bad = 0
    if a.step in ("land", "all"):
        bad += land_all(spark, a.fx, a.indicator, a.mobile, a.metric, a.buckets, a.indexed)
    if a.step in ("silver", "all"):
        bad += silver(spark, a.as_of, a.parallel)
    if a.step in ("gold", "all"):
        bad += gold(spark)
    if a.step == "stream" and not (a.fx_dir and a.checkpoint):
        ap.error("stream needs --fx-dir and --checkpoint")
    if a.step == "stream":
        stream_fx(spark, a.fx_dir, a.checkpoint)
        print(f"bronze.cbk_fx_rates: {spark.table('bronze.cbk_fx_rates').count()} rows")
    if a.step in ("feed", "all") and a.out:
        print(f"feed written to {feed(spark, a.out)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
