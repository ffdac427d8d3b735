"""Gold star schema: staging projections, calendar spine, dimensions, facts, reconciliation.

Dimensions are small by construction (one row per calendar day / per seed row) and are
joined without hints: adaptive execution broadcasts them after measuring their size.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import fixed_values as fv
from quarry.functions.scalar import date_key, invert_quote, month_name
from quarry.operators.reconcile import reconcile
from quarry.sources.tabular import read_seed

DATA_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "data")


def stg_fx(silver_fx: DataFrame) -> DataFrame:
    """Every quote as home currency per 1 foreign unit (mean, buy, sell)."""
    mean, buy, sell = invert_quote("mean_rate", "buy_rate", "sell_rate", "quote_basis", "units_per_quote",
                                   fv.HOME_PER_UNIT, fv.UNITS_PER_HOME)
    return silver_fx.select(
        F.col("rate_date").cast("date").alias("rate_date"), "currency_code",
        F.col("quote_basis").alias("published_quote_basis"),
        F.col("mean_rate").alias("published_mean_rate"),
        mean.alias("kes_per_unit_mean"), buy.alias("kes_per_unit_buy"), sell.alias("kes_per_unit_sell"),
        "_source_row_hash")


def stg_mobile(silver: DataFrame) -> DataFrame:
    return silver.select(F.col("period_month").cast("date").alias("period_month"), "active_agents",
                         "registered_accounts_millions", "agent_cico_volume_million",
                         "agent_cico_value_ksh_billions", "_source_row_hash")


def stg_indicator(silver: DataFrame) -> DataFrame:
    return silver.select("indicator_code", "country_iso3", F.col("year").cast("int").alias("year"),
                         "value", "_source_row_hash")


def stg_metric(silver: DataFrame) -> DataFrame:
    return silver.select("measure", "geo_view", "geo_name", "attribute", "unit", "metric",
                         F.col("period_quarter").cast("date").alias("period_quarter"), "value",
                         "_source_row_hash")


def date_bounds(frames: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """One row ``(min_date, max_date)`` over several date columns.

    Each source is reduced to a one-row aggregate and the rows are unioned, then a final
    aggregate takes least/greatest; no join is needed.
    """
    parts = [df.agg(F.min(F.col(c).cast("date")).alias("lo"), F.max(F.col(c).cast("date")).alias("hi"))
             for df, c in frames]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.min("lo").alias("min_date"), F.max("hi").alias("max_date"))


def calendar(bounds: DataFrame) -> DataFrame:
    """Every day between the bounds with its calendar attributes."""
    spine = bounds.select(F.explode(F.sequence("min_date", "max_date", F.expr("INTERVAL 1 DAY")))
                          .alias("calendar_date"))
    d = F.col("calendar_date")
    return spine.select(
        date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        month_name(d).alias("month_name"), F.dayofmonth(d).alias("day_of_month"),
        F.trunc(d, "month").alias("month_start"), F.trunc(d, "quarter").alias("quarter_start"))


def dim_date(frames: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    return calendar(date_bounds(frames))


def dim_country(spark: SparkSession) -> DataFrame:
    return read_seed(spark, os.path.join(DATA_DIR, "country_ref.csv"),
                     "country_iso3 string, country_name string, subregion string")


def dim_currency(spark: SparkSession) -> DataFrame:
    return read_seed(spark, os.path.join(DATA_DIR, "currency_ref.csv"),
                     "currency_code string, currency_name string, country_iso3 string")


def fact_exchange_rate(stg: DataFrame) -> DataFrame:
    return stg.select(date_key("rate_date").alias("date_key"), "currency_code", "kes_per_unit_mean",
                      "kes_per_unit_buy", "kes_per_unit_sell", "published_quote_basis",
                      "published_mean_rate", "_source_row_hash")


def fact_mobile_money(stg: DataFrame) -> DataFrame:
    return stg.select(date_key("period_month").alias("date_key"),
                      F.lit(fv.HOME_COUNTRY).alias("country_iso3"), "active_agents",
                      "registered_accounts_millions", "agent_cico_volume_million",
                      "agent_cico_value_ksh_billions", "_source_row_hash")


def fact_indicator(stg: DataFrame) -> DataFrame:
    return stg.select("indicator_code", "country_iso3", "year", "value", "_source_row_hash")


def fact_metric(stg: DataFrame) -> DataFrame:
    return stg.select(date_key("period_quarter").alias("date_key"), "measure", "geo_view", "geo_name",
                      "attribute", "unit", "metric", "value", "_source_row_hash")


def recon_usd_rate_yearly(fact_fx: DataFrame, dim: DataFrame, fact_ind: DataFrame) -> DataFrame:
    daily = (fact_fx.filter(F.col("currency_code") == "USD").join(dim, "date_key")
             .select("year", "kes_per_unit_mean"))
    annual = fact_ind.filter((F.col("indicator_code") == fv.RATE_INDICATOR)
                             & (F.col("country_iso3") == fv.HOME_COUNTRY)).select("year", "value")
    return reconcile(daily, annual, "year", "kes_per_unit_mean", "value", fv.MIN_COVERAGE_DAYS,
                     fv.RECON_TOLERANCE, names=("cbk_avg_rate", "worldbank_avg_rate", "cbk_trading_days"))


# ---------------------------------------------------------------------------------------
# whole gold build and its data tests


def build_gold(spark: SparkSession, fx: DataFrame, mobile: DataFrame, indicator: DataFrame,
               metric: DataFrame) -> dict[str, DataFrame]:
    """All gold models from the four silver tables (lazy; nothing is written)."""
    s_fx, s_mm, s_ind, s_met = stg_fx(fx), stg_mobile(mobile), stg_indicator(indicator), stg_metric(metric)
    dim = dim_date([(s_fx, "rate_date"), (s_mm, "period_month"), (s_met, "period_quarter")])
    f_fx, f_ind = fact_exchange_rate(s_fx), fact_indicator(s_ind)
    return {
        "dim_date": dim, "dim_country": dim_country(spark), "dim_currency": dim_currency(spark),
        "fact_exchange_rate": f_fx, "fact_mobile_money": fact_mobile_money(s_mm),
        "fact_worldbank_indicator": f_ind, "fact_gsma_metric": fact_metric(s_met),
        "recon_usd_rate_yearly": recon_usd_rate_yearly(f_fx, dim, f_ind),
    }


def gold_tests():
    """The 32 declarative tests of the star schema."""
    from quarry.operators.data_tests import (accepted_range, not_null, relationships, unique,
                                             unique_combination)
    t = []
    for col in ("date_key", "calendar_date"):
        t += [unique("dim_date", col), not_null("dim_date", col)]
    t += [unique("dim_country", "country_iso3"), not_null("dim_country", "country_iso3")]
    t += [unique("dim_currency", "currency_code"), not_null("dim_currency", "currency_code")]
    f = "fact_exchange_rate"
    t += [unique_combination(f, ["date_key", "currency_code"]),
          not_null(f, "date_key"), relationships(f, "date_key", "dim_date", "date_key"),
          not_null(f, "currency_code"), relationships(f, "currency_code", "dim_currency", "currency_code"),
          not_null(f, "kes_per_unit_mean"), accepted_range(f, "kes_per_unit_mean", min_value=0, inclusive=False)]
    f = "fact_mobile_money"
    t += [unique(f, "date_key"), not_null(f, "date_key"), relationships(f, "date_key", "dim_date", "date_key"),
          not_null(f, "country_iso3"), relationships(f, "country_iso3", "dim_country", "country_iso3")]
    f = "fact_worldbank_indicator"
    t += [unique_combination(f, ["indicator_code", "country_iso3", "year"]), not_null(f, "country_iso3"),
          relationships(f, "country_iso3", "dim_country", "country_iso3"), not_null(f, "value")]
    f = "recon_usd_rate_yearly"
    t += [unique(f, "year"), not_null(f, "year"), not_null(f, "relative_difference"),
          accepted_range(f, "relative_difference", min_value=0, max_value=fv.RECON_TOLERANCE)]
    f = "fact_gsma_metric"
    t += [unique_combination(f, ["measure", "geo_view", "geo_name", "attribute", "unit", "metric", "date_key"]),
          not_null(f, "date_key"), relationships(f, "date_key", "dim_date", "date_key"), not_null(f, "value")]
    return t


def publish_gold(spark: SparkSession, models: dict[str, DataFrame], database: str = "gold") -> None:
    """Materialise every model as a table (each replaced as a new version)."""
    from quarry.plans.silver import replace_table
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in models.items():
        replace_table(spark, df, f"{database}.{name}")


def materialize(spark: SparkSession, df: DataFrame, name: str, kind: str) -> None:
    """Staging models are views (late-bound projections); marts are tables."""
    if kind == "view":
        df.createOrReplaceTempView(name.replace(".", "_"))
    elif kind == "table":
        from quarry.plans.silver import replace_table
        replace_table(spark, df, name)
    else:
        raise ValueError("kind must be 'view' or 'table'")
