"""Serving queries over gold and the nested "latest known, as of when" feed document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import fixed_values as fv
from quarry.operators.serving import combine_rows, join_dim, last_n, latest, latest_per


def latest_rate(fact_fx: DataFrame, dim: DataFrame, code: str = "USD") -> DataFrame:
    f = join_dim(fact_fx.filter(F.col("currency_code") == code), dim, "date_key")
    return latest(f.select("calendar_date", "kes_per_unit_mean", "kes_per_unit_buy", "kes_per_unit_sell"),
                  ["calendar_date"])


def latest_regional(fact_fx: DataFrame, dim: DataFrame, codes=tuple(fv.REGIONAL_CURRENCIES)) -> DataFrame:
    f = join_dim(fact_fx.filter(F.col("currency_code").isin(list(codes))), dim, "date_key")
    out = latest_per(f, ["currency_code"], ["calendar_date"], ["kes_per_unit_mean"])
    return out.select("currency_code", F.round(F.try_divide(F.lit(1.0), F.col("kes_per_unit_mean")), 6)
                      .alias("units_per_kes"), F.col("calendar_date").alias("as_of"))


def monthly_trend(fact_mm: DataFrame, dim: DataFrame, n: int = 12) -> DataFrame:
    f = join_dim(fact_mm, dim, "date_key").select("calendar_date", "agent_cico_value_ksh_billions")
    return last_n(f, ["calendar_date"], n)


def latest_indicator(fact_ind: DataFrame, code: str = fv.OWNERSHIP_INDICATOR) -> DataFrame:
    return latest_per(fact_ind.filter(F.col("indicator_code") == code), ["country_iso3"], ["year"], ["value"])


def feed(fact_fx: DataFrame, fact_mm: DataFrame, fact_ind: DataFrame, dim: DataFrame, generated_at) -> DataFrame:
    """One-row nested document; every value carries its own as-of date.

    All collected parts are bounded by construction (one latest row, four regional codes,
    twelve months, one row per indicator country).
    """
    usd = latest_rate(fact_fx, dim).select(F.struct(
        F.round("kes_per_unit_mean", 4).alias("mean"), F.round("kes_per_unit_buy", 4).alias("buy"),
        F.round("kes_per_unit_sell", 4).alias("sell"), F.col("calendar_date").cast("string").alias("as_of"))
        .alias("kes_per_usd"))
    regional = latest_regional(fact_fx, dim).agg(F.map_from_entries(F.collect_list(F.struct(
        "currency_code", F.struct("units_per_kes", F.col("as_of").cast("string").alias("as_of")))))
        .alias("regional_units_per_kes"))
    trend = monthly_trend(fact_mm, dim).agg(F.sort_array(F.collect_list(F.struct(
        F.col("calendar_date").cast("string").alias("month"),
        F.round("agent_cico_value_ksh_billions", 2).alias("value")))).alias("cico_value_ksh_billions_last_12m"))
    own = latest_indicator(fact_ind).agg(F.map_from_entries(F.collect_list(F.struct(
        "country_iso3", F.struct(F.round("value", 1).alias("pct_adults_15plus"),
                                 F.col("year").cast("int").alias("as_of_year"))))).alias("account_ownership"))
    month = latest_month(fact_mm, dim).select(F.struct(
        F.col("calendar_date").cast("string").alias("as_of_month"), F.round("registered_accounts_millions", 2).alias("registered_accounts_millions"),
        F.col("active_agents"), F.round("agent_cico_volume_million", 2).alias("agent_cico_volume_million"),
        F.round("agent_cico_value_ksh_billions", 2).alias("agent_cico_value_ksh_billions")).alias("latest_month"))
    doc = combine_rows([usd, regional, trend, own, month])
    return doc.select(F.lit(1).alias("schema_version"), F.lit(str(generated_at)).alias("generated_at_utc"),
                      F.struct("kes_per_usd", "regional_units_per_kes").alias("fx"),
                      F.struct(*[F.col(f"latest_month.{c}").alias(c) for c in (
                          "as_of_month", "registered_accounts_millions", "active_agents", "agent_cico_volume_million",
                          "agent_cico_value_ksh_billions")], "cico_value_ksh_billions_last_12m").alias("kenya_mobile_money"),
                      F.col("account_ownership"))


def write_feed(doc: DataFrame, path: str) -> str:
    """Write the one-row document as ONE JSON file at ``path`` (e.g. ``.../latest.json``).

    The row is written to a sibling working folder, then its single part file is renamed
    into place through the Hadoop file system API (local disk, HDFS or an object store).
    """
    work = path.rstrip("/") + ".writing"
    doc.coalesce(1).write.mode("overwrite").json(work)
    spark = doc.sparkSession
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(work).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [st.getPath() for st in fs.listStatus(Path(work)) if st.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {work}, found {len(parts)}")
    target = Path(path)
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(parts[0], target):
        raise RuntimeError(f"could not move the feed to {path}")
    fs.delete(Path(work), True)
    return path


# ---------------------------------------------------------------------------------------
# the remaining published queries over gold, silver and meta


def latest_month(fact_mm: DataFrame, dim: DataFrame) -> DataFrame:
    """Latest mobile-money month with its headline figures."""
    f = join_dim(fact_mm, dim, "date_key")
    return latest(f.select("calendar_date", "registered_accounts_millions", "active_agents",
                           "agent_cico_volume_million", "agent_cico_value_ksh_billions"), ["calendar_date"])


def coverage(fact_fx: DataFrame, dim: DataFrame) -> DataFrame:
    """First and last rate day and the number of rate facts."""
    from quarry.operators.serving import span
    return span(join_dim(fact_fx, dim, "date_key"), "calendar_date")


def totals(ingestion_log: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows landed by successful runs and rows in quarantine."""
    from quarry.operators.serving import combine_rows
    landed = ingestion_log.agg(F.sum(F.when(F.col("status") == "ok", F.col("rows_inserted"))).alias("rows_landed"))
    quarantined = quarantine.agg(F.count(F.lit(1)).alias("rows_quarantined"))
    return combine_rows([landed, quarantined])


def convert_monthly(fact_fx: DataFrame, fact_mm: DataFrame, dim: DataFrame, code: str = "USD") -> DataFrame:
    """Each month's value converted at that month's mean rate (months without a rate vanish)."""
    from quarry.operators.serving import period_mean
    rates = join_dim(fact_fx.filter(F.col("currency_code") == code), dim, "date_key")
    monthly = period_mean(rates, "month_start", "kes_per_unit_mean", "kes_per_unit")
    mm = join_dim(fact_mm, dim, "date_key").select("calendar_date", "agent_cico_value_ksh_billions")
    j = mm.join(monthly, mm.calendar_date == monthly.month_start)
    return j.select(F.col("calendar_date").alias("month"), "agent_cico_value_ksh_billions", "kes_per_unit",
                    F.try_divide(F.col("agent_cico_value_ksh_billions"), F.col("kes_per_unit")).alias("converted_billions"))


def run_rate(converted: DataFrame, n: int = 12) -> DataFrame:
    """Latest converted month and the trailing-n total."""
    from quarry.operators.serving import combine_rows, trailing_sum
    last = latest(converted.dropna(subset=["converted_billions"]), ["month"]).select(
        F.col("month").alias("latest_month"), F.col("converted_billions").alias("latest_converted_billions"))
    return combine_rows([last, trailing_sum(converted, "month", "converted_billions", n)])


def indicator_pivot(fact_ind: DataFrame, dim_country: DataFrame, countries, code: str = fv.OWNERSHIP_INDICATOR):
    """Year x country table of one indicator (country names are a fixed, known list)."""
    from quarry.operators.serving import pivot_series
    f = join_dim(fact_ind.filter(F.col("indicator_code") == code), dim_country, "country_iso3")
    return pivot_series(f, "year", "country_name", F.first("value"), countries).orderBy("year")


def ownership_series(fact_ind: DataFrame, dim_country: DataFrame, code: str = fv.OWNERSHIP_INDICATOR) -> DataFrame:
    """One indicator's yearly series of every country, as ordered rows (country_name, year, value)."""
    from quarry.operators.serving import series_by
    return series_by(join_dim(fact_ind.filter(F.col("indicator_code") == code), dim_country, "country_iso3"), "country_name", "year", "value")


def saturation_series(fact_mm: DataFrame, dim: DataFrame) -> DataFrame:
    """Accounts against agents (thousands), month by month."""
    from quarry.operators.serving import scale
    return join_dim(fact_mm, dim, "date_key").select(
        F.col("calendar_date").alias("month"), "registered_accounts_millions",
        scale("active_agents", 1000.0).alias("active_agents_thousands")).orderBy("month")


def saturation(fact_mm: DataFrame, dim: DataFrame) -> DataFrame:
    """Accounts against agents (thousands): first and last month of the series."""
    from quarry.operators.serving import first_last, scale
    f = join_dim(fact_mm, dim, "date_key").select(
        F.lit(fv.HOME_COUNTRY).alias("country_iso3"), F.col("calendar_date").alias("month"),
        "registered_accounts_millions", scale("active_agents", 1000.0).alias("active_agents_thousands"))
    return first_last(f, ["country_iso3"], "month", ["registered_accounts_millions", "active_agents_thousands"])


def silver_report(silver_log: DataFrame, mode: str = "latest") -> DataFrame:
    """Per silver table: ``max`` of each figure over ok runs (as the published page did), or
    the figures of the ``latest`` ok run."""
    from quarry.operators.serving import max_by_group
    ok = silver_log.filter(F.col("status") == "ok")
    cols = ["built_at", "rows_in", "rows_clean", "rows_quarantined"]
    if mode == "max":
        return max_by_group(ok, "target_table", cols).orderBy("target_table")
    return latest_per(ok, ["target_table"], ["built_at"], cols[1:]).orderBy("target_table")


def quarantine_by_reason(quarantine: DataFrame) -> DataFrame:
    from quarry.operators.serving import count_by
    return count_by(quarantine, "reasons")


def quarantine_sample(quarantine: DataFrame, n: int = 6, payload_chars: int | None = None) -> DataFrame:
    """The first ``n`` quarantined rows; ``payload_chars`` cuts the payload shown to so many characters."""
    from quarry.functions.scalar import truncate
    from quarry.operators.serving import sample_rows
    payload = truncate("raw_payload", payload_chars).alias("raw_payload") if payload_chars else "raw_payload"
    return sample_rows(quarantine.select("source", "reasons", payload, "_source_row_hash"),
                       ["reasons", "source", "_source_row_hash"], n)


def recon_report(recon: DataFrame, tolerance: float = fv.RECON_TOLERANCE) -> DataFrame:
    return recon.select("year", "cbk_avg_rate", "worldbank_avg_rate", "cbk_trading_days", "relative_difference",
                        (F.col("relative_difference") <= tolerance).alias("passed")).orderBy("year")
