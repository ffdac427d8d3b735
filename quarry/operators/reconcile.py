"""Cross-source tolerance reconciliation.

Per period: the mean of a daily series and its day count, against an independently
published figure for the same period; only periods with at least ``min_coverage`` days are
compared, and the relative difference ``|a - b| / b`` is gated by ``tolerance``.
Two aggregations and one join on the period key (both sides are one row per period).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import relative_difference


def reconcile(daily: DataFrame, annual: DataFrame, key: str, daily_value: str,
              annual_value: str, min_coverage: int = 200, tolerance: float = 0.01,
              names: tuple = ("daily_avg", "annual_avg", "days")) -> DataFrame:
    avg_name, ref_name, days_name = names
    left = (daily.groupBy(F.col(key).cast("int").alias(key))
            .agg(F.avg(daily_value).alias(avg_name), F.count(F.lit(1)).alias(days_name)))
    right = annual.select(F.col(key).cast("int").alias(key), F.col(annual_value).alias(ref_name))
    joined = left.join(right, on=key, how="inner").filter(F.col(days_name) >= min_coverage)
    rd = relative_difference(avg_name, ref_name)
    return joined.select(key, avg_name, ref_name, days_name, rd.alias("relative_difference"),
                         (rd <= F.lit(tolerance)).alias("within_tolerance"))
