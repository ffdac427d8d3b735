"""Evidence for the field order of ambiguous slash dates.

When a feed publishes the same facts under two date formats (ISO and ``a/b/yyyy``), each
reading of the slash dates (day-first or month-first) can be tested by matching its rows
against the ISO rows on the value columns and the date. The reading whose rows match is the
right one. One explode over the candidate readings, one left-semi join, one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_READINGS = (("day_first", "d/M/yyyy"), ("month_first", "M/d/yyyy"))


def infer_date_order(df: DataFrame, date_col: str, value_cols: Sequence[str],
                     readings: Sequence[tuple[str, str]] = DEFAULT_READINGS,
                     iso_format: str = "yyyy-M-d") -> DataFrame:
    """Per reading: slash rows, rows it can parse, rows matching an ISO row, match rate."""
    raw = F.col(date_col)
    values = list(value_cols)
    iso = df.select(*values, F.try_to_date(raw, iso_format).alias("_date")).filter(F.col("_date").isNotNull())
    slash = df.filter(raw.contains("/"))
    options = F.array(*[F.struct(F.lit(name).alias("reading"), F.try_to_date(raw, fmt).alias("_date"))
                        for name, fmt in readings])
    cands = slash.select(*values, F.explode(options).alias("_c")).select(*values, "_c.reading", "_c._date")
    totals = cands.groupBy("reading").agg(F.count(F.lit(1)).alias("slash_rows"),
                                          F.count("_date").alias("parseable"))
    matched = (cands.filter(F.col("_date").isNotNull())
               .join(iso, on=values + ["_date"], how="left_semi")
               .groupBy("reading").agg(F.count(F.lit(1)).alias("matches")))
    out = totals.join(matched, on="reading", how="left")
    m = F.coalesce(F.col("matches"), F.lit(0)).cast("long")
    return out.select("reading", "slash_rows", "parseable", m.alias("matches"),
                      F.try_divide(m, F.col("slash_rows")).alias("match_rate"))
