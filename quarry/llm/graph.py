"""Connected components of a link table by alternating large and small stars.

Every round makes two joins and aggregations over the links alone and writes its result to the
shared folder; the number of rounds grows with the logarithm of the longest path. No component
is ever gathered in one task: a hub with a third of all links is one side of a join whose other
side has one row a node, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b: long): the smallest id reachable."""
    links = _stars(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b"))
    seen = None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        links, now = _smalls(large)
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")) \
        .unionAll(links.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()


def _stars(links: DataFrame) -> DataFrame:
    return materialize(links.distinct(), "links")


def _smalls(links: DataFrame):
    """Small stars: every node's smaller neighbours are linked to the smallest of them."""
    links = links.distinct()
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b") \
        .unionAll(least.select("a", F.col("m").alias("b")))
    out = _stars(out)
    r = out.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return out, (r["n"], r["h"])
