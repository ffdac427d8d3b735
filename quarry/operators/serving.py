"""Serving helpers: latest rows, trailing windows, spans, pivots, dimension joins.

Latest-per-group is an aggregation of ``max(struct(order..., values...))``: partial
aggregation runs before the shuffle, so a key holding a third of all rows is reduced to one
row per input partition before it moves. Top-k over the whole frame is ``orderBy + limit``
(planned as ``TakeOrderedAndProject``: each task keeps k rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import as_col


def _desc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc() for c in cols]


def latest(df: DataFrame, order: Sequence[str], n: int = 1) -> DataFrame:
    """The ``n`` last rows by ``order`` (descending)."""
    return df.orderBy(*_desc(order)).limit(n)


def last_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` last rows, returned in ascending order."""
    return latest(df, order, n).orderBy(*[F.col(c).asc() for c in order])


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               values: Sequence[str]) -> DataFrame:
    """Per key, the row with the greatest ``order`` tuple (ties broken by later order columns)."""
    packed = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in values
                                                          if c not in order])).alias("_latest")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_latest.{c}").alias(c)
                               for c in list(order) + [v for v in values if v not in order]])


def latest_n_per(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, parts: int = 16) -> DataFrame:
    """Per key, the ``n`` last rows by ``order`` with their ``rank`` from 1; give a unique last column as
    tie-break (nulls come last; all rows of a null key are one group).

    Spark plans ``row_number() <= n`` with a group limit on both sides of the exchange: a task sends at most
    ``n`` rows of a key. The limit is taken within ``parts`` parts of every key first, so the rows of a
    hot key never meet in one task before they are few.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(parts))
    last = [F.col(c).desc_nulls_last() for c in order]
    few = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, part).orderBy(*last))).filter(F.col("_rank") <= n)
    ranked = few.drop("_rank").withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*last)))
    return ranked.filter(F.col("rank") <= n)


def first_last(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """First and last row of each series (by ``order``) side by side."""
    aggs = [F.min(order).alias(f"first_{order}"), F.max(order).alias(f"last_{order}")]
    for v in values:
        aggs += [F.min_by(v, order).alias(f"first_{v}"), F.max_by(v, order).alias(f"last_{v}")]
    return df.groupBy(*keys).agg(*aggs)


def span(df: DataFrame, col: str) -> DataFrame:
    """Global min, max and row count."""
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"),
                  F.count(F.lit(1)).alias("n_rows"))


def count_by(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Rows per value, most frequent first (value breaks ties)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc(), F.col(col))


def max_by_group(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def period_mean(df: DataFrame, period: str, value: str, name: str) -> DataFrame:
    return df.groupBy(period).agg(F.avg(value).alias(name))


def trailing_sum(df: DataFrame, order: str, value: str, n: int) -> DataFrame:
    """Sum of ``value`` over the ``n`` latest rows by ``order`` (nulls dropped first)."""
    recent = latest(df.dropna(subset=[value]), [order], n)
    return recent.agg(F.sum(value).alias(f"trailing_{n}_{value}"), F.count(F.lit(1)).alias("n_periods"))


def pivot_series(df: DataFrame, row: str, col: str, value: Column, values: Sequence[str]) -> DataFrame:
    """Long to wide with a fixed list of column values (one aggregation, no value discovery)."""
    return df.groupBy(row).pivot(col, list(values)).agg(value)


def join_dim(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Fact-to-dimension equi join ``USING(key)``.

    No broadcast hint: adaptive execution measures the dimension at run time and
    broadcasts it only under ``spark.sql.autoBroadcastJoinThreshold``; beyond that the
    join stays a shuffle join.
    """
    return fact.join(dim, on=key, how=how)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null ``fk`` has no parent (referential test)."""
    # an anti join never multiplies rows, so the parent keys need no de-duplication pass
    keys = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(keys, on=fk, how="left_anti")


def dropna(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def scale(c, factor: float) -> Column:
    return as_col(c) / F.lit(factor)


def combine_rows(parts: Sequence[DataFrame]) -> DataFrame:
    """Side-by-side columns of several one-row frames, without a join."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in u.columns])


def select_as(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename + select: ``{new_name: old_name_or_Column}``."""
    return df.select(*[as_col(old).alias(new) for new, old in mapping.items()])


def drop_blank_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Skip rows whose listed fields are all null or whitespace."""
    from quarry.functions.scalar import not_blank
    keep = F.lit(False)
    for c in cols:
        keep = keep | not_blank(c)
    return df.filter(keep)


def broadcast_if_small(df: DataFrame, max_bytes: int = 8 * 1024 * 1024) -> DataFrame:
    """Broadcast hint only when the planner's size estimate proves the side small;
    otherwise the frame is returned as is and the join stays a shuffle join."""
    from quarry.session import estimated_bytes
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def lookup(df: DataFrame, label: str, mapping: DataFrame, key: str = "label") -> DataFrame:
    """Dictionary lookup as a left join on the normalised label (unknown labels give nulls)."""
    from quarry.functions.scalar import norm_label
    keyed = df.withColumn(key, norm_label(label))
    return keyed.join(broadcast_if_small(mapping), on=key, how="left")


def mean_and_count(df: DataFrame, keys: Sequence[str], value: str, mean_name: str, count_name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(mean_name), F.count(F.lit(1)).alias(count_name))


def total(df: DataFrame, cond: Column, col: str, names=("n_rows", "conditional_sum")) -> DataFrame:
    """Global row count and the sum of ``col`` over rows meeting ``cond``."""
    return df.agg(F.count(F.lit(1)).alias(names[0]),
                  F.sum(F.when(cond, F.col(col))).alias(names[1]))


def series_by(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """One ordered series per key, as long rows (never collected into one row per key)."""
    return df.select(key, order, value).orderBy(key, order)


def sample_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by a total order (give a unique last column as tie-break)."""
    return df.orderBy(*order).limit(n)


def known_codes(pairs: Sequence[tuple]) -> list:
    """Distinct sorted codes of a fixed lookup table, resolved at plan time."""
    return sorted({p[1] for p in pairs})
