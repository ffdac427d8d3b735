"""Declarative data tests run as Spark jobs.

Test kinds: ``not_null``, ``unique``, ``unique_combination``, ``relationships`` and
``accepted_range`` (exclusive or inclusive bounds; nulls pass). :func:`run_data_tests`
returns one row per test ``(test_name, model, failures, status)``.

Row-level tests of one model (``not_null``, ``accepted_range``) are folded into ONE
aggregation pass over that model with ``count_if``; each uniqueness test is one partially
aggregated shuffle; each relationship test is one anti join (broadcast only when adaptive
execution measures the parent side small).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.serving import orphans
from quarry.sources.tabular import union_all


@dataclass(frozen=True)
class DataTest:
    kind: str
    model: str
    columns: tuple
    parent: str | None = None
    parent_column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    label: str | None = None

    @property
    def name(self) -> str:
        if self.label:
            return self.label
        cols = "__".join(self.columns)
        if self.kind == "relationships":
            return f"relationships_{self.model}_{cols}__{self.parent}_{self.parent_column}"
        return f"{self.kind}_{self.model}_{cols}"


def not_null(model, col):
    return DataTest("not_null", model, (col,))


def unique(model, col):
    return DataTest("unique", model, (col,))


def unique_combination(model, cols):
    return DataTest("unique_combination", model, tuple(cols))


def relationships(model, col, parent, parent_column):
    return DataTest("relationships", model, (col,), parent, parent_column)


def accepted_range(model, col, min_value=None, max_value=None, inclusive=True, label=None):
    return DataTest("accepted_range", model, (col,), min_value=min_value, max_value=max_value,
                    inclusive=inclusive, label=label)


def row_failure(t: DataTest) -> Column:
    c = F.col(t.columns[0])
    if t.kind == "not_null":
        return c.isNull()
    bad = F.lit(False)
    if t.min_value is not None:
        bad = bad | ((c < F.lit(t.min_value)) if t.inclusive else (c <= F.lit(t.min_value)))
    if t.max_value is not None:
        bad = bad | ((c > F.lit(t.max_value)) if t.inclusive else (c >= F.lit(t.max_value)))
    return c.isNotNull() & bad


def _result(df: DataFrame, t: DataTest, failures: Column) -> DataFrame:
    return df.agg(failures.cast("long").alias("failures")).select(
        F.lit(t.name).alias("test_name"), F.lit(t.model).alias("model"), F.col("failures"))


def run_data_tests(models: Mapping[str, DataFrame], tests: Sequence[DataTest]) -> DataFrame:
    parts: list[DataFrame] = []
    row_level: dict[str, list[DataTest]] = {}
    for t in tests:
        if t.kind in ("not_null", "accepted_range"):
            row_level.setdefault(t.model, []).append(t)
    for model, ts in row_level.items():
        counts = models[model].agg(*[F.count_if(row_failure(t)).alias(f"c{i}") for i, t in enumerate(ts)])
        stacked = F.explode(F.array(*[F.struct(F.lit(t.name).alias("test_name"),
                                               F.col(f"c{i}").cast("long").alias("failures"))
                                      for i, t in enumerate(ts)]))
        parts.append(counts.select(stacked.alias("t")).select(
            F.col("t.test_name"), F.lit(model).alias("model"), F.col("t.failures")))
    for t in tests:
        df = models.get(t.model)
        if t.kind in ("unique", "unique_combination"):
            cols = list(t.columns)
            keyed = df.filter(F.col(cols[0]).isNotNull()) if t.kind == "unique" else df
            dup = keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
            parts.append(_result(dup, t, F.count(F.lit(1))))
        elif t.kind == "relationships":
            bad = orphans(df, t.columns[0], models[t.parent], t.parent_column)
            parts.append(_result(bad, t, F.count(F.lit(1))))
        elif t.kind not in ("not_null", "accepted_range"):
            raise ValueError(f"unknown data test kind {t.kind}")
    out = union_all(parts)
    return out.select("test_name", "model", "failures",
                      F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))
