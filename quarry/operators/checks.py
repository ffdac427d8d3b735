"""Declarative row checks compiled to Column expressions (lazy validation).

A :class:`TableSpec` lists typed columns with nullability and value checks, plus named
row-level checks across columns. :func:`validate` adds ``_reasons``: every failed check of
the row as ``"<column>: <check>"`` (row checks by name alone), distinct, sorted by code
point and joined by ``"; "``; null when the row passes. Rules:

* a null fails only ``not_nullable``; value checks skip nulls;
* a row check skips rows where any column it reads is null;
* with ``coerce`` a value that cannot be converted to the declared type fails
  ``coerce_dtype('<type>')``;
* with ``strict`` an undeclared non-metadata column is a schema error raised at plan time.

Everything is evaluated inside the row: no shuffle, no Python.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sources.tabular import SchemaMismatch

REASONS = "_reasons"


def _fmt(v) -> str:
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v) if isinstance(v, str) else str(v)


@dataclass(frozen=True)
class Check:
    name: str
    predicate: Callable[[Column], Column]

    @staticmethod
    def isin(values: Sequence) -> "Check":
        vals = list(values)
        return Check(f"isin({[v for v in vals]})", lambda c: c.isin(vals))

    @staticmethod
    def in_range(lo, hi) -> "Check":
        return Check(f"in_range({_fmt(lo)}, {_fmt(hi)})",
                     lambda c: (c >= F.lit(lo)) & (c <= F.lit(hi)))

    @staticmethod
    def greater_than(x) -> "Check":
        return Check(f"greater_than({_fmt(x)})", lambda c: c > F.lit(x))

    @staticmethod
    def greater_than_or_equal_to(x) -> "Check":
        return Check(f"greater_than_or_equal_to({_fmt(x)})", lambda c: c >= F.lit(x))

    @staticmethod
    def less_than_or_equal_to(x) -> "Check":
        return Check(f"less_than_or_equal_to({_fmt(x)})", lambda c: c <= F.lit(x))


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str
    nullable: bool = False
    checks: tuple = ()


@dataclass(frozen=True)
class RowCheck:
    name: str
    expr: Callable[[], Column]
    columns: tuple = ()


@dataclass(frozen=True)
class TableSpec:
    columns: tuple
    row_checks: tuple = ()
    strict: bool = True
    coerce: bool = True
    meta_prefix: str = "_"

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def check_schema(df: DataFrame, spec: TableSpec) -> None:
    """Schema-level failure (missing or undeclared column) raises: it has no row to blame."""
    missing = [c for c in spec.names if c not in df.columns]
    extra = [c for c in df.columns
             if spec.strict and c not in spec.names and not c.startswith(spec.meta_prefix)]
    if missing or extra:
        raise SchemaMismatch(f"missing columns {missing}, undeclared columns {extra}")


def reason_list(df: DataFrame, spec: TableSpec) -> tuple[list[Column], list[Column]]:
    """(typed column expressions, reason expressions) for ``df`` under ``spec``."""
    typed, reasons = [], []
    dtypes = dict(df.dtypes)
    for cs in spec.columns:
        src = F.col(cs.name)
        val = src
        if spec.coerce and dtypes[cs.name] != cs.dtype:
            val = src.try_cast(cs.dtype)
            reasons.append(F.when(src.isNotNull() & val.isNull(),
                                  F.lit(f"{cs.name}: coerce_dtype('{cs.dtype}')")))
        if not cs.nullable:
            reasons.append(F.when(val.isNull() & (src.isNull() if spec.coerce else F.lit(True)),
                                  F.lit(f"{cs.name}: not_nullable")))
        for ch in cs.checks:
            reasons.append(F.when(val.isNotNull() & ~ch.predicate(val), F.lit(f"{cs.name}: {ch.name}")))
        typed.append(val.alias(cs.name))
    for rc in spec.row_checks:
        guard = F.lit(True)
        for c in rc.columns:
            guard = guard & F.col(c).isNotNull()
        reasons.append(F.when(guard & ~rc.expr(), F.lit(rc.name)))
    return typed, reasons


def join_reasons(reasons: Sequence[Column]) -> Column:
    """Non-null reasons, distinct, code-point sorted, joined by "; "; null when none.

    Built without lambda functions (``sort_array`` + ``concat_ws``, which skips nulls) so
    the whole expression stays inside whole-stage code generation.
    """
    joined = F.concat_ws("; ", F.sort_array(F.array_distinct(F.array(*reasons))))
    return F.nullif(joined, F.lit(""))


def validate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed columns of ``spec`` + every metadata column + ``_reasons``."""
    check_schema(df, spec)
    typed, reasons = reason_list(df, spec)
    meta = [F.col(c) for c in df.columns if c.startswith(spec.meta_prefix) and c not in spec.names]
    # reasons are computed on the raw frame (so a failed coercion is visible), then the
    # typed values replace the raw ones in the same projection.
    # The always-true partition-id guard makes this projection non-deterministic, which
    # stops Catalyst from pushing later filters on ``_reasons`` below it: otherwise every
    # parse expression would be inlined into the filter many times over and evaluated
    # repeatedly per row. With the guard each typed value is computed once.
    once = F.when(F.spark_partition_id() >= 0, join_reasons(reasons))
    return df.select(*typed, *meta, once.alias(REASONS))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows without ``_reasons``, failed rows with them)."""
    clean = validated.filter(F.col(REASONS).isNull()).drop(REASONS)
    failed = validated.filter(F.col(REASONS).isNotNull())
    return clean, failed
