"""Small tabular sources: seeds, unions, wide-to-long melt and column-set checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from quarry.functions.scalar import not_blank


class SchemaMismatch(ValueError):
    """Raised at plan time when a frame's column set differs from what is expected."""


def require_columns(df: DataFrame, expected: Sequence[str], strict: bool = False,
                    what: str = "input") -> None:
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected and not c.startswith("_")] if strict else []
    if missing or extra:
        raise SchemaMismatch(f"{what}: missing columns {missing}, unexpected columns {extra}")


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reference CSV with a header; empty fields are null."""
    return spark.read.csv(path, header=True, schema=schema)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def melt_wide(df: DataFrame, id_columns: Sequence[str], var: str, value: str,
              out_columns: Sequence[str] | None = None) -> DataFrame:
    """Every non-id column label becomes a ``var`` value; blank or null cells are dropped.

    Missing id columns raise (listing them); labels and values are left untouched.
    """
    missing = [c for c in id_columns if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"wide sheet is missing id columns: {missing}")
    values = [c for c in df.columns if c not in id_columns]
    cast = df.select(*id_columns, *[df[f"`{c}`"].cast("string").alias(c) for c in values])
    long = cast.unpivot(list(id_columns), values, var, value).filter(not_blank(value))
    return long.toDF(*out_columns) if out_columns else long


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} produced zero rows")
    return df


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, rows, columns: Sequence[str]) -> DataFrame:
    """A fixed, small table as an inline VALUES relation.

    Unlike a frame parallelised from driver memory, a VALUES relation carries exact size
    statistics, so the planner can prove it small and broadcast it without a hint.
    """
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
