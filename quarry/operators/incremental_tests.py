"""Data tests over changed data: only the keys of a change are tested again.

A test of uniqueness or of a reference keeps, for every key, how many rows hold it (and how many parents have
it). These counts add up, so a change is merged into the parts of the summary that its keys fall
into; every part's number of failures is kept in the log, and the result is their sum. Row tests
keep their failures alone. A change is a frame of rows with ``_sign``: +1 for a row that came, -1 for one that
went (all +1 if there is no such column).

A run's last write for a test is its row in the log, under the key of the change: a change is counted
once, however often it is given, and what a run that died has written is never read.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.data_tests import DataTest, row_failure
from quarry.session import ensure_warehouse

SIGN = "_sign"
#: Parts of a test's summary.
PARTS = 64

RUNS_SCHEMA = T.StructType([
    T.StructField("test_name", T.StringType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("run_id", T.LongType(), False),
    T.StructField("change_key", T.StringType(), False),
    T.StructField("failures", T.LongType(), False),
    T.StructField("written", T.ArrayType(T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("failures", T.LongType())])), False),
])


def _folder(spark: SparkSession, runs_table: str, test: DataTest) -> str:
    return f"{ensure_warehouse(spark).rstrip('/')}/quarry_tests/{runs_table.replace('.', '/')}/{test.model}/{test.name}"


def _signed(change: DataFrame) -> DataFrame:
    return change if SIGN in change.columns else change.withColumn(SIGN, F.lit(1))


def _keys(change: DataFrame, columns: Sequence[str], nulls: bool, parent: bool, types: Sequence[str] | None = None) -> DataFrame:
    """(k, c, p): a key and its change as rows or as parents."""
    rows = _signed(change)
    if not nulls:
        rows = rows.filter(F.col(columns[0]).isNotNull())
    cast = [F.col(c).cast(t) if types else F.col(c) for c, t in zip(columns, types or columns)]
    n = F.col(SIGN).cast("long")
    return rows.select(F.struct(*[x.alias(f"k{i}") for i, x in enumerate(cast)]).alias("k"),
                       (F.lit(0).cast("long") if parent else n).alias("c"), (n if parent else F.lit(0).cast("long")).alias("p"))


def _change_of(test: DataTest, changes: Mapping[str, DataFrame]) -> DataFrame | None:
    """What a change means to a key test; None if it touches neither of its models."""
    own, columns = changes.get(test.model), list(test.columns)
    if test.kind != "relationships":
        return None if own is None else _keys(own, columns, test.kind == "unique_combination", False)
    parent = changes.get(test.parent)
    parts = [] if own is None else [_keys(own.withColumn(columns[0], F.col(columns[0]).cast("string")), columns, False, False)]
    if parent is not None:      # keys of both sides as text, as their types may differ in width
        parts.append(_keys(parent, [test.parent_column], False, True, ["string"]))
    return parts[0].unionAll(parts[1]) if len(parts) == 2 else parts[0] if parts else None


def update_tests(spark: SparkSession, changes: Mapping[str, DataFrame], tests: Sequence[DataTest], change_key: str,
                 runs_table: str = "meta.test_runs", parts: int = PARTS) -> list[dict]:
    """Count the change ``change_key`` in and return every test's result over all changes so far."""
    runs: dict[str, list] = {}
    if spark.catalog.tableExists(runs_table):
        for r in spark.table(runs_table).orderBy("run_id").collect():
            runs.setdefault(r["test_name"], []).append(r)
    results = []
    for test in tests:
        done = runs.get(test.name, [])
        touched = test.model in changes or (test.parent in changes if test.parent else False)
        if touched and all(r["change_key"] != change_key for r in done):
            done = [*done, _update(spark, test, changes, change_key, done, runs_table, parts)]
        if test.kind in ("not_null", "accepted_range"):
            failures = sum(r["failures"] for r in done)
        else:
            failures = sum({w["part"]: w["failures"] for r in done for w in r["written"]}.values())
        results.append({"test_name": test.name, "model": test.model, "failures": failures, "status": "fail" if failures else "pass"})
    return results


def _update(spark: SparkSession, test: DataTest, changes: Mapping[str, DataFrame], change_key: str, done: list, runs_table: str, parts: int):
    run_id, failures, written = max(time.time_ns(), done[-1]["run_id"] + 1 if done else 0), 0, []
    if test.kind in ("not_null", "accepted_range"):
        bad = _signed(changes[test.model]).agg(F.coalesce(F.sum(F.when(row_failure(test), F.col(SIGN))), F.lit(0)).alias("n"))
        failures = int(bad.first()["n"])
    else:
        base = _folder(spark, runs_table, test)
        change = _change_of(test, changes).groupBy("k").agg(F.sum("c").alias("c"), F.sum("p").alias("p"))
        change = change.withColumn("part", F.pmod(F.xxhash64("k"), F.lit(parts)).cast("int")).checkpoint(eager=True)
        where = {w["part"]: r["run_id"] for r in done for w in r["written"]}
        touched = [r[0] for r in change.select("part").distinct().collect()]        # as many as there are parts
        paths = [f"{base}/run={where[p]}/part={p}" for p in touched if p in where]
        if paths:
            old = spark.read.option("basePath", base).schema(T.StructType([*change.schema.fields, T.StructField("run", T.LongType())])) \
                .parquet(*paths).select("k", "c", "p", "part")
            change = change.unionByName(old).groupBy("k", "part").agg(F.sum("c").alias("c"), F.sum("p").alias("p"))
        # a key that went on both sides stays as a row of zeros: its part is never empty
        change.select("k", "c", "p", "part").repartition(F.col("part")).write.partitionBy("part").parquet(f"{base}/run={run_id}")
        failing = F.sum(F.when(F.col("p") <= 0, F.col("c")).otherwise(0)) if test.kind == "relationships" else F.count_if(F.col("c") > 1)
        stored = spark.read.schema(change.select("k", "c", "p", "part").schema).parquet(f"{base}/run={run_id}")
        written = [(r[0], r[1]) for r in stored.groupBy("part").agg(failing.cast("long").alias("f")).collect()]
    row = (test.name, test.model, run_id, change_key, failures, written)
    df = spark.createDataFrame([row], RUNS_SCHEMA)
    df.coalesce(1).write.mode("append").saveAsTable(runs_table)
    spark.catalog.refreshTable(runs_table)
    return df.first()
