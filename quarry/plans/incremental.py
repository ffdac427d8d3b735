"""Incremental silver: a build reads the bronze rows of new landings and the stored versions of
their keys, and nothing else.

State. The classified rows of a source (clean and conflicting versions with their copies, failed
rows with their payload) are Parquet files in parts: versions by a hash of the business key, so that
all versions of a key share a part, and failed rows by their row hash in parts of their own. A build
writes the touched parts whole, under its own run id, and never changes a file.

Commit. The build's last write is one row in the run log: run id, the landings it took in, the parts
it wrote with their accounting. Readers take every part from the last committed run that wrote it,
so silver, quarantine and accounting always belong together; what a build that died has written is
never seen, and the next build does its work again. One builder for each table at a time.

Which rows are new is decided by the landings (``_ingested_at``) that no committed run has taken
in, not by the greatest one seen: a landing that began early and ended late is not lost. A narrow pass
over that column also tells the earliest file time of the new landings, which prunes the
older bronze files from the scan.

Validity depends on ``as_of``. A later date re-checks the failed rows (their parts hold nothing else)
and leaves valid rows alone, as a later "today" only widens the checks; a source for which that
does not hold passes ``widening=False`` and is then rebuilt, as it is for an earlier date or other parts.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.checks import REASONS
from quarry.operators.dedup import CLEAN, COPIES, FAILED, STATUS, version_hash
from quarry.operators.landing import HASH, payload_columns, utc_now
from quarry.operators.quarantine import RAW, to_quarantine
from quarry.plans.silver import SourceDef, checked, classify, resolved
from quarry.session import discard, ensure_warehouse, release, scratch_table

#: Parts of versions and of failed rows of a new table.
PARTS, FAILED_PARTS = 64, 16
COUNTS = ["rows_in", "rows_clean", "rows_quarantined", "rows_deduped"]

RUNS_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("target_table", T.StringType(), False),
    T.StructField("run_id", T.LongType(), False),
    T.StructField("built_at", T.TimestampNTZType(), False),
    T.StructField("as_of", T.DateType(), False),
    T.StructField("parts", T.IntegerType(), False),
    T.StructField("failed_parts", T.IntegerType(), False),
    T.StructField("reset", T.BooleanType(), False),
    T.StructField("landings", T.ArrayType(T.TimestampNTZType()), False),
    T.StructField("written", T.ArrayType(T.StructType(
        [T.StructField("part", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in COUNTS]])), False),
])


def state_folder(spark: SparkSession, table: str) -> str:
    return f"{ensure_warehouse(spark).rstrip('/')}/quarry_state/{table.replace('.', '/')}"


def committed(spark: SparkSession, table: str, runs_table: str = "meta.silver_runs") -> list:
    """The committed runs of a silver table since its last rebuild, oldest first."""
    if not spark.catalog.tableExists(runs_table):
        return []
    runs = spark.table(runs_table).filter(F.col("target_table") == table).orderBy("run_id").collect()
    resets = [i for i, r in enumerate(runs) if r["reset"]]
    return runs[resets[-1]:] if resets else []


def current_parts(runs: list) -> dict:
    """part -> (run id, its counts) as the last run that wrote it left it."""
    return {w["part"]: (r["run_id"], w) for r in runs for w in r["written"] if w["rows_in"]}


def read_parts(spark: SparkSession, table: str, where: dict) -> DataFrame | None:
    """The stored rows of some parts (part -> run id); only their folders are listed and read."""
    base = state_folder(spark, table)
    if not where:
        return None
    paths = [f"{base}/_run={run}/_part={part}" for part, run in sorted(where.items())]
    return spark.read.option("basePath", base).parquet(*paths).drop("_run", "_part")


def classified_now(spark: SparkSession, sdef: SourceDef, runs_table: str = "meta.silver_runs",
                   bronze: DataFrame | None = None) -> DataFrame:
    """Every row of the committed state with ``_status``, ``_copies`` and ``_built_at``."""
    parts = current_parts(committed(spark, sdef.silver_table, runs_table))
    found = read_parts(spark, sdef.silver_table, {p: run for p, (run, _) in parts.items()})
    if found is None:
        bronze = bronze if bronze is not None else spark.table(sdef.bronze_table)
        return classify(bronze.limit(0), sdef, utc_now().date()).withColumn("_built_at", F.lit(None).cast("timestamp_ntz"))
    return found


def silver_now(spark: SparkSession, sdef: SourceDef, runs_table: str = "meta.silver_runs") -> DataFrame:
    """The clean rows of the committed state."""
    rows = classified_now(spark, sdef, runs_table)
    return rows.filter(F.col(STATUS) == CLEAN).select(*[c for c in rows.columns if not c.startswith("_")], HASH)


def quarantine_now(spark: SparkSession, sdef: SourceDef, runs_table: str = "meta.silver_runs") -> DataFrame:
    """The quarantine records of the committed state; each keeps the time of the run that wrote its part."""
    rows = classified_now(spark, sdef, runs_table).filter(F.col(STATUS) != CLEAN)
    return to_quarantine(rows, sdef.source, sdef.silver_table, F.col("_built_at"))


def last_changes(spark: SparkSession, sdef: SourceDef, runs_table: str = "meta.silver_runs") -> tuple[str, DataFrame | None]:
    """What the last committed run changed in silver: its key, and the clean rows of the parts it wrote with
    ``_sign`` +1 beside those they held before with -1 (None if nothing is committed). After a rebuild
    all rows come as new, under a key that says so: summaries of earlier changes do not hold any more."""
    runs = committed(spark, sdef.silver_table, runs_table)
    if not runs:
        return "", None
    last, before = runs[-1], current_parts(runs[:-1])
    sides = [({w["part"]: last["run_id"] for w in last["written"] if w["rows_in"]}, 1),
             ({w["part"]: before[w["part"]][0] for w in last["written"] if w["part"] in before}, -1)]
    found = [rows.filter(F.col(STATUS) == CLEAN).withColumn("_sign", F.lit(sign))
             for where, sign in sides if (rows := read_parts(spark, sdef.silver_table, where)) is not None]
    changed = found[0] if len(found) == 1 else found[0].unionByName(found[1]) if found else None
    return f"{'rebuild' if last['reset'] else 'run'} {last['run_id']}", changed


def accounting_now(spark: SparkSession, sdef: SourceDef, runs_table: str = "meta.silver_runs") -> dict:
    """rows_in, rows_clean, rows_quarantined, rows_deduped of the committed state, from the log alone."""
    parts = current_parts(committed(spark, sdef.silver_table, runs_table))
    return {c: sum(counts[c] for _, counts in parts.values()) for c in COUNTS}


def part_of(rows: DataFrame, key: list[str], parts: int, failed_parts: int) -> Column:
    """The part of a checked row: by its business key, or by its hash if it failed."""
    valid = F.pmod(version_hash(rows, key), F.lit(parts))
    return F.when(_failed(rows), F.lit(parts) + F.pmod(F.xxhash64(HASH), F.lit(failed_parts))).otherwise(valid).cast("int")


def _failed(rows: DataFrame) -> Column:
    return F.col(STATUS) == FAILED if STATUS in rows.columns else F.col(REASONS).isNotNull()


def landings_of(bronze: DataFrame) -> dict:
    """Landing time -> earliest time of a file that holds rows of it (None for rows that are in no file).
    A narrow pass: one column and what the file listing knows; its result has one row for each landing."""
    try:
        found = bronze.groupBy("_ingested_at").agg(F.min("_metadata.file_modification_time").alias("t"))
        found.schema  # noqa: B018 - analysed here
    except AnalysisException:
        found = bronze.groupBy("_ingested_at").agg(F.lit(None).cast("timestamp").alias("t"))
    rows = {r[0]: r[1] for r in found.withColumn("t", F.unix_micros("t")).collect()}
    if None in rows:
        raise ValueError("bronze rows without _ingested_at belong to no landing")
    return rows


def rows_of_landings(bronze: DataFrame, landings: dict) -> DataFrame:
    """The bronze rows of some landings; files that are older than all of them are not opened."""
    rows = bronze.filter(F.col("_ingested_at").isin([F.lit(t).cast("timestamp_ntz") for t in sorted(landings)]))
    times = list(landings.values())
    if times and None not in times:
        rows = rows.filter(F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(min(times))))
    return rows


def update_silver(spark: SparkSession, sdef: SourceDef, as_of: dt.date | None = None, built_at: dt.datetime | None = None,
                  bronze: DataFrame | None = None, runs_table: str = "meta.silver_runs", parts: int = PARTS,
                  failed_parts: int = FAILED_PARTS, widening: bool = True, rebuild: bool = False) -> dict:
    """Take in the landings that no committed run has, and commit. Returns the accounting of the whole
    table with ``touched``, the number of parts written; it equals that of a full build."""
    built_at = built_at or utc_now()
    as_of = as_of or built_at.date()
    bronze = bronze if bronze is not None else spark.table(sdef.bronze_table)
    runs = committed(spark, sdef.silver_table, runs_table)
    last = runs[-1] if runs else None
    reset = (rebuild or last is None or (last["parts"], last["failed_parts"]) != (parts, failed_parts)
             or as_of < last["as_of"] or (as_of != last["as_of"] and not widening))
    now = {} if reset else current_parts(runs)
    taken = set() if reset else {t for r in runs for t in r["landings"]}
    landings = {t: file for t, file in landings_of(bronze).items() if t not in taken}
    again = {} if reset or as_of == last["as_of"] else {p: run for p, (run, _) in now.items() if p >= parts}
    if not reset and not landings and as_of == last["as_of"]:
        return accounting_now(spark, sdef, runs_table) | {"touched": 0}

    fresh = bronze if reset else rows_of_landings(bronze, landings)
    meta = [c for c in bronze.columns if c.startswith("_")]
    columns = [*payload_columns(bronze), *meta]
    fresh = fresh.select(*[F.col(f"`{c}`") for c in columns])
    failed = read_parts(spark, sdef.silver_table, again)
    if failed is not None:          # what failed under the earlier date, from its payload
        fresh = fresh.unionByName(failed.select(f"{RAW}.*", *meta).select(*[F.col(f"`{c}`") for c in columns]))
    rows = checked(fresh, sdef, as_of).withColumn("_n", F.lit(1).cast("long"))
    place = part_of(rows, list(sdef.key), parts, failed_parts)
    fresh_rows = None
    if not reset:
        rows = fresh_rows = scratch_table(rows.withColumn("_part", place), "silver-new")
        touched = {r[0] for r in rows.select("_part").distinct().collect()}         # as many as there are parts
        rows = rows.drop("_part")
        old = read_parts(spark, sdef.silver_table, {p: run for p, (run, _) in now.items() if p in touched and p not in again})
        if old is not None:
            old = old.withColumn(REASONS, F.when(F.col(STATUS) == FAILED, F.col(REASONS))).withColumn("_n", F.col(COPIES))
            rows = rows.unionByName(old.select(*rows.columns))
    # by key, and the rows of a part in few tasks: they move once, and are written as they come
    out = resolved(rows, sdef, weight="_n", by_key=True, within=part_of(rows, list(sdef.key), parts, failed_parts))
    out = out.withColumn("_built_at", F.lit(built_at).cast("timestamp_ntz")) \
        .withColumn("_part", part_of(out, list(sdef.key), parts, failed_parts))
    run_id = max(time.time_ns(), last["run_id"] + 1 if last else 0)
    folder = f"{state_folder(spark, sdef.silver_table)}/_run={run_id}"
    release(spark)
    out.write.partitionBy("_part").parquet(folder)
    narrow = T.StructType([f for f in out.schema.fields if f.name in (STATUS, COPIES, "_part")])
    del out, rows
    if fresh_rows is not None:
        discard(fresh_rows)
    release(spark)
    s = F.col(STATUS)
    stored = spark.read.schema(narrow).parquet(folder)
    counts = stored.groupBy("_part").agg(
        F.sum(COPIES).alias("rows_in"), F.count_if(s == CLEAN).alias("rows_clean"), F.count_if(s != CLEAN).alias("rows_quarantined"),
        (F.sum(COPIES) - F.count(F.lit(1))).alias("rows_deduped"))
    written = {r[0]: tuple(r) for r in counts.collect()}
    for p in again:                 # a part whose failed rows all passed is empty now
        written.setdefault(p, (p, 0, 0, 0, 0))
    _commit(spark, (sdef.source, sdef.silver_table, run_id, built_at, as_of, parts, failed_parts, reset,
                    sorted(landings), [written[p] for p in sorted(written)]), runs_table)
    return accounting_now(spark, sdef, runs_table) | {"touched": len(written)}


def _commit(spark: SparkSession, row: tuple, runs_table: str) -> None:
    spark.createDataFrame([row], RUNS_SCHEMA).coalesce(1).write.mode("append").saveAsTable(runs_table)
    spark.catalog.refreshTable(runs_table)


def drop_superseded(spark: SparkSession, table: str, runs_table: str = "meta.silver_runs", keep_hours: float = 24) -> list[str]:
    """Delete the run folders that no part is read from any more and that are older than ``keep_hours``
    (also those of builds that died); returns their paths. Not while a build runs."""
    live = {run for run, _ in current_parts(committed(spark, table, runs_table)).values()}
    jvm, base = spark.sparkContext._jvm, state_folder(spark, table)
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit, gone = time.time_ns() - int(keep_hours * 3600e9), []
    for st in fs.listStatus(path) if fs.exists(path) else []:
        name = st.getPath().getName()
        if name.startswith("_run=") and int(name[5:]) <= limit and int(name[5:]) not in live:
            fs.delete(st.getPath(), True)
            gone.append(st.getPath().toString())
    return gone
