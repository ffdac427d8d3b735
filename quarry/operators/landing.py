"""Idempotent landing by content hash (bronze).

Rows land exactly as received: every source column as text, plus ``_source``,
``_ingested_at`` and ``_source_row_hash`` (sha256 of the U+001F-joined fields, null as "").
In-batch exact repeats collapse to one row and rows whose hash is already in the target are
skipped, so a rerun inserts nothing; ``skipped = received - inserted`` counts both kinds.

Scale notes: the in-batch de-duplication is an aggregate (partial aggregation before the
shuffle, so a hot group of copies is combined map-side). The target is bucketed on the
hash, so the anti-join reads it without an exchange and only the incoming batch is
shuffled into the matching buckets. Counts come from ``observe`` in the result stage of the
single write job: the batch is read once and the counts are exact under task retries.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scalar import row_hash
from quarry.operators.hash_index import seen_hashes
from quarry.session import discard, release, scratch_table

HASH = "_source_row_hash"
META_COLUMNS = ["_source", "_ingested_at", HASH]
#: Buckets of a new bronze table unless its creator says otherwise; a compaction can change them.
BUCKETS = 64

INGESTION_LOG_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("target_table", T.StringType(), False),
    T.StructField("started_at", T.TimestampNTZType(), False),
    T.StructField("rows_received", T.LongType(), False),
    T.StructField("rows_inserted", T.LongType(), False),
    T.StructField("rows_skipped", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("detail", T.StringType(), True),
])


@dataclass(frozen=True)
class LandingResult:
    source: str
    target_table: str
    rows_received: int
    rows_inserted: int
    rows_skipped: int


def utc_now() -> dt.datetime:
    """Current UTC instant without zone, taken once on the driver per run."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to string, names and order kept."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def payload_columns(df: DataFrame) -> list[str]:
    """Source columns only (metadata columns start with ``_``)."""
    return [c for c in df.columns if not c.startswith("_")]


def landing_payload(df: DataFrame, source: str, ingested_at, null_token: str = "") -> DataFrame:
    """The batch as it would be landed: text columns + metadata + content hash."""
    cols = df.columns
    return as_text(df).select(
        *[F.col(f"`{c}`") for c in cols],
        F.lit(source).alias("_source"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingested_at"),
        row_hash([F.col(f"`{c}`") for c in cols], null_token).alias(HASH),
    )


def only_new(batch: DataFrame, target: DataFrame, key: str = HASH) -> DataFrame:
    """Rows of ``batch`` whose ``key`` does not occur in ``target`` (NOT EXISTS)."""
    return batch.join(target.select(key), on=key, how="left_anti")


def new_rows(df: DataFrame, source: str, ingested_at, target: DataFrame | None = None,
             null_token: str = "") -> DataFrame:
    """Distinct-by-hash payload minus hashes already landed in ``target``."""
    payload = landing_payload(df, source, ingested_at, null_token).dropDuplicates([HASH])
    return payload if target is None else only_new(payload, target)


def landing_counts(df: DataFrame, source: str, ingested_at, target: DataFrame | None = None) -> DataFrame:
    """One row ``rows_received, rows_inserted, rows_skipped`` computed without writing.

    A single aggregation: each incoming row is marked seen/unseen by a left join on the
    hash (target hashes are unique), then unseen distinct hashes are counted.
    """
    payload = landing_payload(df, source, ingested_at)
    if target is not None:
        seen = target.select(HASH, F.lit(True).alias("_seen"))
        payload = payload.join(seen, on=HASH, how="left")
    else:
        payload = payload.withColumn("_seen", F.lit(None).cast("boolean"))
    counts = payload.agg(
        F.count(F.lit(1)).alias("rows_received"),
        F.count_distinct(F.when(F.col("_seen").isNull(), F.col(HASH))).alias("rows_inserted"))
    return counts.select("rows_received", "rows_inserted",
                         (F.col("rows_received") - F.col("rows_inserted")).alias("rows_skipped"))


def _log(spark: SparkSession, rows: list[tuple], log_table: str) -> None:
    spark.createDataFrame(rows, INGESTION_LOG_SCHEMA).write.mode("append").saveAsTable(log_table)
    spark.catalog.refreshTable(log_table)


def land(spark: SparkSession, df: DataFrame, source: str, table: str,
         started_at: dt.datetime | None = None, log_table: str = "meta.ingestion_log",
         buckets: int = BUCKETS, batch_key: str | None = None, indexed: bool = False) -> LandingResult:
    """Append unseen rows of ``df`` to ``table`` and record the run in the ingestion log.

    One job: rows are grouped by hash (copies counted), marked seen/unseen against the
    target's hashes, counted, and the unseen groups are written. Both counts are observed
    after the last shuffle, i.e. in the result stage, where Spark applies each task's
    metric update exactly once even when tasks or executors are lost and work is redone.
    One lander per table at a time (as with any plain Parquet table there is no transaction
    between concurrent appenders); a replayed batch inserts nothing. A batch with a ``batch_key`` is
    logged under it (as the detail) and not landed, or logged, again once that row is there.

    With ``indexed`` the target's hashes are not read through: an index beside the table tells which
    files may hold a hash of the batch (:mod:`quarry.operators.hash_index`), so that a small batch into a
    very large table reads little of it. The result is the same.
    """
    started_at = started_at or utc_now()
    done = logged_batch(spark, table, batch_key, log_table) if batch_key else None
    if done:
        return done
    counts = Observation("landing")
    payload = landing_payload(df, source, started_at)
    cols = payload.columns
    exists = spark.catalog.tableExists(table)
    if indexed:
        payload = scratch_table(payload, "landing-batch")       # read twice: its hashes, then its rows
    if exists:
        target = spark.table(table)
        expected = [c for c in target.columns if c not in META_COLUMNS]
        if expected != df.columns:
            raise ValueError(f"{table}: incoming columns {df.columns} differ from {expected}")
    groups = payload.groupBy(HASH).agg(*[F.first(F.col(f"`{c}`")).alias(c) for c in cols if c != HASH],
                                       F.count(F.lit(1)).alias("_n"))
    if exists:
        if indexed:
            held = seen_hashes(spark, table, payload.select(HASH).distinct(), table_buckets(spark, table))
        else:
            held = target.select(HASH)
        marked = groups.join(held.select(HASH, F.lit(True).alias("_seen")), on=HASH, how="left")
    else:
        marked = groups.withColumn("_seen", F.lit(None).cast("boolean"))
    observed = marked.observe(counts, F.coalesce(F.sum("_n"), F.lit(0)).alias("received"),
                              F.count_if(F.col("_seen").isNull()).alias("inserted"))
    batch = observed.filter(F.col("_seen").isNull()).select(*[F.col(f"`{c}`") for c in cols])
    # the exchange of the grouping deals rows out by bucket: it serves the join with the bucketed
    # target and the write as well, and a landing adds one file to a bucket
    with shuffled_into(df.sparkSession, table_buckets(spark, table) if exists else buckets):
        if exists:
            batch.select(*target.columns).write.insertInto(table)
        else:
            # an external table at a versioned folder, so a later compaction can re-point it
            (batch.write.format("parquet").bucketBy(buckets, HASH).sortBy(HASH)
             .option("path", _version_path(spark, table)).saveAsTable(table))
    spark.catalog.refreshTable(table)
    if indexed:
        discard(payload)
    del groups, marked, observed, batch
    release(spark)                                      # what this landing has shuffled
    got = counts.get
    received, inserted = int(got.get("received") or 0), int(got.get("inserted") or 0)
    result = LandingResult(source, table, received, inserted, received - inserted)
    _log(spark, [(source, table, started_at, received, inserted, received - inserted, "ok", batch_key)],
         log_table)
    return result


def logged_batch(spark: SparkSession, table: str, batch_key: str, log_table: str = "meta.ingestion_log") -> LandingResult | None:
    """What the log says of a batch that has been landed under ``batch_key``."""
    if not spark.catalog.tableExists(log_table):
        return None
    rows = spark.table(log_table).filter((F.col("target_table") == table) & (F.col("detail") == batch_key) & (F.col("status") == "ok"))
    r = rows.first()
    return LandingResult(r["source"], table, r["rows_received"], r["rows_inserted"], r["rows_skipped"]) if r else None


@contextlib.contextmanager
def shuffled_into(spark: SparkSession, n: int):
    """Exchanges planned inside have ``n`` partitions (the session's setting is put back)."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, n)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _version_path(spark: SparkSession, table: str) -> str:
    import time
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/quarry_versions/" + table.replace(".", "/")
    return f"{base}/v{time.time_ns()}"


def table_buckets(spark: SparkSession, table: str) -> int:
    """The bucket count of a bronze table; fails for a table without buckets."""
    spec = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    n = int(spec.get("Num Buckets", "0") or 0)
    if not n:
        raise ValueError(f"{table} is not a bucketed bronze table")
    return n


def compact_bronze(spark: SparkSession, table: str, buckets: int | None = None, keep_hours: float = 24) -> str:
    """Rewrite a bronze table into ``buckets`` (default: as many as it has) at a new version folder
    and re-point it.

    Every landing adds a file to each bucket; compaction bounds the file count, and a table that
    has outgrown its buckets gets more. Version folders older than ``keep_hours`` are deleted.
    Landers must not run during a compaction.
    """
    from quarry.plans.silver import prune_versions
    old = table_buckets(spark, table)
    n = buckets or old
    loc = _version_path(spark, table)
    tmp = f"{table}__compacting"
    spark.sql(f"DROP TABLE IF EXISTS {tmp}")
    (spark.table(table).repartition(n, HASH).write.format("parquet").bucketBy(n, HASH).sortBy(HASH)
     .option("path", loc).saveAsTable(tmp))
    if n == old:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{loc}'")
        spark.sql(f"DROP TABLE {tmp}")                    # external: its files stay
    else:                                                 # the bucket count belongs to the table
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {tmp} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    prune_versions(spark, loc, keep_hours)
    return loc


def log_failure(spark: SparkSession, source: str, table: str, error: str,
                log_table: str = "meta.ingestion_log", at: dt.datetime | None = None) -> None:
    """Record a failed extraction: zero counts, the whole message."""
    _log(spark, [(source, table, at or utc_now(), 0, 0, 0, "error", error)], log_table)
