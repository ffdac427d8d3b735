"""Session setup shared by jobs, tests and the benchmark."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job relies on: UTC clock, ANSI arithmetic, adaptive execution with
#: skew-join splitting, and a size-checked automatic broadcast (AQE re-checks the
#: runtime size of each join side before choosing a broadcast).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.parquet.compression.codec": "zstd",       # half of a row is its hash in hex digits, which snappy keeps as they are
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with :data:`BASE_CONF` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of :data:`BASE_CONF` to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the operator and must be shared storage;
    it is only invented here (under the local temp folder) when nothing is set, which
    is the case for unit tests and local runs.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder: executors can be lost and "
                             "checkpoints must outlive them")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder below the shared checkpoint folder, and read back: later steps
    see the same rows whatever happens to executors, and read only the columns they use."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the scratch folders of these frames, when no plan reads them any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner find plans that nobody holds any more: their shuffle files go at once,
    not when the driver next happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ensure_warehouse(spark: SparkSession) -> str:
    """The warehouse folder; on a cluster it must have been set, as Spark's default is a folder of
    one machine."""
    path = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and not spark.sparkContext.getConf().contains(
            "spark.sql.warehouse.dir"):
        raise ValueError("set spark.sql.warehouse.dir to a shared folder: tables must outlive the machine")
    return path


def ensure_databases(spark: SparkSession, names=("bronze", "silver", "gold", "meta")) -> None:
    """Create the layer namespaces when absent."""
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}")


def estimated_bytes(df) -> int | None:
    """The optimizer's size estimate of a plan (the statistic Spark itself compares with
    ``spark.sql.autoBroadcastJoinThreshold``); None when no estimate is available."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - e.g. a remote session without a JVM handle
        return None

