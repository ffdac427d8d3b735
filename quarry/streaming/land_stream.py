"""Incremental landing: a Structured Streaming file source feeding the idempotent lander.

New files under ``path`` are picked up once (the stream's checkpoint records which files
were processed) and each micro-batch is landed with :func:`quarry.operators.landing.land`.
Because landing skips hashes already present, a replayed micro-batch after a failure
inserts nothing twice; and as each micro-batch is logged under its number and its stream's checkpoint,
a replay of one that was landed and logged adds no second log row. ``availableNow`` processes what is there and stops, which suits
scheduled runs; the checkpoint must live on shared storage.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.landing import land, logged_batch


def land_stream(spark: SparkSession, path: str, schema: str, source: str, table: str,
                checkpoint: str, fmt: str = "csv", options: dict | None = None,
                log_table: str = "meta.ingestion_log", available_now: bool = True,
                transform: Callable[[DataFrame], DataFrame] | None = None,
                read_files: Callable[[SparkSession, list], DataFrame] | None = None, max_files: int = 1000):
    """Start (and, with ``available_now``, finish) a stream landing files into ``table``.

    ``checkpoint`` is the stream's own lasting folder: it knows which files have been read.

    ``transform`` is applied to each micro-batch before landing, e.g. reading raw lines
    (``fmt="text"``, ``schema="value string"``) and parsing them with
    :func:`quarry.sources.parse_ragged_lines`, which keeps overflow fields and empty fields
    that a CSV reader would lose.

    With ``read_files`` the stream tells only which files are new, at most ``max_files`` a batch, and that
    function reads them: the same reader as for a batch job, e.g.
    :func:`quarry.sources.read_ragged_csv`, whose records may span lines.
    """
    if read_files:
        fmt, schema = "binaryFile", "path string, modificationTime timestamp, length long, content binary"
        options = {"maxFilesPerTrigger": max_files} | (options or {})
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(path)
    if read_files:
        stream = stream.select("path")          # the content is not read here

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        session, key = batch.sparkSession, f"batch {batch_id} of {checkpoint}"
        if logged_batch(session, table, key, log_table):
            return
        if read_files:
            rows = read_files(session, [r["path"] for r in batch.collect()])
        else:
            rows = transform(batch) if transform else batch
        land(session, rows.select(*[F.col(f"`{c}`") for c in rows.columns]), source, table, log_table=log_table,
             batch_key=key)

    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
        # batches were written through the stream's own session: drop this session's
        # cached file listing of the table
        if spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)
    return query
