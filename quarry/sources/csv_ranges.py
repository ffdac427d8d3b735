"""Delimited files of any size, cut into ranges, whose quoted fields may hold line breaks.

Whether a line starts a record depends on all quotes before it, so a file cannot simply be cut at
line breaks. Spark reads the file by lines, in as many splits as it likes, and lines are joined
into chunks. A chunk is scanned for both states that it can begin in (between records, or inside
a quoted field) and keeps a summary of a few bits: the state that each leads to, and whether the record
it began in ends in it. Chunks are written to the shared folder with their summaries. A running
composition over the narrow summaries of a file then tells the state that every chunk really begins
in: what the last chunk with a fixed outcome says, turned once for each chunk since that swaps the
two states. Each chunk is parsed from its first record on; a record that crosses chunks is put
together from its fragments. No task ever holds more than one chunk, one line or one record.

The text source takes the byte order mark and the last line break of a file away; the file's size
tells whether they were there (they belong to the first field, and to a field whose quote is never closed).
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Text of a chunk, about (a longer line is a chunk of its own).
CHUNK_BYTES = 8 << 20
#: Records handed on at a time.
BATCH_RECORDS = 4096
MARK = "﻿"


def split_records(lines: list[str]):
    """(first line, fields) of every record; the last may be (first line, None): left open."""
    csv.field_size_limit(sys.maxsize)
    ended = False

    def feed():
        nonlocal ended
        yield from lines
        ended = True

    reader, at = csv.reader(feed()), 0
    for fields in reader:
        if ended:           # it asked for another line to go on
            yield at, None
            return
        yield at, fields
        at = reader.line_num


def lines_of(text: str) -> list[str]:
    return list(io.StringIO(text, newline=""))


def outcome(lines: list[str]) -> tuple[bool, bool]:
    """Whether text that begins between records leaves one open, and whether any record ends in it."""
    last = None
    closes = False
    for _, last in split_records(lines):
        closes = closes or last is not None
    return bool(lines) and last is None, closes


def summary(text: str) -> tuple[bool, bool, bool]:
    """(open at the end if it begins between records, the same if it begins inside quotes, whether in that
    case the record it began in ends in it)."""
    if '"' not in text:
        return False, True, False
    lines = lines_of(text)
    return (outcome(lines)[0], *outcome(['"' + lines[0], *lines[1:]]))


def cut(text: str, inside: bool) -> tuple[str | None, list[list[str]], str | None]:
    """(end of the record it began in, whole records, begin of the record left open) of a chunk; the first
    is the whole text if that record does not end here."""
    lines, head = lines_of(text), None
    if inside:
        first = next(split_records(['"' + lines[0], *lines[1:]]), (0, None))
        if first[1] is None:
            return text, [], None
        rest = iter(split_records(['"' + lines[0], *lines[1:]]))
        next(rest)
        start = next(rest, (len(lines), None))[0]
        head, lines = "".join(lines[:start]), lines[start:]
    records, tail = [], None
    for at, fields in split_records(lines):
        if fields is None:
            tail = "".join(lines[at:])
        else:
            records.append(fields)
    return head, records, tail


def fit_record(fields: list[str], n: int) -> list[str | None] | None:
    """A record as ``n`` fields: short ones padded, surplus folded into the last; None if all are blank."""
    if not any(f.strip() for f in fields):
        return None
    if len(fields) > n:
        fields = [*fields[:n - 1], ",".join(fields[n - 1:])]
    return fields + [None] * (n - len(fields))


PLACE = "path string, start long, chunk int"


def chunk_table(spark: SparkSession, path, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The files at ``path`` as chunks (path, start of the split, number in it, file size, bytes, summary, text),
    written to the shared folder: later steps see the same chunks however Spark splits files then."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line"))
    schema = PLACE + ", size long, bytes long, open0 boolean, open1 boolean, closes1 boolean, text string"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        place, number, held, total = None, 0, [], 0

        def chunk():
            text = "".join([x.decode(errors="replace") + "\n" for x in held])
            values = (place[0], place[1], number, place[2], total, *summary(text), text)
            types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *where, line in zip(*columns):
                if where != place or total >= chunk_bytes:
                    if held:
                        yield chunk()
                    number = number + 1 if where == place else 0
                    place, held, total = where, [], 0
                held.append(line)
                total += len(line) + 1
        if held:
            yield chunk()

    return scratch_table(lines.mapInArrow(run, schema), "csv-chunks")


def chunk_states(chunks: DataFrame) -> DataFrame:
    """For every chunk: ``inside`` (it begins in a quoted field), ``open`` (it leaves a record open), ``opens``
    (that record begins in it), ``span`` (start and number of the chunk in which the record it begins in
    began), ``bom`` and ``unended`` (the file began with a byte order mark, its last line has no line break).
    Narrow rows alone are sorted, per file."""
    order = Window.partitionBy("path").orderBy("start", "chunk")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    here = F.struct("start", "chunk")
    rows = chunks.drop("text")
    rows = rows.withColumn("turns", F.coalesce(F.sum((F.col("open0") & ~F.col("open1")).cast("int")).over(before), F.lit(0)))
    fixed = F.last(F.when(F.col("open0") == F.col("open1"), F.struct("open0", "turns")), ignorenulls=True).over(before)
    rows = rows.withColumn("fixed", fixed)
    state = F.coalesce(F.col("fixed.open0").cast("int"), F.lit(0)) + F.col("turns") - F.coalesce("fixed.turns", F.lit(0))
    rows = rows.withColumn("inside", F.pmod(state, F.lit(2)) == 1)
    rows = rows.withColumn("open", F.when(F.col("inside"), F.col("open1")).otherwise(F.col("open0")))
    rows = rows.withColumn("opens", F.col("open") & (~F.col("inside") | F.col("closes1")))
    missing = F.col("size") - F.sum("bytes").over(whole)
    first, last = here == F.min(here).over(whole), here == F.max(here).over(whole)
    return rows.select("path", "start", "chunk", "inside", "open", "opens",
                       F.last(F.when(F.col("opens"), here), ignorenulls=True).over(before).alias("span"),
                       (first & missing.isin(2, 3)).alias("bom"), (last & missing.isin(-1, 2)).alias("unended"))


def _whole_text(text: str, bom: bool, unended: bool) -> str:
    return (MARK if bom else "") + (text[:-1] if unended else text)


def read_ranges(spark: SparkSession, path, columns: Sequence[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The records of headerless CSV file(s) at ``path`` (a path or a list) in the positional ``columns``."""
    return parse_chunks(chunk_table(spark, path, chunk_bytes), columns)


def parse_chunks(chunks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The records of all files of a :func:`chunk_table`."""
    n = len(columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    placed = chunks.select("path", "start", "chunk", "text").join(chunk_states(chunks), ["path", "start", "chunk"])

    def out(records):
        return pa.RecordBatch.from_arrays([pa.array(list(f), pa.string()) for f in (zip(*records) if records else [[]] * n)],
                                          names=list(columns))

    def inner(batches):
        for batch in batches:
            for text, inside, bom, unended in zip(*[c.to_pylist() for c in batch.columns]):
                _, records, tail = cut(_whole_text(text, bom, unended), inside)
                kept = [r for r in (fit_record(f, n) for f in records) if r]
                for i in range(0, len(kept), BATCH_RECORDS):
                    yield out(kept[i:i + BATCH_RECORDS])

    def fragments(batches):
        for batch in batches:
            found = []
            for text, inside, bom, unended, span, own, opens, path in zip(*[c.to_pylist() for c in batch.columns]):
                head, _, tail = cut(_whole_text(text, bom, unended), inside)
                if inside and span is not None:
                    found.append((path, span, own, head))
                if opens:
                    found.append((path, own, own, tail))
            place = pa.struct([("start", pa.int64()), ("chunk", pa.int32())])
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(
                (pa.string(), place, place, pa.string()))], names=["path", "span", "own", "part"])

    def spanning(batches):
        for batch in batches:
            records = []
            for text in batch.column(0).to_pylist():
                csv.field_size_limit(sys.maxsize)
                records += [r for r in (fit_record(f, n) for f in csv.reader(io.StringIO(text, newline=""))) if r]
            yield out(records)

    whole = placed.select("text", "inside", "bom", "unended").mapInArrow(inner, schema)
    here = F.struct("start", "chunk").alias("own")
    crossing = placed.filter(F.col("inside") | F.col("open")).select("text", "inside", "bom", "unended", "span", here, "opens", "path")
    place_type = "struct<start:long,chunk:int>"
    parts = crossing.mapInArrow(fragments, f"path string, span {place_type}, own {place_type}, part string")
    joined = parts.groupBy("path", "span").agg(F.array_sort(F.collect_list(F.struct("own", "part"))).alias("parts")) \
        .select(F.array_join(F.col("parts.part"), "").alias("text"))
    return whole.unionByName(joined.mapInArrow(spanning, schema))
