"""Paged JSON documents of any size: ``[page_meta, [record, ...]]`` cut into records without holding a document.

Spark reads a file in splits at every ``}``, and the pieces are joined into chunks. What a bracket means depends
on all text before it, but only through two things: whether it lies in a string, and how deep. A chunk's
number of quotes that no backslash escapes tells whether it turns the first; for either case it knows by
how much it changes the second. Running sums over these narrow summaries of a file give every chunk its true
start. Then each chunk is cut where a member of the list at depth two begins and ends, members that cross
chunks are put together from their fragments, and each is parsed on its own.

Defined results: members of the list that are objects give a row each, other members none; a document that is no
list, or whose second member is no list (null, an error envelope, missing), gives none. A document is
taken to be valid JSON; of one that is not, the members that can be read are.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import scratch_table
from quarry.sources.paged_json import record_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a chunk, about (text without any ``}`` is one piece, however long).
CHUNK_BYTES = 8 << 20
#: Bytes of text after which a task hands on what it has found.
BATCH_BYTES = 4 << 20
QUOTE, BACKSLASH, COMMA = b'"'[0], b"\\"[0], b","[0]


def _is(data: np.ndarray, letters: bytes) -> np.ndarray:
    return np.isin(data, np.frombuffer(letters, np.uint8))


def quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that no backslash escapes (text begins behind a ``}``, so unescaped)."""
    slash = data == BACKSLASH
    found = data == QUOTE
    if slash.any():
        at = np.arange(len(data))
        run = at - np.maximum.accumulate(np.where(slash, -1, at))       # backslashes in a row up to here
        found[1:] &= ~(slash[:-1] & (run[:-1] % 2 == 1))
    return found


def steps(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """(change of depth at every byte, which bytes lie outside strings)."""
    mark = quotes(data)
    outside = (np.cumsum(mark) - mark + inside) % 2 == 0
    change = _is(data, b"[{").astype(np.int64) - _is(data, b"]}")
    return np.where(outside, change, 0), outside


def summary(data: np.ndarray) -> tuple[bool, int, int]:
    """(whether it turns the string state, change of depth if it begins outside a string, the same inside)."""
    return bool(quotes(data).sum() % 2), int(steps(data, False)[0].sum()), int(steps(data, True)[0].sum())


def cut(raw: bytes, inside: bool, depth: int):
    """Of a chunk that begins in this state: (openings, members, commas). Openings of the root and of its members:
    (root's commas before, depth behind, bracket). Members of the lists at depth two: (root's commas before, text,
    whether it begins here, whether it ends here). Commas: those of the root in the whole chunk."""
    data = np.frombuffer(raw, np.uint8)
    change, outside = steps(data, inside)
    deep = depth + np.cumsum(change)
    comma = (data == COMMA) & outside & (deep == 1)
    before = np.cumsum(comma)
    openings = [(int(before[i]), int(deep[i]), chr(data[i])) for i in np.flatnonzero((change > 0) & (deep <= 2))]
    begins = np.flatnonzero((change > 0) & (deep == 3)).tolist()
    ends = np.flatnonzero((change < 0) & (deep == 2)).tolist()
    members = []
    if depth >= 3:
        end = ends.pop(0) + 1 if ends else len(data)
        members.append((int(before[end - 1]) if end else 0, raw[:end], False, end < len(data) or int(deep[-1]) == 2))
    for k, start in enumerate(begins):
        end = ends[k] + 1 if k < len(ends) else len(data)
        members.append((int(before[start]), raw[start:end], True, k < len(ends)))
    return openings, members, int(comma.sum())


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def chunk_table(spark: SparkSession, path, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The files at ``path`` as chunks with their summaries, written to the shared folder."""
    rows = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece"))
    schema = "path string, start long, chunk int, size long, bytes long, turns boolean, change0 long, change1 long, text binary"
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        place, number, held, total = None, 0, [], 0
        found, found_bytes = [], 0

        def chunk():
            text = b"}".join(held) + b"}"
            return (place[0], place[1], number, place[2], total, *summary(np.frombuffer(text, np.uint8)), text)

        for batch in batches:
            for *where, piece in zip(*[c.to_pylist() for c in batch.columns]):
                if where != place or total >= chunk_bytes:
                    if held:
                        found.append(chunk())
                        found_bytes += total
                    if found_bytes >= BATCH_BYTES:
                        yield _batch(found, names, types)
                        found, found_bytes = [], 0
                    number = number + 1 if where == place else 0
                    place, held, total = where, [], 0
                held.append(piece)
                total += len(piece) + 1
        if held:
            found.append(chunk())
        if found:
            yield _batch(found, names, types)

    return scratch_table(rows.mapInArrow(run, schema), "json-chunks")


def chunk_states(chunks: DataFrame) -> DataFrame:
    """Every chunk's start: ``inside`` a string, ``depth``; and ``unended``: it is the last of a file that does
    not end in ``}``, which the reader has put there."""
    order = Window.partitionBy("path").orderBy("start", "chunk")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    here = F.struct("start", "chunk")
    rows = chunks.drop("text").withColumn("inside", F.coalesce(F.sum(F.col("turns").cast("int")).over(before), F.lit(0)) % 2 == 1)
    rows = rows.withColumn("change", F.when(F.col("inside"), F.col("change1")).otherwise(F.col("change0")))
    missing = F.col("size") - F.sum("bytes").over(whole)
    return rows.select("path", "start", "chunk", "inside", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
                       ((here == F.max(here).over(whole)) & missing.isin(-1, 2)).alias("unended"))


PIECE = ("path string, start long, chunk int, seq int, kind string, commas long, deep int, text string, begins boolean, ends boolean")


def _pieces(chunks: DataFrame) -> DataFrame:
    """What :func:`cut` finds in all chunks: kinds ``open``, ``member`` and, one a chunk, ``total``."""
    placed = chunks.select("path", "start", "chunk", "text").join(chunk_states(chunks), ["path", "start", "chunk"]) \
        .select("path", "start", "chunk", "text", "inside", "depth", "unended")
    types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]

    names = [c.split()[0] for c in PIECE.split(", ")]

    def run(batches):
        for batch in batches:
            found, found_bytes = [], 0
            for i in range(batch.num_rows):
                path, start, chunk, text, inside, depth, unended = [c[i].as_py() for c in batch.columns]
                openings, members, commas = cut(text[:-1] if unended else text, inside, depth)
                rows = [("open", c, deep, letter, None, None) for c, deep, letter in openings]
                rows += [("member", c, None, t.decode(errors="replace"), b, e) for c, t, b, e in members]
                rows.append(("total", commas, None, None, None, None))
                found += [(path, start, chunk, seq, *row) for seq, row in enumerate(rows)]
                found_bytes += len(text)
                if found_bytes >= BATCH_BYTES:
                    yield _batch(found, names, types)
                    found, found_bytes = [], 0
            if found:
                yield _batch(found, names, types)

    return placed.mapInArrow(run, PIECE)


def records_of(chunks: DataFrame) -> DataFrame:
    """(path, record): the text of every object in the second member of every document of a :func:`chunk_table`."""
    pieces = scratch_table(_pieces(chunks), "json-pieces")
    order = Window.partitionBy("path").orderBy("start", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = pieces.filter("kind = 'total'").select("path", "start", "chunk", F.coalesce(F.sum("commas").over(order), F.lit(0)).alias("passed"))
    numbered = pieces.join(first, ["path", "start", "chunk"]).withColumn("element", F.col("passed") + F.col("commas"))
    lists = numbered.filter("kind = 'open'").groupBy("path").agg(
        F.bool_or((F.col("deep") == 1) & (F.col("text") == "[")).alias("root"),
        F.bool_or((F.col("deep") == 2) & (F.col("text") == "[") & (F.col("element") == 1)).alias("list")) \
        .filter("root and list").select("path")
    members = numbered.filter("kind = 'member' and element = 1").join(lists, "path", "left_semi")
    whole = members.filter("begins and ends").select("path", F.col("text").alias("record"))
    # fragments: the begin that a chunk leaves open names the member for all that follow it until its end
    at = Window.partitionBy("path").orderBy("start", "chunk", "seq")
    parts = members.filter("not (begins and ends)").withColumn("member", F.count_if("begins").over(at))
    joined = parts.groupBy("path", "member").agg(F.array_sort(F.collect_list(F.struct("start", "chunk", "seq", "text"))).alias("parts")) \
        .select("path", F.array_join(F.col("parts.text"), "").alias("record"))
    return whole.unionByName(joined).filter(F.col("record").startswith("{"))


def read_paged_ranges(spark: SparkSession, path, fields: Mapping[str, str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The records of the documents at ``path`` (one a file), ``fields`` as in
    :func:`quarry.sources.paged_json.flatten_paged_json`."""
    rows = records_of(chunk_table(spark, path, chunk_bytes)).select(F.from_json("record", record_schema(fields)).alias("_rec"))
    return rows.select(*[F.col("_rec." + ".".join(f"`{p}`" for p in path.split("."))).alias(c) for c, path in fields.items()])
