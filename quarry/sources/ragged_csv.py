"""Headerless delimited text with a fixed positional layout and ragged records.

Semantics: fields and records are split as the standard CSV dialect does (doubled quotes, quotes
inside an unquoted field, text behind a closing quote, line breaks inside quotes, an unclosed
quote that runs to the end); blank lines and records whose fields are all blank are skipped;
short records are padded with null; surplus fields are joined with commas into the last column;
fields are otherwise kept exactly as received. Exact duplicate records are kept.

Spark's CSV reader cannot express this: with an n-column schema it drops surplus fields and it
turns empty fields into null. Texts are therefore read by the standard reader, one linear pass
without recursion, in an Arrow map that Spark spreads over the input's partitions; files are
cut into ranges first (:mod:`quarry.sources.csv_ranges`), so that a large file is read by many tasks.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.csv_ranges import BATCH_RECORDS, CHUNK_BYTES, fit_record, read_ranges

# worker code is shipped by value: executors need nothing installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def ragged_records(text: str, n: int):
    """The records of a text as ``n`` fields each, blank ones skipped."""
    for fields in csv.reader(io.StringIO(text, newline="")):
        record = fit_record(fields, n)
        if record:
            yield record


def parse_ragged_lines(lines: DataFrame, columns: Sequence[str], line_col: str = "value",
                       keep: Sequence[str] = ()) -> DataFrame:
    """Parse a column of texts (lines or whole files) into ``columns`` with the ragged-record
    rules; ``keep`` columns are repeated for every record. A null text has no records."""
    n, names = len(columns), [*keep, *columns]
    kept = lines.select(*[F.col(f"`{c}`") for c in keep], F.col(line_col).cast("string").alias("_text"))
    schema = T.StructType([*kept.schema.fields[:-1], *[T.StructField(c, T.StringType()) for c in columns]])

    def parse(batches):
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            rows, records = [], []

            def out():
                fields = zip(*records) if records else [[]] * n
                return pa.RecordBatch.from_arrays(
                    [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(len(keep))]
                    + [pa.array(list(f), pa.string()) for f in fields], names=names)

            for i, text in enumerate(batch.column(len(keep)).to_pylist()):
                for record in ragged_records(text or "", n):
                    rows.append(i)
                    records.append(record)
                    if len(records) >= BATCH_RECORDS:
                        yield out()
                        rows, records = [], []
            yield out()

    return kept.mapInArrow(parse, schema)


def read_ragged_csv(spark: SparkSession, path, columns: Sequence[str], multi_line: bool = True,
                    chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Read headerless CSV file(s) at ``path`` (a path or a list) into the positional ``columns``.

    A quoted field may hold line breaks. Where it is known that none does, ``multi_line=False`` reads line
    by line and saves writing the chunks (an unclosed quote then ends with its line).
    """
    if multi_line:
        return read_ranges(spark, path, columns, chunk_bytes)
    return parse_ragged_lines(spark.read.text(path), columns)
