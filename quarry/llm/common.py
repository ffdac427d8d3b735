"""Helpers shared by the operators: scratch tables, row-wise Arrow maps, file locations."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.session import discard, ensure_checkpoint_dir, release  # noqa: F401 - discard and release for the operators

#: Texts are handed to a row-wise function in pieces of about this many bytes, so that a batch
#: of very long texts needs no more memory than a batch of short ones (one text is never cut).
PIECE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives a lost
    executor, and gives the optimizer the real size."""
    path, spark, schema = scratch_path(df.sparkSession, name), df.sparkSession, df.schema
    release(spark)              # what the step before this one has shuffled
    df.write.option("compression", compression).parquet(path)
    del df
    release(spark)
    out = spark.read.schema(schema).parquet(path)
    out._scratch = path
    return out


def vocabulary_path(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file; ``folder`` overrides the installed package."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(batch: pa.RecordBatch, column: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts (in ``column``) have about ``limit`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


class Remembered:
    """A bounded table of computed values in two generations: when the young one is full it becomes
    the old one, and what is met again moves over, so frequent keys stay. The bound costs time
    only: a forgotten key is computed anew."""

    def __init__(self, compute, limit: int):
        self.compute, self.limit, self.young, self.old = compute, limit, {}, {}

    def know(self, keys: set) -> dict:
        """The young generation, with all of ``keys`` in it until the next call."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        new = keys.difference(self.young)
        if self.old:
            again = new.intersection(self.old)
            old = self.old
            self.young.update((k, old[k]) for k in again)
            new -= again
        if new:
            new = list(new)
            self.young.update(zip(new, self.compute(new)))
        return self.young


def annotate(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]],
             make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """``df`` as the struct ``row`` plus new columns computed from its ``text`` column.

    ``make()`` is called once a task; what it returns takes a list of texts (None for null) and
    gives one list or array for each of ``fields``. The input columns stay inside ``row``, so
    the new names cannot clash with them.
    """
    kept = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"),
                     df[f"`{text}`"].cast("string").alias("text"))
    row_type = kept.schema["row"].dataType
    schema = T.StructType([T.StructField("row", row_type, True)]
                          + [T.StructField(n, t, True) for n, t in fields])
    arrow_types = [to_arrow_type(t) for _, t in fields]

    def run(batches):
        fn = make()
        for batch in batches:
            for piece in pieces(batch, 1):
                columns = fn(piece.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *[c if isinstance(c, pa.Array) else pa.array(c, t)
                                        for c, t in zip(columns, arrow_types)]],
                    names=["row", *[n for n, _ in fields]])

    return kept.mapInArrow(run, schema)
