"""SentencePiece encoding and decoding with a distinct-chunk table (operator 5).

No piece of the model crosses a white-space marker (proved on the vocabulary first), so a text
is cut before every run of markers, each distinct marked word is segmented once, and the ids
are joined back by position. The table of distinct words belongs to a task and is bounded
(:data:`quarry.llm.marked.CACHE_ENTRIES`): of its two generations the older goes, which costs time only.
Decoding calls the library on the joined ids.

Defined results: null counts as empty; an empty text has no ids and decodes to the empty text;
rows are handled one by one, so repeated rows agree and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import marked
from quarry.llm.common import annotate, read_table, vocabulary_path

MODEL = "piece_bpe_32k.model"


def encode_documents(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` as struct ``row`` with ``ids`` (array of int) and ``decoded`` (string)."""
    return _mapped(docs, text, path, [("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())],
                   lambda ids, decoded: (ids, decoded))


def _digest(ids: list[int], decoded: str):
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def _mapped(docs, text, path, fields, result):
    path = path or vocabulary_path(MODEL)
    marked.check_model(marked.load(path))

    def make():
        table = marked.ChunkTable(path, tuple)

        def fn(texts):
            keys = [marked.chunks(t or "") for t in texts]
            ids_of = table.values(keys)
            rows = []
            for k in keys:
                ids = list(chain.from_iterable(map(ids_of, k)))
                rows.append(result(ids, table.sp.decode(ids) if ids else ""))
            return list(zip(*rows)) if rows else [[] for _ in fields]
        return fn

    return annotate(docs, text, fields, make)


def digests(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` as struct ``row`` with the number of ids and the digests of ids and decoded text,
    taken where the ids are, so that no id leaves its task."""
    return _mapped(docs, text, path, [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()),
                                      ("decoded_sha256", T.StringType())], _digest)


def encode_stage(docs: DataFrame) -> DataFrame:
    """Pipeline stage: doc_id with ids and digests of every document."""
    return digests(docs).select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op5_sentencepiece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: number and digest of ids, digest of the decoded text."""
    return encode_stage(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
