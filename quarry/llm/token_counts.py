"""Token counts with a whole-token shortcut (operator 4).

Offline, on the driver, every vocabulary string that the tokenizer provably encodes alone as
one token is collected (bounded by the vocabulary). A text is then cut into its pre-tokens (the
marked words of :mod:`quarry.llm.marked`): those in the proven set count as one token without
any merging; only the rest is merged, each distinct one once.

Defined results: a null text counts as empty, an empty text has 0 tokens; rows are counted one
by one (repeated rows alike, empty table no rows); a text of any length is counted whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import marked
from quarry.llm.common import annotate, read_table, vocabulary_path

MODEL = "piece_bpe_32k.model"
LIMIT = 4096


def proven_whole_tokens(path: str) -> list[str]:
    """Pre-tokens (as chunk keys) that the library encodes as exactly one token."""
    sp = marked.load(path)
    marked.check_model(sp)
    own = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
           if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    words = [p[1:] for p in own if p.startswith(marked.MARK) and len(p) > 1 and marked.MARK not in p[1:]]
    return [w for w, ids in zip(words, sp.encode(words, num_threads=1)) if len(ids) == 1]


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` as struct ``row`` with ``n_bytes`` and ``n_tokens``."""
    path = path or vocabulary_path(MODEL)
    whole = docs.sparkSession.sparkContext.broadcast(proven_whole_tokens(path))

    def make():
        table = marked.ChunkTable(path, len, dict.fromkeys(whole.value, 1))

        def fn(texts):
            keys = [marked.chunks(t or "") for t in texts]
            count = table.values(keys)
            return [[len((t or "").encode()) for t in texts], [sum(map(count, k)) for k in keys]]
        return fn

    return annotate(docs, text, [("n_bytes", T.LongType()), ("n_tokens", T.LongType())], make)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: UTF-8 bytes, tokens of the 32k piece model, over the limit or not."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_tokens",
                                     (F.col("n_tokens") > LIMIT).alias("over_limit"))
