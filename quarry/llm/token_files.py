"""Token files: frequency-ranked ids in a byte-aligned variable-length code (operator 10).

File format. A folder holds ``blocks`` and ``ranks``, Parquet containers both, and is read by its path
alone. A file of blocks has them in ascending document order; a block holds

* ``doc_ids``, ``lengths``: the documents' ids and their numbers of tokens (end id included),
* ``control``: two bits a token, four tokens a byte, low bits first: bytes of data less one,
* ``data``: one to four little-endian bytes a token, of the token's frequency rank,
* ``part``, ``offset``: the file part and the number of tokens before the block in it.

Ranks come from the counts of all ids over all documents, most frequent first, so the commonest
256 ids take one byte. The rank table (a row for each id in use, bounded by the vocabulary) is ``ranks``.
Decoding looks up the four lengths of each control byte in a 256-row table and gathers the data
bytes with numpy, a block at a time.

Encoding: no pre-token crosses white space, so each distinct word between ASCII white space is
lower-cased (ASCII) and encoded once; the table is bounded. A text with a string of an added
token goes to the library whole.

Steps, none of which holds more than a block: tokenize and write (doc_id, ids); count ids; deal
by ranges of doc_id and sort; write blocks; read them back. Defined results: null counts as
empty; an empty text has the end id alone; rows with one doc_id lie side by side in the order of
their ids; null doc_ids come first; an empty table gives empty files and no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import Remembered, annotate, materialize, pieces, read_table, scratch_path, vocabulary_path

MODEL = "word_bpe_49k.json"
END_ID = 2
BLOCK_TOKENS = 1 << 20
#: Distinct words (letter parts) that a worker process remembers from task to task, in each of two
#: generations; longer ones are not kept. About 200 bytes an entry.
CACHE_ENTRIES, CACHE_PARTS = 300_000, 250_000
CACHE_BYTES = 64
WORD_END = "</w>"
#: Lower-case letters that normalizing leaves alone, and marks behind them without an apostrophe.
#: Of lines of one word each; any other word is the third group.
PLAIN = re.compile("^(?:([a-zß-öø-ÿ]+)([.,;:!?()\\[\\]|#$%&*-]*)|(.+))$", re.M)


class WordTable:
    """Ids of every distinct word, as little-endian unsigned 32-bit bytes.

    Words of letters with marks behind them, the bulk of any prose, are pre-tokens that need no
    normalizing; their distinct letter parts are encoded together in one call, and the pieces with
    a word end tell them apart. All other words are encoded by the library as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.added = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values())
                                or "(?!)")
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.words = Remembered(self._words, CACHE_ENTRIES)
        self.parts = Remembered(self._parts, CACHE_PARTS)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> list[bytes]:
        split = PLAIN.findall(b"\n".join(words).decode().lower())          # no word has a line break
        parts = self.parts.know({p for m in split for p in m[:2] if p})
        other = iter(self._library([w.decode() for w, m in zip(words, split) if m[2]]))
        return [next(other) if more else parts[letters] + parts[marks] if marks else parts[letters]
                for letters, marks, more in split]

    def _parts(self, parts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(parts), 1000):
            own = parts[i:i + 1000]
            ids = np.array(self.library.encode(" ".join(own), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(own):
                coded, ends = ids.tobytes(), (cuts * 4).tolist()
                out += [coded[a:b] for a, b in zip([0, *ends], ends)]
            else:               # a vocabulary without word ends
                out += self._library(own)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = {i: ids for i, ids in self._whole(texts)}
        plain = pa.array(["" if i in whole else t for i, t in enumerate(texts)], pa.string())
        words = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        coded = pc.dictionary_encode(words.flatten())           # each distinct word of these texts once
        distinct = self._known(coded.dictionary.cast(pa.binary()).to_pylist())
        ids = np.frombuffer(b"".join(distinct), "<u4")
        lengths = np.array([len(x) for x in distinct], np.int64) // 4
        which = coded.indices.to_numpy()
        n = lengths[which]
        end = np.append(0, np.cumsum(n))
        out = ids[np.repeat((np.cumsum(lengths) - lengths)[which] - end[:-1], n) + np.arange(end[-1])]
        cuts = end[words.offsets.to_numpy()].tolist()
        return [whole[i] if i in whole else out[a:b].tobytes() for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]

    def _known(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words (and of the empty string, which is none)."""
        long = [w for w in words if len(w) > CACHE_BYTES]
        table = self.words.know({w for w in words if w}.difference(long))
        own = dict(zip(long, self._words(long))) if long else {}
        return [(own if len(w) > CACHE_BYTES else table)[w] if w else b"" for w in words]

    def _whole(self, texts):
        at = [i for i, t in enumerate(texts) if self.added.search(t)]
        return zip(at, self._library([texts[i] for i in at]))


@lru_cache(maxsize=1)
def word_table(path: str) -> WordTable:
    """The table of this worker process: its next task starts with the words that earlier ones met."""
    return WordTable(path)


def tokenize(docs: DataFrame, text: str = "text", path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``docs`` as struct ``row`` with ``ids``: binary of unsigned 16-bit ids (32-bit if
    the vocabulary is larger), the end id last, and their number ``n``."""
    path = path or vocabulary_path(MODEL)
    width = id_type(path)

    def make():
        table, end = word_table(path), np.array([end_id], "<u4").tobytes()

        def fn(texts):
            ids = [np.frombuffer(x + end, "<u4") for x in table.encode([t or "" for t in texts])]
            return [[x.astype(width).tobytes() for x in ids], [len(x) for x in ids]]
        return fn

    return annotate(docs, text, [("ids", T.BinaryType()), ("n", T.LongType())], make)


def id_type(path: str) -> str:
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def id_counts(tokens: DataFrame, width: str) -> dict[int, int]:
    """Occurrences of every id over all documents; at most one entry for each id of the vocabulary."""
    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for piece in pieces(b, 0):
                own = np.bincount(np.frombuffer(b"".join(piece.column(0).to_pylist()), width))
                if len(own) > len(total):
                    own[:len(total)] += total
                    total = own
                else:
                    total[:len(own)] += own
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "c"])

    rows = tokens.select("ids").mapInArrow(count, "id long, c long").groupBy("id").agg(F.sum("c").alias("c"))
    return {r["id"]: r["c"] for r in rows.collect()}


def encode_block(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of a sequence of ranks."""
    ranks = ranks.astype(np.uint32)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[:len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    spread = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), spread[np.arange(4) < size[:, None]].tobytes()


#: Bytes of data of the four tokens of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of a block."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    end = np.cumsum(size, dtype=np.int64)
    at = end - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


BLOCK = ("part int, offset long, n long, doc_ids array<long>, lengths array<int>, control binary, data binary")
RANKS = "rank int, id long"


def write_files(tokens: DataFrame, id_column: str, width: str, path: str, counts: dict[int, int]) -> str:
    """Write (id_column, ids, n) rows as token files in ascending order of ``id_column``; returns ``path``."""
    by_rank = [i for i, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    rank = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank))

    def blocks(batches):
        offset, part, held, total = 0, 0, [], 0

        def block():
            ids = np.concatenate([np.frombuffer(x, width) for _, x in held])
            control, data = encode_block(rank[ids])
            lengths = [len(x) // np.dtype(width).itemsize for _, x in held]
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([offset], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([[d for d, _ in held]], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                names=["part", "offset", "n", "doc_ids", "lengths", "control", "data"])

        for b in batches:
            for doc_id, ids, part in zip(*[c.to_pylist() for c in b.columns]):
                held.append((doc_id, ids))
                total += len(held[-1][1]) // np.dtype(width).itemsize
                if total >= BLOCK_TOKENS:
                    out = block()
                    yield out
                    offset, held, total = offset + total, [], 0
        if held:
            yield block()

    ordered = tokens.select(F.col(id_column).cast("long").alias("doc_id"), "ids") \
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids") \
        .select("doc_id", "ids", F.spark_partition_id().alias("part"))
    ordered.mapInArrow(blocks, BLOCK).write.option("compression", "zstd").parquet(f"{path}/blocks")
    ranks = tokens.sparkSession.createDataFrame(list(enumerate(by_rank)), RANKS)
    ranks.coalesce(1).write.parquet(f"{path}/ranks")
    return path


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files at ``path``: doc_id, start, n_tokens, ids_crc32 and (lazily) ``ids``."""
    return _decoded(spark, path, True)


def _decoded(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    # the vocabulary at most
    by_rank = np.array([r["id"] for r in spark.read.schema(RANKS).parquet(f"{path}/ranks").orderBy("rank").collect()], "<u4")
    extra = ", ids array<int>" if with_ids else ""

    def decode(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(k)[i].as_py() for k, n in enumerate(b.schema.names)}
                ids = by_rank[decode_block(r["control"], r["data"], r["n"])]
                end = np.cumsum(r["lengths"], dtype=np.int64)
                start = end - r["lengths"]
                columns = [pa.array(r["doc_ids"], pa.int64()), pa.array([r["part"]] * len(end), pa.int32()),
                           pa.array(start + r["offset"], pa.int64()), pa.array(r["lengths"], pa.int64()),
                           pa.array([zlib.crc32(ids[s:e].tobytes()) for s, e in zip(start, end)], pa.int64())]
                names = ["doc_id", "part", "within", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([ids[s:e].astype(np.int32).tolist() for s, e in zip(start, end)],
                                            pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = blocks.mapInArrow(decode, "doc_id long, part int, within long, n_tokens long, ids_crc32 long" + extra)
    # one row a file part, as many as the range partitioning has: their running totals are the parts' starts
    total, base = 0, []
    for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        base.append((r["part"], total))
        total += r["n"]
    starts = spark.createDataFrame(base, "p int, base long")
    joined = rows.join(F.broadcast(starts), F.col("part") == F.col("p"))
    columns = ["doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"]
    return joined.select(*columns, *(["ids"] if with_ids else []))


def write_token_files(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None,
                      model: str | None = None) -> str:
    """Tokenize ``docs`` and write the files to ``path`` (default: a new scratch folder), which is returned."""
    model = model or vocabulary_path(MODEL)
    tokens = materialize(tokenize(docs.select(id_column, text), text, model)
                         .select(F.col(f"row.{id_column}").alias(id_column), "ids", "n"), "token-ids")
    width = id_type(model)
    return write_files(tokens, id_column, width, path or scratch_path(docs.sparkSession, "token-files"),
                       id_counts(tokens, width))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` to token files and back: start, number and crc32 of each document's ids."""
    path = write_token_files(read_table(spark, sf_dir, "documents"))
    return _decoded(spark, path, False)
