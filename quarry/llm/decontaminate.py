"""Benchmark decontamination by Wu-Manber search (operator 2).

The alphabet is the words of the benchmark. Patterns are the windows of ten consecutive words of
every item (an item of fewer words is one window), grouped by length. For each length the shift
table says, for a block of two words, how far the search may advance because no pattern has that
block nearer to its end; most blocks of a document are in no pattern and skip nine words. Where
the shift is zero, the bucket of that suffix block, split by the patterns' first block, names the
candidates, and a direct comparison of the words confirms each.

The benchmark is the stated query set. It is read on the driver in blocks of items of at most
``block_bytes`` of text; each block is a broadcast of that bounded size, its tables take about 180 bytes of
a task's memory for each byte of text, and a larger benchmark makes several passes that add to the same
hit columns. A pass is written before the next begins, so that one block's tables are in memory at a time.

Defined results: null or empty texts have no words, no hits and the digest of the empty string;
items without text or words match nothing; repeated items count once by their id; the windows of
an item with a null id hit like any other, but it is neither counted nor listed among the items; repeated documents get equal results; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import annotate, materialize, read_table

WINDOW = 10
BLOCK_BYTES = 1 << 20

#: Lower-cases A-Z; maps every byte that is neither a digit, a letter nor of a non-ASCII character to a space.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
               for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words (runs of digits, ASCII letters and non-ASCII characters) as UTF-8."""
    return (text or "").encode().translate(_TABLE).split()


class WuManber:
    """Search for word patterns of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}

    def add(self, pattern: tuple, number: int) -> None:
        m, b = self.length, self.block
        for end in range(b, m + 1):
            key = pattern[end - b:end]
            self.shift[key] = min(self.shift.get(key, self.default), m - end)
        bucket = self.buckets.setdefault(pattern[m - b:], {})
        bucket.setdefault(pattern[:b], {})[pattern] = number

    def search(self, words: tuple):
        """(start, pattern number) of every occurrence."""
        m, b, default = self.length, self.block, self.default
        shift, buckets = self.shift, self.buckets
        end, n = m, len(words)
        while end <= n:
            key = words[end - b:end]
            step = shift.get(key, default)
            if step:
                end += step
                continue
            bucket = buckets[key].get(words[end - m:end - m + b])
            if bucket is not None:
                number = bucket.get(words[end - m:end])      # compares the candidate's words
                if number is not None:
                    yield end - m, number
            end += 1


def compile_patterns(items: list[tuple]) -> tuple[list[WuManber], list[frozenset]]:
    """Search tables for the items (id, text), and for each pattern number the items that have it."""
    numbers: dict[tuple, int] = {}
    owners: list[set] = []
    for item, text in items:
        words = tuple(words_of(text))
        size = min(WINDOW, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            pattern = words[i:i + size]
            number = numbers.setdefault(pattern, len(owners))
            if number == len(owners):
                owners.append(set())
            if item is not None:
                owners[number].add(item)
    tables: dict[int, WuManber] = {}
    for pattern, number in numbers.items():
        tables.setdefault(len(pattern), WuManber(len(pattern))).add(pattern, number)
    return list(tables.values()), [frozenset(x) for x in owners]


def scan(words: list[bytes], tables: list[WuManber], owners: list[frozenset]) -> tuple[list, set]:
    """Disjoint hit runs [start, end) of words, and the items that occur."""
    words, spans, items = tuple(words), [], set()
    for table in tables:
        for start, number in table.search(words):
            items |= owners[number]
            if spans and start <= spans[-1][1] and spans[-1][0] <= start:
                spans[-1] = (spans[-1][0], max(spans[-1][1], start + table.length))
            else:
                spans.append((start, start + table.length))
    return merge(spans), items


def merge(spans: list) -> list:
    out: list = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def benchmark_blocks(benchmark: DataFrame, id_column: str, text: str, block_bytes: int):
    """The items in blocks of at most ``block_bytes`` of text (one item at least)."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_column).cast("string").alias("i"), F.col(text).cast("string").alias("t"))
    for r in rows.where("t is not null").toLocalIterator():
        n = len(r["t"].encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += n
    yield block


SPANS = T.ArrayType(T.ArrayType(T.IntegerType()))
HITS = [("n_words", T.LongType()), ("spans", SPANS), ("items", T.ArrayType(T.StringType()))]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` as struct ``row`` with ``n_words``, hit word runs ``spans`` and ``items`` (ids that occur)."""
    sc = docs.sparkSession.sparkContext
    found = None
    for block in benchmark_blocks(benchmark, item_id, item_text, block_bytes):
        shared = sc.broadcast(block)

        def make(shared=shared):
            tables, owners = compile_patterns(shared.value)

            def fn(texts):
                n, spans, items = [], [], []
                for t in texts:
                    words = words_of(t)
                    own, ids = scan(words, tables, owners) if tables else ([], set())
                    n.append(len(words))
                    spans.append([list(x) for x in own])
                    items.append(sorted(ids))
                return [n, spans, items]
            return fn

        if found is None:
            found = annotate(docs, text, HITS, make)
        else:       # the same rows again, with this block's hits added to what they have
            found = materialize(found, "hits")
            again = annotate(found.select("*", F.col(f"row.`{text}`").alias("t")), "t", HITS, make)
            found = again.select("row.row", "n_words", F.concat("row.spans", "spans").alias("spans"),
                                 F.array_sort(F.array_union("row.items", "items")).alias("items"))
    return found


def with_hits(found: DataFrame) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and contaminated."""
    def n_hit(spans):
        # runs of several passes may overlap: count each word once
        return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                           lambda a, s: F.struct(
                               (a["n"] + F.greatest(F.lit(0), s[1] - F.greatest(s[0], a["end"]))).alias("n"),
                               F.greatest(a["end"], s[1]).alias("end")), lambda a: a["n"].cast("long"))
    return found.withColumn("n_hit", n_hit(F.col("spans"))) \
        .withColumn("n_items", F.size("items").cast("long")) \
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256)) \
        .withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, all their columns unchanged."""
    return find_contamination(docs, benchmark).where(F.size("spans") == 0).select("row.*")


def op2_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` against whole ``benchmark``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_hits(find_contamination(docs, read_table(spark, sf_dir, "benchmark")))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _words_sql(column: str) -> str:
    lowered = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words_sql('text')} AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
      FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
m AS (SELECT DISTINCT m FROM p),
x AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
      FROM d, m, unnest(range(1, len(w) - m + 2)) AS t(i)),
h AS (SELECT r, i, x.m AS m, p.item FROM x JOIN p ON x.m = p.m AND x.s = p.s),
c AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS j FROM h) GROUP BY r),
k AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT r, item FROM h WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN k USING (r)
"""
