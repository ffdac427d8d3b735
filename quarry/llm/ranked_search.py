"""Ranked lexical search with bag deduplication (operator 11).

Two documents that hold the same item terms equally often and have the same length norm ``m`` get
the same score for every item. So documents are restricted to the items' vocabulary, equal bags
(term frequencies plus ``m``) are grouped, each class of them is scored once, and only the classes
that reach a result are expanded to their members, by ascending doc_id.

Steps, for a block of items at a time: (1) one pass over the texts writes a narrow row a document
(id, number of terms, bag) and sums document frequencies a task; (2) N, L and the document
frequencies give the weights and every document's m; (3) bags are grouped by hash and compared
whole, each class with its smallest id; (4) tasks score classes and keep the best ``top`` of every
item, which are merged in two steps; (5) members of the winning classes are found by the hash, compared
whole and cut to the ``top`` smallest ids a class, before any shuffle. No class is ever gathered: a
hot one is reduced by every input partition. The best ``top`` documents lie in the ``top`` classes
that are best by score and then by smallest id, so the cut loses nothing.

The items are the stated query set. They are read on the driver in blocks of at most
``block_items`` items and ``block_bytes`` of text (one item at least); only a block's vocabulary,
weights and winners (at most ``block_items * top`` hashes) are broadcast. A larger set makes more passes.

Defined results: a null or empty text has no terms and counts in neither N nor L; items without
terms, and all items if no document has one, get no rows; documents with a score of 0 (no shared term, or only
terms of weight 0) are not listed. Repeated documents are each listed, repeated items each ranked (one list
for each row); a null item_id is ranked under null; among equal scores null doc_ids come last.
Empty tables give no rows. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize, pieces, read_table

TOP = 50
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 4 << 20
#: Classes scored together have at most so many cells (classes x items).
CELLS = 1 << 20
#: Parts in which an item's candidates of all tasks are cut down before they meet.
PARTS = 64
NO_ID = np.iinfo(np.int64).max

#: Lower-cases A-Z; every byte that is no digit, letter or part of a non-ASCII character becomes a space.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
               for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def item_blocks(items: DataFrame, item_id: str, text: str, block_items: int, block_bytes: int):
    """Lists of (item_id, distinct terms), the text of a list bounded (one item at least)."""
    block, size = [], 0
    rows = items.select(items[f"`{item_id}`"].alias("i"), items[f"`{text}`"].cast("string").alias("t"))
    for r in rows.where("t is not null").toLocalIterator():
        raw = r["t"].encode()
        terms = sorted(set(terms_of(raw)))
        if not terms:
            continue
        if block and (len(block) >= block_items or size + len(raw) > block_bytes):
            yield block
            block, size = [], 0
        block.append((r["i"], terms))
        size += len(raw)
    if block:
        yield block


def gather(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Rows (doc_id, n, bag) of documents, ``bag``: pairs of term number and frequency in 32 bits each,
    ascending (null if no term is in the vocabulary); and rows (term, df), partial sums of tasks."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})
    names = ["doc_id", "n", "bag", "term", "df"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]

    def run(batches):
        vocabulary = shared.value
        own, df = frozenset(vocabulary), np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for piece in pieces(batch, 1):
                n, bags = [], []
                for text in piece.column(1).to_pylist():
                    words = terms_of(text)
                    counts = Counter(words)
                    hit = sorted([(vocabulary[t], counts[t]) for t in own.intersection(counts)])
                    n.append(len(words))
                    bag = np.array(hit, "<u4")
                    if hit:
                        df[bag[:, 0]] += 1
                    bags.append(bag.tobytes() if hit else None)
                nulls = pa.nulls(len(n))
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n, types[1]), pa.array(bags, types[2]),
                                                  nulls.cast(types[3]), nulls.cast(types[4])], names=names)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(seen), t) for t in types[:3]]
                                         + [pa.array(seen, types[3]), pa.array(df[seen], types[4])], names=names)

    return docs.mapInArrow(run, "doc_id long, n long, bag binary, term int, df long")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2 * N + 2) / (2 * df + 1))) of every term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Best:
    """The best ``top`` classes of every item met so far, by score, then smallest id, then class."""

    def __init__(self, items: int, top: int):
        self.top, self.limit = top, np.ones(items, np.int64)     # a score from here on may be among them
        self.rows, self.waiting = np.zeros((4, 0), np.int64), []

    def add(self, scores: np.ndarray, least: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: a row for each class, a column for each item."""
        row, item = np.nonzero(scores >= self.limit)
        self.waiting.append(np.array([item, scores[row, item], least[row], ids[row]]))
        if sum(w.shape[1] for w in self.waiting) > max(2 * self.rows.shape[1], 100_000):
            self.cut()

    def cut(self) -> np.ndarray:
        rows = np.concatenate([self.rows, *self.waiting], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])                # where the item's rows begin
        place = np.arange(rows.shape[1]) - first
        last = place == self.top - 1
        self.limit[rows[0][last]] = rows[1][last]
        self.rows, self.waiting = rows[:, place < self.top], []
        return self.rows


def class_scores(bags: list[bytes], m: np.ndarray, weight: np.ndarray, postings: tuple, items: int) -> np.ndarray:
    """Exact 64-bit scores, a row for each class. ``postings``: start of each term's items, and the items."""
    starts, listed = postings
    sizes = np.array([len(b) // 8 for b in bags])
    pairs = np.frombuffer(b"".join(bags), "<u4").reshape(-1, 2).astype(np.int64)
    row = np.repeat(np.arange(len(bags)), sizes)
    term, tf = pairs[:, 0], pairs[:, 1]
    part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
    times = starts[term + 1] - starts[term]
    ends = np.cumsum(times)
    item = listed[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[term] - (ends - times), times)]
    out = np.zeros(len(bags) * items, np.int64)
    np.add.at(out, np.repeat(row, times) * items + item, np.repeat(part, times))
    return out.reshape(len(bags), items)


def best_classes(classes: DataFrame, block: list, terms: list[bytes], weight: np.ndarray, top: int) -> DataFrame:
    """(item, score, least, class): every item's best ``top`` classes. classes: (class, bag, m, least)."""
    place = {t: i for i, t in enumerate(terms)}
    pairs = np.array(sorted((place[t], k) for k, (_, own) in enumerate(block) for t in own), np.int64).reshape(-1, 2)
    starts = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
    shared = classes.sparkSession.sparkContext.broadcast((weight, (starts, pairs[:, 1]), len(block)))

    def run(batches):
        weight, postings, items = shared.value
        best = Best(items, top)
        step = max(1, CELLS // items)
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                few = batch.slice(i, step)
                ids, m = few.column(0).to_numpy(), few.column(2).to_numpy()
                least = few.column(3).fill_null(NO_ID).to_numpy()
                best.add(class_scores(few.column(1).to_pylist(), m, weight, postings, items), least, ids)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in best.cut()],
                                         names=["item", "score", "least", "class"])

    found = classes.select("class", "bag", "m", "least").mapInArrow(run, "item long, score long, least long, class long")
    order = [F.desc("score"), F.asc("least"), F.asc("class")]
    part = F.pmod(F.xxhash64("class"), F.lit(PARTS))
    for keys in ([F.col("item"), part], [F.col("item")]):
        found = found.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))) \
            .where(F.col("place") <= top).drop("place")
    return found


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``top`` best documents."""
    spark = docs.sparkSession
    own = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("string").cast("binary").alias("text"))
    id_type = items.schema[item_id].dataType
    out = []
    for block in item_blocks(items, item_id, item_text, block_items, block_bytes):
        out.append(_rank_block(own, block, id_type, top))
        if len(out) > 1:        # passes do not pile up in one plan
            out = [materialize(out[0].unionByName(out[1]), "search-ranked")]
    return out[0] if out else spark.createDataFrame([], _result(id_type))


def _result(id_type) -> str:
    return f"item_id {id_type.simpleString()}, rank int, doc_id long, score long"


def _rank_block(docs: DataFrame, block: list, id_type, top: int) -> DataFrame:
    spark = docs.sparkSession
    terms = sorted(set().union(*[own for _, own in block]))
    rows = materialize(gather(docs, terms), "search-bags")
    n_docs, n_terms = rows.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for r in rows.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")).collect():     # the vocabulary at most
        df[r["term"]] = r["df"]
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L")
    bags = rows.where("bag is not null").select("doc_id", "bag", m.alias("m")).withColumn("h", F.xxhash64("bag", "m"))
    grouped = bags.groupBy("h", "bag", "m").agg(F.min("doc_id").alias("least"))
    classes = materialize(grouped.withColumn("class", F.monotonically_increasing_id()), "search-classes")
    best = materialize(best_classes(classes, block, terms, weights(n_docs, df), top), "search-best")

    # at most top * len(block) rows: their classes' keys, and the hashes that members are found by
    winners = best.select("class").distinct()
    keys = classes.join(F.broadcast(winners), "class").select("class", "h", "bag", "m")
    member = Window.partitionBy("h", "bag", "m").orderBy(F.asc_nulls_last("doc_id"))
    members = bags.join(F.broadcast(keys.select("h").distinct()), "h", "left_semi") \
        .withColumn("place", F.row_number().over(member)).where(F.col("place") <= top).drop("place")
    listed = members.join(keys, ["h", "bag", "m"]).select("class", "doc_id").join(best, "class")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], f"item long, item_id {id_type.simpleString()}")
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` ranked for every item of ``benchmark``."""
    return rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _terms_sql(column: str) -> str:
    lowered = f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all(coalesce({lowered}, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms_sql('text')} AS t FROM documents),
t AS (SELECT r, u.term, count(*) AS tf FROM d, unnest(t) AS u(term) GROUP BY r, u.term),
c AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(t)) AS BIGINT) AS ll FROM d WHERE len(t) > 0),
m AS (SELECT r, doc_id, 100 - 50 + (50 * CAST(len(t) AS BIGINT) * nn) // ll AS m FROM d, c WHERE len(t) > 0),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c),
i AS (SELECT DISTINCT k, item_id, term FROM
      (SELECT row_number() OVER () AS k, item_id, {_terms_sql('text')} AS q FROM benchmark), unnest(q) AS u(term)),
s AS (SELECT k, item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY k, item_id, doc_id, r),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id ASC NULLS LAST, r) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 50
"""
