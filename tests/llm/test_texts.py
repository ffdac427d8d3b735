"""Operators 2, 3, 4, 5 and 10 against plain Python and the libraries."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import decontaminate, marked, pieces_codec, quality, token_counts, token_files
from tests.llm.cases import SF, awkward, frame, key, supplied

WORD3 = re.compile(r"[^\x20\x09-\x0D]+")
WORD2 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def rows():
    return supplied() + awkward()


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# --- operator 3 ------------------------------------------------------------------------------

def base_counts(text):
    t = text or ""
    words = WORD3.findall(t)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    hit = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    earlier, dup = set(), 0
    for line in t.split("\n"):
        if WORD3.search(line):
            dup += line in earlier
            earlier.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), n < 20 or 100 * len(hit) > 30 * n)


def test_quality_base_counts(spark, rows):
    out = quality.judge(frame(spark, rows, extra=True))
    got = [tuple(r) for r in out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                        "n_repeat_words", "base_failed").collect()]
    assert key(got) == key([(i, *base_counts(t)) for i, t in rows])
    assert out.where("base_failed and kept").count() == 0


def test_quality_separates_junk_and_keeps_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.judge(docs).select(F.col("row.doc_id").alias("doc_id"), "kept", "base_failed").join(labels, "doc_id")
    r = out.where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()
    kept = {x["quality"]: x["k"] for x in r}
    assert kept[1] > 0.99 and kept[0] < 0.8


def short_texts(clean, junk):
    """Texts of 80 to 190 words: common words among others as in prose, and none at all."""
    rng, common = np.random.default_rng(4), quality.COMMON_WORDS["en"].split()
    share = 0.4 * (w := 1 / np.arange(2, len(common) + 2)) / w.sum()

    def text(listed):
        n = int(rng.integers(80, 190))
        return " ".join(common[i] if listed and i < len(common) else f"{rng.choice(['lorim', 'dasel', 'motar', 'venip'])}{'abcdefgh'[k % 8]}{'aeiou'[k % 5]}"
                        for k, i in enumerate(rng.choice(len(common) + 1, n, p=[*share, 1 - share.sum()])))
    return [(i, text(i < clean)) for i in range(clean + junk)]


def test_quality_judges_short_texts(spark):
    """A table without any text of 200 words."""
    rows = short_texts(300, 60)
    out = quality.judge(frame(spark, rows, extra=True)).where("not base_failed").select("row.doc_id", "kept", "class_distance").collect()
    kept = {k: [r["kept"] for r in out if (r["doc_id"] < 300) == k] for k in (True, False)}
    assert len(out) > 300 and np.mean(kept[True]) > 0.99 and not any(kept[False])
    assert all(r["class_distance"] is not None for r in out)


def test_word_limits_hold_for_drawn_texts():
    rng, q = np.random.default_rng(1), np.array([6.0, 4, 3, 2, 2, 1, 1, 1, 0.5, 60])
    limits = quality.word_limits(q, 0.1)
    for n in (20, 60, 150):
        d = quality.js_distances(rng.multinomial(n, q / q.sum(), 2000).astype(float), q)
        assert (d > limits[n]).mean() < 0.005 and np.median(d) < limits[n] < 2.5 * np.median(d)


def test_quality_without_references_and_empty(spark):
    assert quality.judge(frame(spark, []).withColumn("lang", F.lit("xx"))).count() == 0
    plain = quality.judge(frame(spark, supplied(20)).withColumn("lang", F.lit(None).cast("string")))
    assert plain.where("kept = base_failed").count() == 0
    kept = quality.keep_documents(frame(spark, supplied(50), extra=True))
    assert kept.columns == frame(spark, [], extra=True).columns and 0 < kept.count() <= 50


def test_distance_properties():
    p, q = np.array([[1.0, 0, 3], [2, 2, 2], [0, 0, 0]]), np.array([1.0, 0, 3])
    d = quality.js_distances(p, q)
    assert d[0] == pytest.approx(0) and 0 < d[1] < 1 and d[2] == 1
    assert quality.js_distances(np.array([[0.0, 1, 0]]), np.array([1.0, 0, 1]))[0] == pytest.approx(1)


# --- operators 4 and 5 -----------------------------------------------------------------------

def test_token_counts(spark, rows, pieces):
    out = token_counts.count_tokens(frame(spark, rows, extra=True))
    got = [tuple(r) for r in out.select("row.doc_id", "n_bytes", "n_tokens").collect()]
    assert key(got) == key([(i, len((t or "").encode()), len(pieces.encode(t or ""))) for i, t in rows])


def test_whole_tokens_are_proven(pieces):
    whole = token_counts.proven_whole_tokens(public_tokenizers.path("piece_bpe_32k.model"))
    assert len(whole) > 10_000 and all(len(x) == 1 for x in pieces.encode(whole))


def test_piece_ids_and_round_trip(spark, rows, pieces):
    out = pieces_codec.encode_documents(frame(spark, rows)).select("row.doc_id", "ids", "decoded")
    want = [(i, pieces.encode(t or ""), pieces.decode(pieces.encode(t or ""))) for i, t in rows]
    assert key([tuple(r) for r in out.collect()]) == key(want)
    digest = pieces_codec.encode_stage(frame(spark, rows, extra=True))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert key([tuple(r) for r in digest.collect()]) == key(
        [(i, len(ids), sha(",".join(map(str, ids))), sha(d)) for i, ids, d in want])
    assert pieces_codec.encode_stage(frame(spark, [])).count() == 0


def test_tables_that_forget_stay_right(pieces, monkeypatch):
    monkeypatch.setattr(marked, "CACHE_ENTRIES", 50)
    table = marked.ChunkTable(public_tokenizers.path("piece_bpe_32k.model"), tuple)
    for _ in range(2):
        for _, t in supplied(60):
            keys = marked.chunks(t)
            ids = table.values([keys])
            assert [x for k in keys for x in ids(k)] == pieces.encode(t)


def test_model_check_refuses_inner_markers(pieces):
    class Fake:
        def __getattr__(self, name):
            return getattr(pieces, name)

        def id_to_piece(self, i):
            return "a▁b" if i == 5 else pieces.id_to_piece(i)
    with pytest.raises(ValueError):
        marked.check_model(Fake())


# --- operator 10 -----------------------------------------------------------------------------

def test_token_files(spark, rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    files = token_files.write_token_files(frame(spark, rows, extra=True))
    assert isinstance(files, str)       # the path alone is enough to read them, also for another session
    got = [tuple(r) for r in token_files.read_files(spark.newSession(), files).select("doc_id", "start", "n_tokens", "ids_crc32", "ids").collect()]
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i or 0))
    at = 0
    for i, start, n, crc, own in got:
        assert start == at and own in ids[i] and n == len(own)
        assert crc == zlib.crc32(np.array(own, "<u4").tobytes())
        ids[i].remove(own)
        at += n


def test_code_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (rng.integers(0, 2 ** 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = token_files.encode_block(ranks)
        assert (token_files.decode_block(control, data, n) == ranks).all()


def test_a_worker_encodes_no_word_twice(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["Ein Wort, noch ein Wort! x@y.com", "\u00c9t\u00e9 \x1c\u0130 " + "long" * 30, "", " \t\n", "<|endoftext|> after"]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert token_files.word_table(path).encode(texts) == want
    asked, table = [], token_files.word_table(path)         # as the next task of this worker gets it
    monkeypatch.setattr(table.words, "compute", lambda words: asked.extend(words) or table._words(words))
    assert table.encode(texts) == want and table.encode([]) == []
    assert asked == []


def test_token_files_of_nothing(spark):
    files = token_files.write_token_files(frame(spark, []))
    assert token_files.read_files(spark, files).count() == 0


# --- operator 2 ------------------------------------------------------------------------------

def contamination(rows, items):
    patterns = {}
    for item, text in items:
        w = WORD2.findall(lower(text))
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            owners = patterns.setdefault(tuple(w[i:i + m]), set())
            if item is not None:        # windows of an item without id hit, too
                owners.add(str(item))
    out = []
    for i, t in rows:
        w = WORD2.findall(lower(t))
        hit, ids = set(), set()
        for m in {len(p) for p in patterns}:
            for k in range(len(w) - m + 1):
                own = patterns.get(tuple(w[k:k + m]))
                if own is not None:
                    hit |= set(range(k, k + m))
                    ids |= own
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_decontamination(spark, rows, block_bytes):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    items += [(900, "gamma zeta!"), (901, None), (902, ""), (None, "alpha"), (903, "w"), (904, items[0][1]), (9, "theta3"),
              (905, "same words same words same words same words same words same words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    if block_bytes < 1000:      # several passes: fewer items make it quick
        items = items[-9:]
        bench = spark.createDataFrame(items, "item_id long, text string")
    own = rows + [(7000, "x " + (items[0][1] or "") + " y"), (7001, "Gamma, ZETA!")]
    found = decontaminate.with_hits(decontaminate.find_contamination(frame(spark, own, extra=True), bench, block_bytes=block_bytes))
    nested = "row.doc_id" if block_bytes > 1000 else "row.doc_id"
    got = found.select(nested, "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert key([tuple(r) for r in got]) == key(contamination(own, items))


def test_decontamination_without_benchmark(spark, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(frame(spark, rows, extra=True), none).count() == len(rows)
