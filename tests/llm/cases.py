"""Documents for the operators' tests: supplied rows, and rows that are awkward on purpose."""

import random
import zlib

import duckdb

SF = "/root/testdata/sf0.001"


def supplied(n=200, sf=SF):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id LIMIT {n}").fetchall()


def awkward(start=100_000):
    rng = random.Random(5)
    words = ["alpha", "Béta", "gamma", "DELTA", "épsilon", "zeta!", "eta,", "theta."]
    prose = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(400))
    texts = [None, "", " ", "\n\t", "word", "a b c", "▁ mark ▁▁ x", "x" * 5000, "é" * 900, prose, prose, prose[:1500],
             "head " + prose + " tail", "same words " * 300, "\x00 zero \x0b vt \x1c fs \x85 nel", "  two  spaces ", "tail \n",
             "日本語テキスト 。 テスト", "\ue000 private \ue001 use 12.1.2.3\ue000 a@b.c", "<s> </s> <unk> <|endoftext|> <|startoftext|>",
             " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(30_000))]
    rows = [(start + i, t) for i, t in enumerate(texts)]
    return rows + [rows[9], (None, "no id " + prose), (None, None)]


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:       # names that operators use for their own columns
        from pyspark.sql import functions as F
        for c in ("row", "n_words", "kept", "ids", "t", "spans", "a", "component", "lang"):
            df = df.withColumn(c, F.lit("en"))
    return df


def fold(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x) if not isinstance(x, (list, dict)) else (False, "", str(x)) for x in r))
