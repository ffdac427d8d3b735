"""Paged JSON documents cut into ranges against from_json over whole documents."""

import json
import os
import random
import tempfile

import numpy as np
import pytest

from quarry.sources import json_ranges as J
from quarry.sources import read_paged_json
from quarry.sources.paged_json import flatten_paged_json

FIELDS = {"a": "a", "deep": "x.y", "list": "l", "obj": "x"}
ODD = ['plain', 'q " q', 'b \\ b', '\\"', '}{][,', '"}]', '\\\\', "é\n\t", "[{\"a\": 1}]", ""]


def documents():
    rng = random.Random(1)
    def record():
        return {"a": rng.choice(ODD), "x": {"y": rng.choice(ODD), "z": [[{"w": rng.choice(ODD)}], {}]}, "l": [rng.choice(ODD), [1, {"k": "}"}]], "n": rng.random()}
    docs = [[{"page": 1, "note": rng.choice(ODD), "more": [{"a": "not a record"}, [[{}]]]}, [record() for _ in range(n)]] for n in (0, 1, 2, 9, 40)]
    docs += [[{"page": 2}, None], {"message": "bad [request]"}, [{"page": 1}], [], [{"p": 1}, [{"a": "x"}], [{"a": "third member"}]],
             [{"p": 1}, [{}]], [[{"a": "first member"}], [{"a": "second"}]], {"a": [{"b": [{"c": 1}]}, [{"a": "no"}]]}, [1, "text"]]
    texts = [json.dumps(d, ensure_ascii=i % 2 == 0, indent=[None, 1][i % 3 == 0]) for i, d in enumerate(docs)]
    return [t + ("\n" if i % 4 == 0 else "") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def folder():
    d = tempfile.mkdtemp()
    for i, t in enumerate(documents()):
        with open(os.path.join(d, f"p{i:02d}.json"), "w") as f:
            f.write(t)
    return d


@pytest.mark.parametrize("size, chunk", [(17, 1), (64, 100), (1 << 27, 7), (1 << 27, 1 << 20)])
def test_records_equal_from_json(spark, folder, size, chunk):
    want = sorted(map(str, flatten_paged_json(spark.read.text(folder, wholetext=True), FIELDS).collect()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        chunks = J.chunk_table(spark, folder, chunk)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    from pyspark.sql import functions as F
    from quarry.sources.paged_json import record_schema
    rows = J.records_of(chunks).select(F.from_json("record", record_schema(FIELDS)).alias("r"))
    got = rows.select(F.col("r.a").alias("a"), F.col("r.x.y").alias("deep"), F.col("r.l").alias("list"), F.col("r.x").alias("obj"))
    assert len(want) > 50 and got.count() == len(want)
    plain = sorted(map(str, flatten_paged_json(spark.read.text(folder, wholetext=True), {"a": "a", "list": "l"}).collect()))
    assert sorted(map(str, got.select("a", "list").collect())) == plain


def test_a_large_document_is_read_by_many_tasks(spark):
    d = tempfile.mkdtemp()
    records = [{"a": ODD[i % len(ODD)] * 20, "x": {"y": str(i)}} for i in range(3000)]
    with open(os.path.join(d, "big.json"), "w") as f:
        f.write(json.dumps([{"page": 1, "pages": 1}, records]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50_000)
    try:
        chunks = J.chunk_table(spark, d, 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert chunks.select("start").distinct().count() > 5
    assert J.records_of(chunks).count() == 3000
    fields = {"a": "a", "deep": "x.y"}
    assert sorted(map(str, read_paged_json(spark, d, fields, large=True).collect())) == sorted(map(str, read_paged_json(spark, d, fields).collect()))


def test_quotes_and_depths_of_every_cut():
    """The summaries of two halves compose to the whole, wherever it is cut behind a brace."""
    for text in documents():
        raw = text.encode()
        data = np.frombuffer(raw, np.uint8)
        whole = J.summary(data)
        for k in [i + 1 for i, b in enumerate(raw) if b == ord("}")]:
            a, b = J.summary(data[:k]), J.summary(data[k:])
            assert whole[0] == (a[0] != b[0]) and whole[1] == a[1] + (b[2] if a[0] else b[1])
        assert whole[:2] == (False, 0)


def test_many_small_chunks_are_handed_on_together(spark, monkeypatch):
    """Chunks go on in batches of about ``BATCH_BYTES``, and a bound that cuts between any two loses none."""
    folder = tempfile.mkdtemp()
    with open(os.path.join(folder, "a.json"), "w") as f:
        f.write('[{"page": 1}, [' + ", ".join(json.dumps({"k": str(i), "v": "}]" * (i % 5)}) for i in range(500)) + "]]")
    for bound in (1, 1000, 4 << 20):
        monkeypatch.setattr(J, "BATCH_BYTES", bound)
        rows = J.read_paged_ranges(spark, folder, {"k": "k", "v": "v"}, chunk_bytes=60).collect()
        assert sorted((int(r["k"]), r["v"]) for r in rows) == [(i, "}]" * (i % 5)) for i in range(500)]
