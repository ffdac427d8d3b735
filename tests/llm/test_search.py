"""Ranked search, the classifier from positives and unlabelled texts, and periodic runs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import periodic_runs, quality_pu, ranked_search
from tests.llm.cases import SF, awkward, frame, key, supplied

# ---- ranked search -------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked_by_force(docs, items, top=50):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    size = [sum(b.values()) for _, b in bags]
    nn, ll = sum(n > 0 for n in size), sum(size)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (doc, b), n in zip(bags, size):
            if n:
                m = 100 - 50 + (50 * n * nn) // ll
                s = sum(math.floor(1000 * math.log((2 * nn + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 20 * m))
                        for t in set(terms(text)) if t in b)
                if s > 0:
                    scored.append((-s, doc is None, doc))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(scored[:top])]
    return out


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("n, blocks", [(20, {}), (8, {"block_items": 6}), (0, {"block_bytes": 1})])
def test_search_equals_brute_force(spark, n, blocks):
    copies = [(500_000 + i, "the Same words of a copy, the same") for i in range(130)]
    docs = supplied(150) + awkward() + copies + copies[:3]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet' ORDER BY 1 LIMIT {n}").fetchall()
    items += [(900, None), (901, ""), (902, "--- !!"), (903, "same copy"), (903, "same copy"), (None, "THE the The of"), (904, "alpha béta")]
    got = [tuple(r) for r in ranked_search.rank(frame(spark, docs, extra=True), items_of(spark, items), **blocks).collect()]
    assert key(got) == key(ranked_by_force(docs, items))


def test_search_lists_members_of_a_large_class_by_id(spark):
    docs = [(i, "needle in hay") for i in random.Random(1).sample(range(10_000), 300)] + [(20_000, "hay")]
    got = ranked_search.rank(frame(spark, docs).repartition(7), items_of(spark, [(1, "needle")]), top=60).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == sorted(i for i, _ in docs if i < 10_000)[:60]
    assert len({r["score"] for r in got}) == 1


def test_search_of_empty_tables(spark):
    docs, items = frame(spark, [(1, "a b")]), items_of(spark, [(1, "a")])
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0)), (frame(spark, [(1, None), (2, "")]), items)):
        found = ranked_search.rank(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_scores_are_exact_integers():
    bag = np.array([[0, 3], [1, 2 ** 31]], "<u4").tobytes()
    out = ranked_search.class_scores([bag, bag], np.array([50, 51]), np.array([24_000, 7]), (np.array([0, 2, 3]), np.array([0, 1, 1])), 2)
    one = [24_000 * (3 * 10 ** 9 // (3000 + 20 * m)) for m in (50, 51)]
    two = [7 * (2 ** 31 * 10 ** 9 // (1000 * 2 ** 31 + 20 * m)) for m in (50, 51)]
    assert out.tolist() == [[one[0], one[0] + two[0]], [one[1], one[1] + two[1]]]


# ---- positive-unlabelled classifier --------------------------------------------------------------

def labelled(spark, flip=None):
    rows = duckdb.sql(f"SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    return spark.createDataFrame([(i, flip(i, q) if flip else q) for i, q in rows], "doc_id long, quality int")


def web(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def scores(df):
    return {r["doc_id"]: r["score"] for r in df.collect()}


def remainder(i):
    return zlib.crc32(str(i).encode()) % 3


def test_held_out_labels_are_predicted(spark):
    found = quality_pu.score(web(spark), labelled(spark))
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(labelled(spark), "doc_id").collect()
    assert found.count() == web(spark).count()
    assert all(r["held_out"] == (remainder(r["doc_id"]) == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    for q in (0, 1):
        own = [r["predicted"] == q for r in rows if r["held_out"] and r["quality"] == q]
        assert sum(own) >= 0.9 * len(own)


def test_only_trusted_positives_of_the_training_folds_are_read(spark):
    base = scores(quality_pu.score(web(spark), labelled(spark)))
    held = scores(quality_pu.score(web(spark), labelled(spark, lambda i, q: 1 - q if remainder(i) == 1 else q)))
    assert held == base         # held-out labels do not matter
    bad = labelled(spark).where((F.col("quality") == 1) | F.lit(False))
    assert scores(quality_pu.score(web(spark), bad)) == base        # nor do bad labels at all


def test_prior_is_near_the_share_of_good_texts():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0, 1, (6000, 4)), rng.normal(3, 1, (6000, 4))
    for share in (0.3, 0.6, 0.9):
        n = int(4000 * share)
        u = rng.permutation(np.concatenate([good[2000:2000 + n], bad[:4000 - n]]))
        assert abs(quality_pu.estimate_prior(good[:2000], u) - share) < 0.08


def test_risk_gradient_and_non_negative_step():
    rng = np.random.default_rng(0)
    net = quality_pu.new_network(rng.normal(size=(50, 5)))
    x, pull = rng.normal(size=(8, 5)), rng.normal(size=8)

    def loss():
        w1, b1, w2, b2 = net.weights
        return float(pull @ (np.tanh(x @ w1 + b1) @ w2 + b2[0]) + 5e-5 * ((w1 ** 2).sum() + (w2 ** 2).sum()))
    for w, g in zip(net.weights, quality_pu._gradients(net, x, pull)):
        at = (0,) * w.ndim
        w[at] += 1e-6
        up = loss()
        w[at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - g[at]) < 1e-5
        w[at] += 1e-6
    # a network far stronger than its data: without the floor it would call every unlabelled row bad
    p, u = rng.normal(size=(30, 5)), rng.normal(size=(30, 5))
    assert quality_pu.fit(p, u, 0.9, epochs=400).score(u).mean() > 0.5


def test_classifier_edge_cases(spark):
    docs = frame(spark, awkward() + supplied(60), extra=True).withColumn("score", F.lit(1)).withColumn("held_out", F.lit("x"))
    own = spark.createDataFrame([(i, 1) for i in range(40)] + [(None, 1), (3, None), (4, 0), (4, 1)], "doc_id long, quality int")
    found = quality_pu.score(docs, own).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    same = {r["score"] for r in found if r["doc_id"] in (100_009, 100_010)}
    assert len(same) == 1
    assert {r["score"] for r in quality_pu.score(docs, own.limit(0)).collect()} == {0.5}
    assert quality_pu.score(docs.limit(0), own).count() == 0


def test_trusted_needs_every_label_good(spark):
    own = spark.createDataFrame([(2, 1), (3, 1), (3, None), (4, 0), (4, 1), (None, 1)], "doc_id long, quality int")
    p, u = quality_pu.sample(frame(spark, [(i, f"text {i}") for i in (2, 3, 4, 5, 6, 7, 8)] + [(None, "x")]), own)
    assert len(p) == sum(remainder(i) != 1 for i in (2,)) and len(u) == sum(remainder(i) != 1 for i in (2, 3, 4, 5, 6, 7, 8)) + 1


# ---- periodic runs -------------------------------------------------------------------------------

def runs_by_force(words):
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def digests_by_force(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_force(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@st.composite
def repetitive(draw):
    out = []
    for _ in range(draw(st.integers(1, 5))):
        base = draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 3, 60]))), min_size=1, max_size=draw(st.sampled_from([2, 9, 30]))))
        out += (base * draw(st.integers(1, 30)))[:draw(st.integers(1, 150))]
    return [b"%d" % v for v in out * draw(st.integers(1, 3))]


@settings(max_examples=150, deadline=None)
@given(st.lists(repetitive(), max_size=3))
def test_runs_equal_brute_force(docs):
    assert periodic_runs.find_runs(docs) == [runs_by_force(d) for d in docs]


def test_periodic_query_equals_brute_force(spark):
    docs = supplied(200) + [r for r in awkward() if len(r[1] or "") < 20_000] + [(7, "ab " * 40 + "c d e " * 30), (8, "x " * 23), (9, "x " * 24)]
    found = periodic_runs.detect(frame(spark, docs, extra=True).withColumn("n_runs", F.lit("x")), doc_id="doc_id")
    got = [tuple(r) for r in found.select("row.doc_id", *[n for n, _ in periodic_runs.FIELDS[:-1]]).collect()]
    assert key(got) == key([digests_by_force(*r) for r in docs])
    assert any(r[1] for r in got)


def test_periodic_edge_cases(spark):
    assert periodic_runs.detect(frame(spark, [], extra=True)).count() == 0
    rows = periodic_runs.detect(frame(spark, [(1, None), (2, ""), (3, "a b " * 12), (None, "a " * 24)]), keep_text=True).collect()
    by = {r["row"]["doc_id"]: r for r in rows}
    assert by[1]["n_runs"] == by[2]["n_runs"] == 0 and by[1]["start"] is None and by[1]["collapsed"] == ""
    assert by[1]["runs_sha256"] == by[1]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (by[3]["start"], by[3]["length"], by[3]["period"], by[3]["exponent_milli"], by[3]["collapsed"]) == (0, 24, 2, 12_000, "a b")
    assert (by[None]["n_runs"], by[None]["period"], by[None]["collapsed"]) == (1, 1, "a")


def test_long_texts_take_time_in_proportion():
    n = 200_000
    assert periodic_runs.find_runs([[b"a"] * n]) == [[(0, n, 1)]]
    long = [b"%d" % (i % 30_011) for i in range(n)]
    assert periodic_runs.find_runs([long]) == [[(0, n, 30_011)]]
    assert periodic_runs.find_runs([[b"%d" % i for i in range(n)]]) == [[]]
