"""Quality classifier by positive-unlabelled learning (operator 12).

Trusted positives are texts labelled good; every other text of the training folds is unlabelled web
text, whatever its label says, so a bad label is never read. A small network scores features of a
text's shape (character classes, repeats, words, lines). It minimises the non-negative unbiased
risk: with class prior p, ``p * R(positives as good) + max(0, R(unlabelled as bad) - p * R(positives
as bad))``; where the second part falls below zero, the step goes up that part alone, so the
network cannot win by calling the trusted positives' look-alikes bad.

The prior is estimated: a first network tells positives from unlabelled texts, and on rows it has not seen
the smallest ratio (unlabelled above a score) / (positives above it), with a margin for small
numbers, is the share of good texts, as some top scores hold good texts only.

The fit uses at most ``POSITIVES`` trusted and ``UNLABELLED`` other texts of the training folds,
those of smallest hash; they alone reach the driver, as feature rows. Scoring is one
pass over all texts. ``labels``, ``lang``, ``source`` and ``doc_id`` are no inputs of a score;
doc_id only decides the fold.

Defined results: a null or empty text has all features 0 and is scored like any other. A doc_id is
trusted if all its labels (in the training folds) are 1; null labels and null ids are not trusted. A null doc_id counts as the
empty text for the fold. Repeated rows get equal scores; an empty table gives no rows. Without
trusted positives or unlabelled texts nothing is learned and every score is the prior 0.5. Only the named
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import annotate, read_table
from quarry.llm.quality import TABLE_SIZE, _class_table

FOLDS, HELD_OUT = 3, 1
#: Bounds of the sample that the model is fitted on.
POSITIVES, UNLABELLED = 20_000, 20_000
HIDDEN, EPOCHS, BATCH, RATE = 16, 30, 256, 0.01
#: Steps of the sampling hash.
STEPS = 1 << 24
#: Rows above a score, at least, for the estimate of the prior.
LEAST_ABOVE = 100
CLASSES = 9


class Features:
    """Numbers that describe a text's shape; all but the last three are shares."""

    SIZE = CLASSES + 10

    def __init__(self):
        self.classes = _class_table()

    def of(self, text: str | None) -> np.ndarray:
        out = np.zeros(self.SIZE)
        if not text:
            return out
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.classes[np.minimum(codes, TABLE_SIZE)]
        out[:CLASSES] = np.bincount(kinds, minlength=CLASSES) / len(codes)
        same = codes[1:] == codes[:-1]
        odd = (kinds >= 6) & (codes != 0x20)
        more = [np.count_nonzero(same) / len(codes), np.count_nonzero(odd[1:] & odd[:-1]) / len(codes)]
        words = text.split()
        if words:
            n = len(words)
            counts = Counter(words)
            lines = [x for x in map(str.strip, text.split("\n")) if x]
            more += [sum(map(operator.eq, words, words[1:])) / n, len(counts) / n, max(counts.values()) / n,
                     len(set(zip(words, words[1:]))) / n, sum(map(str.isupper, words)) / n,
                     math.log1p(n), len(codes) / n, math.log1p(n / len(lines))]
        out[CLASSES:CLASSES + len(more)] = more
        return out

    def rows(self, texts: list) -> np.ndarray:
        return np.array([self.of(t) for t in texts]).reshape(-1, self.SIZE)


@dataclass
class Network:
    """One hidden layer over standardised features; ``odds`` are log-odds of a good text."""
    mean: np.ndarray
    scale: np.ndarray
    weights: list

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def odds(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh(self.scaled(x) @ w1 + b1) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.odds(x))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def new_network(x: np.ndarray, seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    scale = x.std(axis=0)
    d = x.shape[1]
    return Network(x.mean(axis=0), np.where(scale > 1e-9, scale, 1.0),
                   [rng.normal(0, 1 / math.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN),
                    rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), np.zeros(1)])


class _Adam:
    def __init__(self, weights: list, rate: float):
        self.rate, self.t = rate, 0
        self.m, self.v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def step(self, weights: list, gradients: list) -> None:
        self.t += 1
        for w, g, m, v in zip(weights, gradients, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)


def _gradients(net: Network, x: np.ndarray, pull: np.ndarray) -> list:
    """Gradients of a loss whose derivative by the log-odds of every row is ``pull``."""
    w1, b1, w2, _ = net.weights
    hidden = np.tanh(x @ w1 + b1)
    back = np.outer(pull, w2) * (1 - hidden * hidden)
    return [x.T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ pull + 1e-4 * w2, np.array([pull.sum()])]


def _batches(rng, rows_p: int, rows_u: int, epochs: int):
    """Index pairs: every unlabelled row once an epoch, the positives dealt to as many batches."""
    n = max(1, math.ceil(max(rows_p, rows_u) / BATCH))
    for _ in range(epochs):
        p, u = rng.permutation(rows_p), rng.permutation(rows_u)
        for i in range(n):
            a, b = p[i * rows_p // n:(i + 1) * rows_p // n], u[i * rows_u // n:(i + 1) * rows_u // n]
            if len(a) and len(b):
                yield a, b


def fit_apart(p: np.ndarray, u: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """A network that tells positives from unlabelled rows (both weigh the same)."""
    net, rng = new_network(np.concatenate([p, u]), seed), np.random.default_rng(seed)
    xp, xu, adam = net.scaled(p), net.scaled(u), _Adam(net.weights, RATE)
    for a, b in _batches(rng, len(p), len(u), epochs):
        x = np.concatenate([xp[a], xu[b]])
        g = _sigmoid(np.tanh(x @ net.weights[0] + net.weights[1]) @ net.weights[2] + net.weights[3][0])
        g[:len(a)] -= 1
        g[:len(a)] /= len(a)
        g[len(a):] /= len(b)
        adam.step(net.weights, _gradients(net, x, g))
    return net


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of good rows among the unlabelled ones."""
    half_p, half_u = len(p) // 2, len(u) // 2
    if min(half_p, half_u) < 2:
        return 0.5
    net = fit_apart(p[:half_p], u[:half_u], max(1, EPOCHS // 3))
    sp, su = np.sort(net.odds(p[half_p:])), np.sort(net.odds(u[half_u:]))
    cuts = np.unique(sp)
    above_p, above_u = len(sp) - np.searchsorted(sp, cuts), len(su) - np.searchsorted(su, cuts)
    enough = above_p >= min(LEAST_ABOVE, len(sp))
    share_p, share_u = above_p[enough] / len(sp), above_u[enough] / len(su)
    margin = math.sqrt(math.log(40) / (2 * len(sp))) + math.sqrt(math.log(40) / (2 * len(su)))
    best = int(np.argmin((share_u + margin) / share_p))
    return float(np.clip(share_u[best] / share_p[best], 0.01, 0.99))


def fit(p: np.ndarray, u: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Minimises the non-negative unbiased risk of the logistic loss."""
    net, rng = new_network(u, seed), np.random.default_rng(seed)
    xp, xu, adam = net.scaled(p), net.scaled(u), _Adam(net.weights, RATE)
    for a, b in _batches(rng, len(p), len(u), epochs):
        x, k = np.concatenate([xp[a], xu[b]]), len(a)
        z = np.tanh(x @ net.weights[0] + net.weights[1]) @ net.weights[2] + net.weights[3][0]
        s = _sigmoid(z)
        bad = np.logaddexp(0, z)                        # loss of the log-odds z where the truth is bad
        negative = bad[k:].mean() - prior * bad[:k].mean()
        pull_bad = np.concatenate([-prior * s[:k] / k, s[k:] / len(b)])
        if negative >= 0:
            pull = pull_bad
            pull[:k] += prior * (s[:k] - 1) / k
        else:
            pull = -pull_bad
        adam.step(net.weights, _gradients(net, x, pull))
    return net


def held_out(doc_id) -> F.Column:
    """crc32 of the doc_id as text (null: the empty text) leaves the remainder of the held-out fold."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


def _few(rows: DataFrame, limit: int, total: int) -> DataFrame:
    """At most ``limit`` rows, those of smallest ``h``; tasks sort little more than that together."""
    share = min(STEPS, int(1.1 * STEPS * limit / max(1, total)) + 1)
    return rows.where(F.pmod("h", F.lit(STEPS)) < share).orderBy("h").limit(limit)


def sample(docs: DataFrame, labels: DataFrame, quality: str = "quality", label_id: str = "doc_id",
           positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of trusted and of unlabelled texts. docs: (doc_id, text)."""
    good = F.coalesce(labels[f"`{quality}`"] == 1, F.lit(False))
    trusted = labels.select(labels[f"`{label_id}`"].cast("long").alias("doc_id"), good.alias("good")) \
        .where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.bool_and("good").alias("good")).where("good").select("doc_id", F.xxhash64("doc_id").alias("h"))
    ids = [r[0] for r in _few(trusted, positives, trusted.count()).select("doc_id").collect()]      # POSITIVES at most
    own = docs.where(~held_out(F.col("doc_id")))
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    hashed = own.withColumn("h", F.xxhash64("doc_id", "text"))

    def features(rows):
        def make():
            shape = Features()
            return lambda texts: [shape.rows(texts).tolist()]
        found = annotate(rows, "text", [("x", T.ArrayType(T.DoubleType()))], make)
        return np.array([r["x"] for r in found.select("x").collect()], float).reshape(-1, Features.SIZE)

    p = features(hashed.join(F.broadcast(chosen), "doc_id", "left_semi").orderBy("h").limit(positives))
    u = features(_few(hashed, unlabelled, own.count()))
    order = np.random.default_rng(7)
    return p[order.permutation(len(p))], u[order.permutation(len(u))]


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    own = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    p, u = sample(own, labels, quality, positives=positives, unlabelled=unlabelled)
    net = fit(p, u, estimate_prior(p, u)) if len(p) and len(u) else None

    def make():
        shape = Features()
        return lambda texts: [net.score(shape.rows(texts)) if net and texts else np.full(len(texts), 0.5)]

    rows = annotate(own, "text", [("score", T.DoubleType())], make)
    ident = F.col("row.doc_id")
    return rows.select(ident.alias("doc_id"), held_out(ident).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``, learned from ``labels.quality`` of the training folds."""
    return score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
