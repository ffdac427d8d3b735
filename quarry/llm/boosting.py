"""Gradient-boosted trees, applied as one SQL expression.

Fitting is logistic-loss boosting over quantile-binned features: with numpy on a matrix
(:func:`fit`), or for several models at once on all rows of a table (:func:`fit_all`).
:meth:`Boosted.sql` writes the trees as nested CASE expressions, so scoring stays inside Spark's
generated code and needs neither Python workers nor a broadcast. Null features count as 0.

:func:`fit_all` first counts equal rows (:func:`counted`); every level of a tree is then one Spark
aggregation (SQL functions alone) that adds up gradients by node, feature and bin. The driver gets
these sums only: as many as there are bins, whatever the number of rows. They are whole numbers
(gradients in units of 1 / ``UNIT``), so the models do not depend on how rows lie in partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import discard, materialize

#: Gradients are counted in this part of one.
UNIT = 1 << 24
#: Steps of a score (log-odds) that :func:`score_counts` tells apart.
SCORE_STEPS = 1024
#: Trees after which scores are written, so that expressions stay short.
WRITTEN_TREES = 5


@dataclass
class Boosted:
    """``trees``: a leaf value, or (feature, threshold, tree for <=, tree for >)."""
    bias: float
    trees: list

    def sql(self, features: list[str]) -> str:
        """Log-odds as an SQL expression; ``features`` are SQL expressions in fitting order."""
        def one(t) -> str:
            if not isinstance(t, tuple):
                return f"{t!r}D"
            return f"CASE WHEN coalesce({features[t[0]]}, 0) <= {t[1]!r}D THEN {one(t[2])} ELSE {one(t[3])} END"
        return " + ".join([f"{self.bias!r}D", *map(one, self.trees)])

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of every row of ``x``."""
        def one(t, rows):
            if not isinstance(t, tuple):
                return np.full(len(rows), t)
            left = rows[:, t[0]] <= t[1]
            out = np.empty(len(rows))
            out[left], out[~left] = one(t[2], rows[left]), one(t[3], rows[~left])
            return out
        return self.bias + sum((one(t, x) for t in self.trees), np.zeros(len(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3,
        bins: int = 32, l2: float = 1.0, min_rows: int = 10) -> Boosted:
    """Boosted trees for labels ``y`` in {0, 1}; one class only gives a constant."""
    mean = min(max(float(np.mean(y)) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    model = Boosted(float(np.log(mean / (1 - mean))), [])
    if len(np.unique(y)) < 2:
        return model
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    codes = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])
    score = np.full(len(y), model.bias)

    def grow(rows, g, h, left_depth):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        value = float(-rate * total_g / (total_h + l2))
        best = (1e-6, None, None)
        if left_depth and len(rows) >= 2 * min_rows:
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                sums = [np.cumsum(np.bincount(codes[rows, f], w, len(cut) + 1))[:-1]
                        for w in (g[rows], h[rows], np.ones(len(rows)))]
                gl, hl, nl = sums
                ok = (nl >= min_rows) & (len(rows) - nl >= min_rows)
                gain = np.where(ok, gl ** 2 / (hl + l2) + (total_g - gl) ** 2 / (total_h - hl + l2)
                                - total_g ** 2 / (total_h + l2), 0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
        if best[1] is None:
            score[rows] += value
            return value
        f, k = best[1:]
        below = codes[rows, f] <= k
        return (f, float(cuts[f][k]), grow(rows[below], g, h, left_depth - 1), grow(rows[~below], g, h, left_depth - 1))

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        model.trees.append(grow(np.arange(len(y)), p - y, p * (1 - p), depth))
    return model


def bounded_sample(rows: DataFrame, limit: int) -> np.ndarray:
    """At most ``limit`` rows (numbers only, and ``_order``: a hash that tells rows apart), those of the
    smallest hashes, as a matrix. Tasks send the driver about ``limit`` rows together, however many
    tasks there are."""
    steps = 1 << 24
    share = min(steps, int(1.1 * steps * limit / max(1, rows.count())) + 1)
    few = rows.where(F.pmod("_order", F.lit(steps)) < share).orderBy("_order").limit(limit).drop("_order")
    return np.array([tuple(r) for r in few.collect()], float).reshape(-1, len(few.columns))


class _Open:
    """A node that is still to be split or to become a leaf."""

    def __init__(self, number: int):
        self.number = number


def _case(trees: dict[int, tuple], leaf) -> str:
    """SQL: ``leaf(node)`` of the node of its kind's binned tree that a row of ``codes`` ends in."""
    def one(t) -> str:
        return f"CASE WHEN codes[{t[0]}] <= {t[1]} THEN {one(t[2])} ELSE {one(t[3])} END" if isinstance(t, tuple) else leaf(t)
    return f"CASE kind {' '.join(f'WHEN {kind} THEN {one(t)}' for kind, t in trees.items())} END"


def quantile_cuts(rows: DataFrame, features: list[str], bins: int = 32) -> dict[int, list[np.ndarray]]:
    """{kind: cuts of each feature}: the quantiles of all ``rows``."""
    shares = ", ".join(repr(float(q)) for q in np.linspace(0, 1, bins + 1)[1:-1])
    found = rows.groupBy("kind").agg(*[F.expr(f"percentile(coalesce(`{f}`, 0), array({shares}))").alias(f) for f in features])
    return {r["kind"]: [np.unique(r[f]) for f in features] for r in found.collect()}


def counted(rows: DataFrame, features: list[str], cuts: dict[int, list[np.ndarray]]) -> DataFrame:
    """``rows`` (kind, hit: 0 or 1, features) as kind, ``codes`` (the bin of each feature) and the number of
    rows and positive ones, in two halves: ``n``, ``hits`` to fit and ``held_n``, ``held_hits`` held
    out. Equal rows are dealt out evenly, an odd one by its hash."""
    def code(i: int, feature: str) -> str:
        lists = " ".join(f"WHEN {kind} THEN array({', '.join(f'{float(c)!r}D' for c in own[i])})" for kind, own in cuts.items())
        return f"size(filter(CASE kind {lists} END, _cut -> _cut < coalesce(`{feature}`, 0)))"

    codes = f"array({', '.join(code(i, f) for i, f in enumerate(features))})"
    cells = rows.select("kind", F.col("hit").cast("long").alias("hit"), F.expr(codes).alias("codes")).groupBy("kind", "codes").agg(
        F.sum("hit").alias("p"), (F.count(F.lit(1)) - F.sum("hit")).alias("q"))
    half = "{c} div 2 + if({c} % 2 = 1, pmod(xxhash64(codes, kind, '{c}'), 2), 0)"
    cells = cells.select("*", F.expr(half.format(c="p")).alias("hp"), F.expr(half.format(c="q")).alias("hq"))
    return cells.selectExpr("kind", "codes", "p + q - hp - hq as n", "p - hp as hits", "hp + hq as held_n", "hp as held_hits")


def _histograms(scored: DataFrame, growing: dict[int, tuple], features: int, width: int) -> dict[int, np.ndarray]:
    """{kind: sums of gradient, curvature and rows by open node, feature and bin}; ``growing`` is
    {kind: (tree, number of open nodes)}."""
    node = _case({k: tree for k, (tree, _) in growing.items()}, lambda v: str(v.number) if isinstance(v, _Open) else "-1")
    rows = scored.where(F.col("kind").isin(list(growing))).select("kind", "codes", "n", "hits", F.expr(node).alias("node"),
                                                                  F.expr("1 / (1 + exp(-score))").alias("p"))
    rows = rows.where("node >= 0").selectExpr("kind", "node", "posexplode(codes) as (f, bin)", "n", f"n * bigint(rint(p * {UNIT})) - hits * {UNIT} as g",
                                              f"n * bigint(rint(p * (1 - p) * {UNIT})) as h")
    out = {kind: np.zeros((number, features, width, 3)) for kind, (_, number) in growing.items()}
    for kind, at, f, b, g, h, n in rows.groupBy("kind", "node", "f", "bin").agg(F.sum("g"), F.sum("h"), F.sum("n")).collect():
        out[kind][at, f, b] = g / UNIT, h / UNIT, n
    return out


def fit_all(cells: DataFrame, cuts: dict[int, list[np.ndarray]], trees: int = 30, depth: int = 3, rate: float = 0.3,
            l2: float = 1.0, min_rows: int = 10) -> tuple[dict[int, Boosted], DataFrame]:
    """Boosted trees for every kind of :func:`counted` ``cells``, as :func:`fit` makes them, and the
    cells of these kinds with their ``score``. A kind with fewer than ``min_rows`` rows of a class
    has no model: no leaf could tell them from the others."""
    totals = cells.groupBy("kind").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()
    bias = {r["kind"]: float(np.log(m / (1 - m))) for r in totals if min(r["hits"], r["n"] - r["hits"]) >= min_rows
            for m in [min(max(r["hits"] / r["n"], 1e-3), 1 - 1e-3)]}
    if not bias:
        return {}, cells.where("false").withColumn("score", F.lit(0.0))
    width = 1 + max(len(c) for kind in bias for c in cuts[kind])
    features = len(cuts[next(iter(bias))])
    done: dict[int, list] = {kind: [] for kind in bias}

    def split(sums: np.ndarray, kind: int, level: int, opened: list):
        """A node as (feature, bin, child, child) or a leaf; children on the last level are leaves."""
        g, h, n = sums[0].sum(axis=0)       # every feature deals out all rows of the node
        best = (1e-6, None, None)
        if n >= 2 * min_rows:
            for f, cut in enumerate(cuts[kind]):
                gl, hl, nl = np.cumsum(sums[f, :len(cut)], axis=0).T
                ok = (nl >= min_rows) & (n - nl >= min_rows)
                gain = np.where(ok, gl ** 2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g ** 2 / (h + l2), 0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
        if best[1] is None:
            return float(-rate * g / (h + l2))
        f, k = best[1:]
        if level + 1 < depth:
            opened += [_Open(len(opened)), _Open(len(opened) + 1)]
            return (f, k, opened[-2], opened[-1])
        gl, hl, _ = sums[f, :k + 1].sum(axis=0)
        return (f, k, float(-rate * gl / (hl + l2)), float(-rate * (g - gl) / (h - hl + l2)))

    def put(tree, nodes: list):
        if isinstance(tree, _Open):
            return nodes[tree.number]
        return (tree[0], tree[1], put(tree[2], nodes), put(tree[3], nodes)) if isinstance(tree, tuple) else tree

    def values(tree, cut):
        return (tree[0], float(cut[tree[0]][tree[1]]), values(tree[2], cut), values(tree[3], cut)) if isinstance(tree, tuple) else tree

    scored = cells.where(F.col("kind").isin(list(bias))).withColumn("score", F.expr(_case(bias, lambda v: f"{v!r}D")))
    written = None
    for t in range(1, trees + 1):
        growing = {kind: (_Open(0), 1) for kind in bias}
        for level in range(depth):
            open_ones = {kind: own for kind, own in growing.items() if own[1]}
            if not open_ones:
                break
            for kind, sums in _histograms(scored, open_ones, features, width).items():
                opened: list = []
                nodes = [split(node, kind, level, opened) for node in sums]
                growing[kind] = (put(growing[kind][0], nodes), len(opened))
        for kind, (tree, _) in growing.items():
            done[kind].append(tree)
        scored = scored.withColumn("score", F.expr("score + " + _case({k: own[-1] for k, own in done.items()}, lambda v: f"{v!r}D")))
        if t % WRITTEN_TREES == 0 or t == trees:
            before, written = written, materialize(scored, "boosting-scores")
            scored = written.select("*")
            if before is not None:
                discard(before)
    return {kind: Boosted(bias[kind], [values(t, cuts[kind]) for t in done[kind]]) for kind in bias}, written


def score_counts(scored: DataFrame) -> dict[int, np.ndarray]:
    """{kind: rows of (score, held-out rows, hits)} of :func:`fit_all`'s cells, scores rounded down to a step."""
    rows = scored.where("held_n > 0").groupBy("kind", F.expr(f"floor(score * {SCORE_STEPS})").alias("step")).agg(
        F.sum("held_n").alias("n"), F.sum("held_hits").alias("hits")).collect()
    return {kind: np.array([(r["step"] / SCORE_STEPS, r["n"], r["hits"]) for r in rows if r["kind"] == kind], float)
            for kind in sorted({r["kind"] for r in rows})}


def threshold_for_precision(scores: np.ndarray, y: np.ndarray, precision: float, least: int = 20,
                            rows: np.ndarray | None = None) -> float | None:
    """Lowest score from which on at least ``precision`` of the rows are positive, with at least
    ``least`` rows; None if there is none. The precision counts a pseudo-negative (a calibrated
    estimate on held-out rows is never 1). With ``rows`` an entry stands for so many rows, ``y`` of them positive."""
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(y[order])
    n = np.arange(1, len(s) + 1) if rows is None else np.cumsum(rows[order])
    last = np.append(s[1:] != s[:-1], True) if len(s) else np.zeros(0, bool)    # ties go together
    ok = np.flatnonzero(last & (n >= least) & (hits / (n + 1) >= precision))
    return float(s[ok[-1]]) if len(ok) else None
