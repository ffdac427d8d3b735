"""Periodic run detection by recursive frequency splitting (operator 13).

A run is a stretch of consecutive words with smallest period q, of at least ``max(24, 3 * q)``
words, that no neighbouring word extends. Every word of a run occurs at least three times in it,
so a word that occurs less often in a segment lies in no run of that segment and splits it. Split
segments are counted again, until no word is too rare; segments below 24 words go. Ordinary prose
falls apart in a few rounds, for all texts of a batch at once.

The segments that survive are scanned by lag. Lags below 16 are compared at every word. A longer lag
q of an octave [Q, 2Q) leaves at least 2Q equal words in a run, hence one whole aligned block of
Q words that recurs q words later: blocks of Q words get exact numbers (pairs of numbers of the
octave before), and every aligned block is compared with the Q numbers that follow it. Only
lags found so are extended word by word. A text of n words costs O(n log n), also where it is one
long run: a block inside a run whose period divides the lag is known and passed over.

Defined results: a null or empty text has no words and no runs (four nulls, digests of the empty
string). Rows are judged one by one, so repeated rows get equal results and an empty table gives
no rows. Input columns stay apart, so their names cannot clash. :func:`made_periodic`, the query's
stated change of every tenth text, leaves rows without a doc_id as they are.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import annotate, read_table

#: A run has at least so many words, and its period at least so many times.
LEAST, TIMES = 24, 3
#: Lags below this are compared at every word.
SHORT_LAGS = 16


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()            # ASCII white space


def made_periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's change: if crc32 of the decimal doc_id is divisible by ten, the words from a
    place on repeat with a period, both derived from that number."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def split_by_frequency(codes: np.ndarray, segment: np.ndarray) -> list[np.ndarray]:
    """Positions, as runs of neighbours, that are left when words too rare in their segment have split
    it as often as that happens. ``codes``: word numbers; ``segment``: ascending number of each text."""
    at = np.arange(len(codes))
    size = int(codes.max()) + 1 if len(codes) else 1
    while len(at):
        # a new segment starts where a position is missing or the text changes
        fresh = np.append(True, (np.diff(at) > 1) | (np.diff(segment[at]) > 0))
        number = np.cumsum(fresh) - 1
        length = np.bincount(number)
        place = pd.factorize(number * size + codes[at])[0]
        stay = (np.bincount(place)[place] >= TIMES) & (length[number] >= LEAST)
        if stay.all():
            return np.split(at, np.flatnonzero(fresh)[1:])
        at = at[stay]
    return []


def _stretches(equal: np.ndarray, least: int):
    """(start, end) of the runs of True with at least ``least`` members."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    long = edge[1::2] - edge[::2] >= least
    return zip(edge[::2][long].tolist(), edge[1::2][long].tolist())


def _reach(x: np.ndarray, left: int, right: int, step: int) -> int:
    """How many words from ``left`` and ``right`` on, in direction ``step``, agree."""
    n, width = 0, 64
    room = min(left, right) + 1 if step < 0 else len(x) - max(left, right)
    while n < room:
        k = min(width, room - n)
        if step > 0:
            same = x[left + n:left + n + k] == x[right + n:right + n + k]
        else:
            same = (x[left - n - k + 1:left - n + 1] == x[right - n - k + 1:right - n + 1])[::-1]
        if not same.all():
            return n + int(np.argmin(same))
        n, width = n + k, width * 2
    return n


class _Found:
    """Runs met so far, by their extent. Periods come in ascending order, so the first that has an
    extent is the smallest."""

    def __init__(self):
        self.runs: dict[tuple, int] = {}

    def add(self, start: int, end: int, q: int) -> None:
        if end - start >= max(LEAST, TIMES * q):
            self.runs.setdefault((start, end), q)


def runs_in(segments: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs within segments of word numbers, laid end to end with one
    foreign word behind each; positions count those too."""
    if not segments:
        return []
    top = max(int(s.max()) for s in segments) + 1
    x = np.concatenate([np.append(s, top + i) for i, s in enumerate(segments)]).astype(np.int64)
    lengths = np.array([len(s) + 1 for s in segments])
    found = _Found()
    for q in range(1, min(SHORT_LAGS, len(x) // TIMES + 1)):
        for s, e in _stretches(x[:-q] == x[q:], max(LEAST, TIMES * q) - q):
            found.add(s, e + q, q)

    # numbers of blocks of 1, 2, 4, ... words; from an octave on only segments that can hold its lags
    name, at, block = pd.factorize(x)[0].astype(np.int64), np.arange(len(x)), 1
    while True:
        if block >= SHORT_LAGS:
            _octave(x, name, at, block, found)
        enough = lengths - 1 >= TIMES * 2 * block
        keep = np.repeat(enough, lengths)
        if not keep.any():
            return [(s, e, q) for (s, e), q in sorted(found.runs.items())]
        name, at, lengths = name[keep], at[keep], lengths[enough]
        follow = np.append(name[block:], np.full(min(block, len(name)), -1))
        # a block that reaches over a segment's end holds its foreign word, which is nowhere else;
        # behind the last segment there is nothing, so blocks there get numbers of their own
        pair = (name + 1) * (int(name.max()) + 2) + follow + 1
        cut = follow < 0
        pair[cut] = -1 - np.arange(int(cut.sum()))
        name, block = pd.factorize(pair)[0].astype(np.int64), block * 2


def _octave(x: np.ndarray, name: np.ndarray, at: np.ndarray, block: int, found: _Found) -> None:
    """Runs with periods in [block, 2 * block). ``at``: positions of the numbers in ``x``."""
    rows = len(name) // block + 1
    grid = np.concatenate([name, -1 - np.arange(rows * block - len(name))]).reshape(rows, block)
    j, r = np.nonzero(grid[1:] == grid[:-1, :1])        # lag block + r behind aligned block j
    if not len(j):
        return
    known = sorted((s, e, q) for (s, e), q in found.runs.items() if q <= block)
    if known:       # runs of one period overlap by less than it: the last that starts at p or before reaches farthest
        candidates = np.zeros(len(j), bool)
        start, lag = at[j * block], block + r
        periods: dict[int, list] = {}
        for s, e, q in known:
            periods.setdefault(q, []).append((s, e))
        for q, spans in periods.items():
            s, e = np.array(spans).T
            i = np.searchsorted(s, start, side="right") - 1
            candidates |= (i >= 0) & (lag % q == 0) & (start + lag + block <= e[np.maximum(i, 0)])
        j, r = j[~candidates], r[~candidates]
    met: dict[int, int] = {}
    hits = []
    for k in np.lexsort((j, r)):
        q, p = block + int(r[k]), int(at[j[k] * block])
        if p < met.get(q, -1):                          # inside the last stretch of this lag
            continue
        start = p - _reach(x, p - 1, p - 1 + q, -1) if p else 0
        end = p + _reach(x, p, p + q, 1)
        met[q] = end
        hits.append((q, start, end + q))
    for q, start, end in hits:                          # ascending lags
        found.add(start, end, q)


def find_runs(docs: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs (start, length, period) by start, then period."""
    lengths = np.array([len(d) for d in docs], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    out: list[list] = [[] for _ in docs]
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for d in docs for w in d], np.int64)
    left = split_by_frequency(codes, np.repeat(np.arange(len(docs)), lengths))
    if not left:
        return out
    # position of every segment among the segments laid end to end, one foreign word behind each
    laid = np.cumsum([0] + [len(s) + 1 for s in left])
    for s, e, q in runs_in([codes[a] for a in left]):
        k = int(np.searchsorted(laid, s, side="right")) - 1
        first = int(left[k][0]) + s - int(laid[k])
        doc = int(np.searchsorted(starts, first, side="right")) - 1
        out[doc].append((first - int(starts[doc]), e - s, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple | None:
    """The run of greatest exact length / period; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that some run holds behind its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    inside = np.cumsum(edge[:-1]) > 0
    return [w for w, gone in zip(words, inside.tolist()) if not gone]


FIELDS = [("n_runs", T.LongType()), ("start", T.LongType()), ("length", T.LongType()), ("period", T.LongType()),
          ("exponent_milli", T.LongType()), ("runs_sha256", T.StringType()), ("collapsed_sha256", T.StringType()),
          ("collapsed", T.StringType())]


def detect(docs: DataFrame, text: str = "text", doc_id: str | None = None, keep_text: bool = False) -> DataFrame:
    """``docs`` as struct ``row`` with its runs: number, strongest run, digest of all, digest of the text
    without the repeated words (and that text in ``collapsed``, if asked for; else null). With ``doc_id``
    the texts are first changed by :func:`made_periodic`."""
    text_type, made = docs.schema[text].dataType, doc_id is not None
    if made:        # the row map sees one column: id and text travel together
        ident = F.col(f"`{doc_id}`").cast("string")
        joined = F.when(ident.isNull(), F.concat(F.lit(" "), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))) \
            .otherwise(F.concat(ident, F.lit(" "), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))))
        docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), joined.alias("both"))

    def make():
        def fn(texts):
            if made:
                pairs = [t.partition(" ") for t in texts]
                words = [made_periodic(int(i) if i else None, words_of(t)) for i, _, t in pairs]
            else:
                words = [words_of(t) for t in texts]
            rows = []
            for own, runs in zip(words, find_runs(words)):
                best = strongest(runs)
                kept = b" ".join(collapse(own, runs))
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                rows.append((len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                             hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
                             kept.decode() if keep_text else None))
            return list(zip(*rows)) if rows else [[] for _ in FIELDS]
        return fn

    found = annotate(docs, "both" if made else text, FIELDS, make)
    return found.select(F.col("row.own").alias("row"), *[n for n, _ in FIELDS]) if made else found


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``, every tenth text made periodic as the contract states."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return detect(docs, doc_id="doc_id").select(F.col("row.doc_id").alias("doc_id"), *[n for n, _ in FIELDS[:-1]])
