"""Quality rules by distribution divergence (operator 3).

Every text gets counts (words, symbols, repeated lines, repeated 8-word windows), a histogram
over character classes and a histogram over the common words of its language. The references
are learned from all documents of a language: the median share of each histogram bin, which a
third of junk or copied rows cannot move far. A document is rejected if a base rule fails or if
the Jensen-Shannon distance of one of its histograms to the reference is above the limit. The
limit for common words grows for short texts by what chance alone gives a clean text of as many
words; only texts below the minimum of characters are not judged by their character classes.

Two passes over the texts: the first yields a narrow histogram row a document, aggregated with
mergeable percentile sketches; the second yields the verdicts, with the references (at most one
small row for each language of :data:`COMMON_WORDS`) in the closure.

Defined results: a null or empty text has no words, fails the base rule and is not kept. Rows
are judged one by one, so repeated rows get equal results; an empty table gives no rows. A
language outside the table (or null) is compared with all references and the nearest counts.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import annotate, read_table

WORD = re.compile(r"[^ \t-\r]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of four languages.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch",
    "en": "the of and to in a is that for it as was with be by on not he are this",
    "es": "de la que el en y a los se del las un por con no una su para es al",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au",
}

#: Distances above these are a rejection; base-2 Jensen-Shannon distance, 0 to 1.
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.3
#: Texts with fewer characters are not judged by character classes and give no references.
MIN_CHARS = 200
#: From so many words on the limit of the word distance is MAX_WORD_DISTANCE, below it :func:`word_limits`.
MIN_WORDS = 200
#: Word references come from texts of MIN_WORDS if a language has so many, else from all texts.
LONG_TEXTS = 30
#: Standard deviations above the mean that the distance of a clean short text may have.
SPREAD = 4
#: Characters from here on count as one class.
TABLE_SIZE = 0x3000


def _class_table() -> np.ndarray:
    """Class of each code point: 0 vowel, 1 other lower-case ASCII, 2 upper case, 3 other letter,
    4 digit, 5 white space, 6 sentence mark, 7 symbol, 8 anything else."""
    table = np.full(TABLE_SIZE + 1, 8, np.uint8)
    for code in range(TABLE_SIZE):
        c = chr(code)
        if c in "aeiou":
            table[code] = 0
        elif "a" <= c <= "z":
            table[code] = 1
        elif c.isupper():
            table[code] = 2
        elif c.isalpha():
            table[code] = 3
        elif c.isdigit():
            table[code] = 4
        elif c.isspace():
            table[code] = 5
        elif c in ".,;:!?'\"()-":
            table[code] = 6
        elif code < 128:
            table[code] = 7
    return table


CLASSES = 9


def class_histogram(text: str, table: np.ndarray) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(table[np.minimum(codes, TABLE_SIZE)], minlength=CLASSES)


def repeated_words(docs: list[list[str]], window: int = WINDOW) -> list[int]:
    """For each list of words, how many lie in a window found twice or more in that list.

    Windows are numbered exactly by doubling: pairs of word numbers, pairs of those, and so on;
    word numbers are distinct between documents, so windows of two documents never agree.
    """
    starts = np.cumsum([0] + [len(d) for d in docs])
    numbers: list[int] = []
    free = 0
    for d in docs:
        own: dict[str, int] = {}
        numbers += [own.setdefault(w, free + len(own)) for w in d]
        free += len(own)
    rank = np.array(numbers, np.uint64)
    step = 1
    while step < window:
        if len(rank) <= step:
            return [0] * len(docs)
        code = (rank[:-step] << np.uint64(32)) | rank[step:]
        rank = pd.factorize(code)[0].astype(np.uint64)
        step *= 2
    total = int(starts[-1])
    inside = np.zeros(total + 1, bool)      # positions where a whole window fits into its document
    for s, e in zip(starts[:-1], starts[1:]):
        inside[s:max(s, e - window + 1)] = True
    at = np.flatnonzero(inside[:len(rank)])
    rank = rank[at].astype(np.int64)
    twice = at[np.bincount(rank)[rank] > 1] if len(rank) else at
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:total]) > 0)])
    return (covered[starts[1:]] - covered[starts[:-1]]).tolist()


def js_distances(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Base-2 Jensen-Shannon distance of every row (a histogram) to the histogram ``q``; an empty
    histogram has distance 1."""
    total = rows.sum(axis=1, keepdims=True)
    p = rows / np.where(total > 0, total, 1)
    q = np.broadcast_to(q / q.sum(), p.shape)
    m = (p + q) / 2

    def kl(a):
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    return np.where(total[:, 0] > 0, np.sqrt(np.maximum(0, (kl(p) + kl(q)) / 2)), 1.0)


class CommonWords:
    """Counts the common words of all languages in one pass over a text's distinct words."""

    def __init__(self):
        listed = {k: v.split() for k, v in COMMON_WORDS.items()}
        every = sorted(set().union(*listed.values()))
        place = {w: i for i, w in enumerate(every)}
        self.size = len(every)
        self.places = {k: np.array([place[w] for w in v]) for k, v in listed.items()}
        self.forms = {case + mark: i for w, i in place.items() for case in (w, w.capitalize(), w.upper())
                      for mark in ("", ",", ".", ";", ":", "!", "?")}

    def histograms(self, docs: list[list[str]]) -> np.ndarray:
        """A row for each list of words: the common words' counts, and last all its words."""
        out = np.zeros((len(docs), self.size + 1))
        for row, words in zip(out, docs):
            for w, c in Counter(words).items():
                i = self.forms.get(w)
                if i is not None:
                    row[i] += c
            row[-1] = len(words)
        return out

    def of(self, rows: np.ndarray, lang: str) -> np.ndarray:
        """The histograms of one language: its common words, and last all other words."""
        own = rows[:, self.places[lang]]
        return np.column_stack([own, rows[:, -1] - own.sum(axis=1)])


def word_limits(q: np.ndarray, most: float) -> np.ndarray:
    """Limit of the distance to the histogram ``q`` by number of words, below MIN_WORDS: the mean and
    SPREAD standard deviations of the divergence of texts drawn from ``q``, and at least ``most``."""
    q = q / q.sum()
    logs = np.concatenate([[0], np.cumsum(np.log(np.arange(1, MIN_WORDS)))])
    out = np.full(MIN_WORDS, 1.0)
    for n in range(1, MIN_WORDS):
        x = np.clip(q, 0.05 / n, 1 - 1e-9)[:, None]         # an empty bin: met in one text of twenty
        k = np.arange(n + 1)
        chance = np.exp(logs[n] - logs[k] - logs[n - k] + k * np.log(x) + (n - k) * np.log1p(-x))
        m = (k / n + x) / 2
        part = (np.where(k > 0, k / n * np.log2(np.maximum(k, 1) / n / m), 0) + x * np.log2(x / m)) / 2
        mean = (chance * part).sum(axis=1)
        var = (chance * part ** 2).sum(axis=1) - mean ** 2
        out[n] = max(most, np.sqrt(max(0, mean.sum() + SPREAD * np.sqrt(max(0, var.sum())))))
    return out


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """{lang: (character classes, common words)} of each language of the table: the median share of
    every histogram bin in all documents of MIN_CHARS. Medians of rare words in short texts are 0,
    so word shares are medians of the documents of MIN_WORDS; without LONG_TEXTS of them, the mean of
    the nine deciles of all documents."""
    both = docs.select(docs[f"`{lang}`"].cast("string").alias("lang"), docs[f"`{text}`"].cast("string").alias("text")) \
        .where(F.col("lang").isin(sorted(COMMON_WORDS))).select(F.concat_ws("\t", "lang", "text").alias("both"))
    fields = [("lang", T.StringType()), ("classes", T.ArrayType(T.DoubleType())),
              ("common", T.ArrayType(T.DoubleType())), ("long", T.BooleanType())]

    def make():
        table, common = _class_table(), CommonWords()

        def fn(rows):
            parted = [r.partition("\t") for r in rows]
            texts = [t for _, _, t in parted]
            words = [WORD.findall(t) for t in texts]
            judged = [len(t) >= MIN_CHARS and len(w) > 0 for t, w in zip(texts, words)]
            counted = common.histograms(words)
            return [[k if ok else None for (k, _, _), ok in zip(parted, judged)],
                    [(class_histogram(t, table) / len(t)).tolist() if ok else None for t, ok in zip(texts, judged)],
                    [(common.of(counted[i:i + 1], k)[0] / len(w)).tolist() if ok else None
                     for i, ((k, _, _), w, ok) in enumerate(zip(parted, words, judged))],
                    [len(w) >= MIN_WORDS for w in words]]
        return fn

    rows = annotate(both, "both", fields, make).where(F.col("lang").isNotNull())
    most = max(len(v.split()) for v in COMMON_WORDS.values()) + 1
    bins = [F.percentile_approx(F.get("classes", F.lit(i)), 0.5, 1000).alias(f"c{i}") for i in range(CLASSES)]
    common = [F.get("common", F.lit(i)) for i in range(most)]
    bins += [F.percentile_approx(F.when(F.col("long"), c), 0.5, 1000).alias(f"w{i}") for i, c in enumerate(common)]
    bins += [F.percentile_approx(c, [k / 10 for k in range(1, 10)], 1000).alias(f"s{i}") for i, c in enumerate(common)]
    bins.append(F.count_if("long").alias("long"))
    found = {}
    for r in rows.groupBy("lang").agg(*bins).collect():       # one row for each listed language at most
        classes = np.array([r[f"c{i}"] for i in range(CLASSES)])
        own = range(len(COMMON_WORDS[r["lang"]].split()) + 1)
        common = np.array([r[f"w{i}"] if r["long"] >= LONG_TEXTS else np.mean(r[f"s{i}"]) for i in own])
        if classes.sum() > 0 and common.sum() > 0:
            found[r["lang"]] = (classes, common)
    return found


FIELDS = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
          ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()),
          ("class_distance", T.DoubleType()), ("word_distance", T.DoubleType()), ("kept", T.BooleanType())]


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", references: dict | None = None,
          max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """``docs`` as struct ``row`` with the counts, both distances (null: not judged) and ``kept``."""
    if references is None:
        references = language_references(docs, text, lang)
    limits = [word_limits(w, max_word) for _, w in references.values()]

    def make():
        table, common = _class_table(), CommonWords()

        def fn(texts):
            texts = [t or "" for t in texts]
            words = [WORD.findall(t) for t in texts]
            repeats = repeated_words(words)
            if references and texts:
                classes = np.array([class_histogram(t, table) for t in texts], float)
                counted = common.histograms(words)
                by_class = np.min([js_distances(classes, c) for c, _ in references.values()], axis=0)
                every = np.array([js_distances(common.of(counted, k), w) for k, (_, w) in references.items()])
                nearest, by_word = every.argmin(axis=0), every.min(axis=0)
            rows = []
            for i, (t, own, repeat) in enumerate(zip(texts, words, repeats)):
                lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
                n = len(own)
                failed = n < 20 or 100 * repeat > 30 * n
                c = float(by_class[i]) if references and len(t) >= MIN_CHARS else None
                w = float(by_word[i]) if references and n else None
                most = limits[nearest[i]][n] if w is not None and n < MIN_WORDS else max_word
                kept = not (failed or (c or 0) > max_class or (w or 0) > most)
                rows.append((n, sum(map(len, own)), sum(map(t.count, SYMBOLS)), len(lines) - len(set(lines)),
                             repeat, failed, c, w, kept))
            return list(zip(*rows)) if rows else [[] for _ in FIELDS]
        return fn

    return annotate(docs, text, FIELDS, make)


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that no quality rule rejects, all their columns unchanged."""
    return judge(docs).where("kept").select("row.*")


def op3_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: base counts, base_failed, both distances and the verdict."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs).select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols",
                              "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                              "class_distance", "word_distance")
