"""Repeated-substring removal by prefix-free parsing (operator 1).

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere else is removed.

Parse. A hash of all 32-byte strings picks triggers: in every string of LENGTH bytes the
position of its smallest hash. Equal strings have their trigger at the same place, so each
trigger's phrase - the bytes around it that any such string through it can reach - decides on its
own which of them repeat. The corpus becomes a parse: one narrow row a trigger, with the hash of
the trigger and of its phrase, about one for 185 bytes.

Dictionary. A phrase that occurs twice repeats whole, by the parse alone. Only triggers that occur
in different phrases need bytes: each distinct phrase enters the dictionary once, however often it
occurs. Within a trigger, the phrases' suffixes are ordered by the fingerprint of their first LENGTH
bytes, one column for each distance from the trigger; neighbours in that order that agree are
repeats. All strings through a trigger overlap, so what repeats of a phrase is one run.

Combination. Each phrase's run goes back to the parse, the runs of a document are merged, and the
rest is hashed. Texts are dealt out twice (dictionary, removal); everything else is narrow. A
trigger with more than ``GROUP`` distinct phrases is not gathered: its phrases are grouped by the bytes
before and by the bytes behind it, and where that leaves as many, their fingerprints are counted by a
shuffle. All three give the same runs.

Fingerprints are 64 bits wide and compared within a trigger only. Phrases are hashed by BLAKE2; strings by
doubling with a scrambling step at each level, in which structured text cannot cancel as it
does in a polynomial modulo a power of two. Defined results: null counts as empty; texts shorter than LENGTH
keep all bytes; repeated rows are repeats of each other (also rows of one doc_id); matches never
cross documents; an empty table gives no rows; long texts are parsed in segments.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import materialize, pieces, read_table

LENGTH = 400
GRAM = 32
#: How far a LENGTH-byte string through a trigger can start before it.
REACH = LENGTH - GRAM
#: String starts parsed at a time.
SEGMENT = 1 << 19
#: Distinct phrases of one trigger that are compared in memory, at most.
GROUP = 16_384
#: Of a string's bytes besides the trigger's, half lie on one side of it.
SIDE = REACH // 2
#: Phrases compared in one step.
STEP = 2048

U = np.uint64


def mix(x):
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Prints:
    """Fingerprints of all strings of one length at once, by halves: eight bytes are a number of their
    own, and each doubling combines two neighbours and scrambles the result. No sum runs
    through a string, so nothing in its structure can cancel."""

    FACTOR = U(0x9E3779B97F4A7C15)

    def __init__(self, key: int = 0xD1B54A32D192ED03):
        self.key = U(key)

    def doubled(self, x: np.ndarray, step: int) -> np.ndarray:
        return mix(x[..., :-step] * self.FACTOR + x[..., step:])

    def levels(self, data: np.ndarray, size: int) -> dict[int, np.ndarray]:
        """For 8, 16, ... ``size``: the prints of all strings of so many bytes along the last axis."""
        x = data.astype(np.uint64)
        for step in (1, 2, 4):
            x = x[..., :-step] | (x[..., step:] << U(8 * step))
        out, n = {8: mix(x ^ self.key)}, 8
        while n < size:
            out[2 * n] = self.doubled(out[n], n)
            n *= 2
        return out

    def grams(self, data: np.ndarray) -> np.ndarray:
        """Prints of all GRAM-byte strings."""
        return self.levels(data, GRAM)[GRAM]

    def strings(self, data: np.ndarray) -> np.ndarray:
        """Prints of all LENGTH-byte strings along the last axis: its powers of two, from the largest on."""
        parts = self.levels(data, 1 << (LENGTH.bit_length() - 1))
        count, at, out = data.shape[-1] - LENGTH + 1, 0, None
        for size in sorted(parts, reverse=True):
            if LENGTH & size:
                part = parts[size][..., at:at + count]
                out = part if out is None else mix(out * self.FACTOR + part)
                at += size
        return out


def whole_print(data: bytes) -> int:
    """64 bits of a phrase (BLAKE2), as a signed number."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values (block prefix and suffix minima)."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, ~U(0))
    padded[:len(values)] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).reshape(-1)
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def parse(data: np.ndarray, prints: Prints, segment: int = SEGMENT):
    """(position, bytes before, bytes after, trigger hash, phrase hash) arrays of a text's triggers."""
    n, last, out, raw = len(data), -1, [], data.tobytes()
    for p in range(0, n - LENGTH + 1, segment):
        end = min(p + segment, n - LENGTH + 1)              # starts p .. end - 1
        grams = prints.grams(data[p:end + LENGTH - 1])      # those that strings of this segment hold
        # equal hashes: the rightmost position wins, wherever the string lies
        packed = (grams >> U(21) << U(21)) | (U((1 << 21) - 1) - np.arange(len(grams), dtype=np.uint64))
        least = smallest(packed, REACH + 1)
        where = ((U(1 << 21) - U(1)) - (least & U((1 << 21) - 1))).astype(np.int64)
        where = where[np.append(True, where[1:] != where[:-1])]
        where = where[where + p > last]
        if not len(where):
            continue
        position = where + p
        last = int(position[-1])
        before, after = np.minimum(position, REACH), np.minimum(n - position, LENGTH)
        phrase = np.array([whole_print(raw[i - b:i + a] + b.to_bytes(2)) for i, b, a
                           in zip(position.tolist(), before.tolist(), after.tolist())], np.int64)
        out.append((position, before, after, grams[where], phrase))
    return [np.concatenate(c) for c in zip(*out)] if out else None


def _with_key(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(doc_id, d, th, text): d and th tell texts apart; repeated rows share them."""
    t = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    return docs.select(docs[f"`{id_column}`"].cast("long").alias("doc_id"), t.alias("text")) \
        .select("doc_id", F.coalesce("doc_id", F.lit(-1)).alias("d"), F.xxhash64("text").alias("th"), "text")


PARSE = "d long, th long, pos long, before int, after int, trigger long, phrase long"


def parse_documents(docs: DataFrame) -> DataFrame:
    """One row for each trigger of (d, th, text) rows."""
    names = ["d", "th", "pos", "before", "after", "trigger", "phrase"]

    def run(batches):
        prints = Prints()
        for batch in batches:
            for piece in pieces(batch, 2):
                parts = []
                for d, th, t in zip(*[piece.column(i).to_pylist() for i in range(3)]):
                    data = np.frombuffer(t.encode(), np.uint8)
                    found = parse(data, prints) if len(data) >= LENGTH else None
                    if found:
                        k = len(found[0])
                        parts.append((np.full(k, d), np.full(k, th), *found))
                if parts:
                    d, th, pos, before, after, trigger, phrase = [np.concatenate(c) for c in zip(*parts)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(d, pa.int64()), pa.array(th, pa.int64()), pa.array(pos, pa.int64()),
                        pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32)),
                        pa.array(trigger.view(np.int64)), pa.array(phrase)], names=names)

    return docs.select("d", "th", "text").mapInArrow(run, PARSE)


def _dictionary(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(trigger, phrase, n, before, after, bytes) of the wanted phrases, cut from the texts."""
    by_text = wanted.groupBy("d", "th").agg(F.collect_list(F.struct("pos", "before", "after", "trigger", "phrase", "n")).alias("cuts"))

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 0):
                rows = []
                for t, cuts in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    data = t.encode()
                    rows += [(c["trigger"], c["phrase"], c["n"], c["before"], c["after"],
                              data[c["pos"] - c["before"]:c["pos"] + c["after"]]) for c in cuts]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                        names=["trigger", "phrase", "n", "before", "after", "bytes"])

    return docs.join(by_text, ["d", "th"]).select("text", "cuts").mapInArrow(
        run, "trigger long, phrase long, n long, before int, after int, bytes binary")


def fingerprints(before: np.ndarray, after: np.ndarray, data: list[bytes], prints: Prints):
    """Matrix of the fingerprints of every LENGTH-byte string of every phrase (a column for each
    distance REACH .. 0 before the trigger), and which of them exist."""
    width = REACH + LENGTH
    letters = np.zeros((len(data), width), np.uint8)
    for row, b, x in zip(letters, before, data):
        row[REACH - b:REACH - b + len(x)] = np.frombuffer(x, np.uint8)
    columns = np.arange(REACH + 1)
    exist = (columns >= REACH - before[:, None]) & (columns + LENGTH <= REACH + after[:, None])
    return prints.strings(letters), exist


def repeated(trigger: np.ndarray, prints: np.ndarray, exist: np.ndarray) -> np.ndarray:
    """Which strings have an equal one at the same distance in another phrase of the trigger."""
    rows = np.arange(len(trigger), dtype=np.uint64)[:, None]
    value = np.where(exist, mix(prints ^ trigger.view(np.uint64)[:, None]), rows)   # rows: equal to nothing
    order = np.argsort(value, axis=0)
    ranked = np.take_along_axis(value, order, axis=0)
    equal = ranked[1:] == ranked[:-1]
    edge = np.zeros((1, value.shape[1]), bool)
    out = np.zeros(value.shape, bool)
    np.put_along_axis(out, order, np.concatenate([equal, edge]) | np.concatenate([edge, equal]), axis=0)
    return out & exist


RUN = "trigger long, phrase long, low int, high int"


def _runs(dictionary: DataFrame) -> DataFrame:
    """(trigger, phrase, low, high): the run of each phrase that repeats, relative to the trigger,
    by comparing the phrases of a trigger in memory (streams of sorted rows)."""
    def result(held, source):
        trigger = np.array([h[0] for h in held], np.int64)
        before = np.array([h[3] for h in held], np.int64)
        after = np.array([h[4] for h in held], np.int64)
        again = np.array([h[2] > 1 for h in held])
        low, high = np.full(len(held), 1 << 20), np.full(len(held), -(1 << 20))
        columns = range(0, REACH + 1, max(1, STEP * (REACH + 1) // max(STEP, len(held))))
        step = columns.step
        prints, exist = None, None
        for c in columns:      # so many columns at a time that a large group needs no more memory than a small one
            if prints is None or step <= REACH:
                prints, exist = part(held, before, after, c, min(c + step, REACH + 1), source)
            hit = repeated(trigger, prints, exist)
            any_hit = hit.any(axis=1)
            low[any_hit] = np.minimum(low[any_hit], c + hit.argmax(axis=1)[any_hit])
            high[any_hit] = np.maximum(high[any_hit], c + hit.shape[1] - 1 - hit[:, ::-1].argmax(axis=1)[any_hit])
        whole = again & (before + after >= LENGTH)
        low = np.where(whole, -before, low - REACH)
        high = np.where(whole, after, high - REACH + LENGTH)
        keep = np.flatnonzero(high > low)
        return pa.RecordBatch.from_arrays([
            pa.array(trigger[keep]), pa.array(np.array([h[1] for h in held], np.int64)[keep]),
            pa.array(low[keep].astype(np.int32)), pa.array(high[keep].astype(np.int32))], names=["trigger", "phrase", "low", "high"])

    def part(held, before, after, start, end, source):
        prints, exist = [], []
        for i in range(0, len(held), STEP):
            x, y = fingerprints(before[i:i + STEP], after[i:i + STEP], [h[5] for h in held[i:i + STEP]], source)
            prints.append(x[:, start:end])
            exist.append(y[:, start:end])
        return np.concatenate(prints), np.concatenate(exist)

    def run(batches):
        source = Prints()
        done, group = [], []            # whole groups, and the one that is going on
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if group and row[0] != group[-1][0]:
                    done += group
                    group = []
                    if len(done) >= STEP:
                        yield result(done, source)
                        done = []
                if not group or row[1] != group[-1][1]:         # a phrase cut from two equal texts comes once
                    group.append(row)
        if done or group:
            yield result(done + group, source)

    return dictionary.select("trigger", "phrase", "n", "before", "after", "bytes").repartition("trigger") \
        .sortWithinPartitions("trigger", "phrase").mapInArrow(run, RUN)


def _runs_by_shuffle(dictionary: DataFrame) -> DataFrame:
    """The same for triggers of very many phrases: fingerprints are counted by a shuffle."""
    def run(batches):
        source = Prints()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                trigger, phrase, before, after = [part.column(j).to_numpy().astype(np.int64) for j in (0, 1, 3, 4)]
                prints, exist = fingerprints(before, after, part.column(5).to_pylist(), source)
                value = mix(prints ^ trigger.view(np.uint64)[:, None])
                row, column = np.nonzero(exist)
                yield pa.RecordBatch.from_arrays([
                    pa.array(trigger[row]), pa.array(phrase[row]), pa.array(column.astype(np.int32)),
                    pa.array(value[row, column].view(np.int64))], names=["trigger", "phrase", "c", "print"])

    phrases = dictionary.dropDuplicates(["trigger", "phrase"])
    strings = phrases.select("trigger", "phrase", "n", "before", "after", "bytes").mapInArrow(
        run, "trigger long, phrase long, c int, print long")
    twice = strings.groupBy("print", "c").agg(F.count("*").alias("k")).where("k > 1").drop("k")
    part = strings.join(twice, ["print", "c"]).groupBy("trigger", "phrase").agg(
        (F.min("c") - REACH).cast("int").alias("low"), (F.max("c") - REACH + LENGTH).cast("int").alias("high"))
    whole = phrases.where(f"n > 1 and before + after >= {LENGTH}").select(
        "trigger", "phrase", (-F.col("before")).alias("low"), F.col("after").alias("high"))
    return part.unionAll(whole).groupBy("trigger", "phrase").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _by_sides(dictionary: DataFrame) -> DataFrame:
    """Phrases of crowded triggers, each under two narrower ones: every LENGTH-byte string through a trigger
    holds the SIDE bytes before it or the SIDE bytes behind it, so equal strings meet under one of them."""
    before = F.when(F.col("before") >= SIDE, F.substring("bytes", F.col("before") - SIDE + 1, F.lit(SIDE)))
    behind = F.when(F.col("after") - GRAM >= SIDE, F.substring("bytes", F.col("before") + GRAM + 1, F.lit(SIDE)))
    keys = F.array(F.when(before.isNotNull(), F.xxhash64("trigger", F.lit(0), before)),
                   F.when(behind.isNotNull(), F.xxhash64("trigger", F.lit(1), behind)))
    return dictionary.withColumn("key", F.explode(F.array_compact(keys))) \
        .select(F.col("key").alias("trigger"), "phrase", "n", "before", "after", "bytes")


def repeated_ranges(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(d, th, ranges) for every text with repeated bytes: [start, end) pairs, not yet merged."""
    parsed = materialize(parse_documents(docs), "pfp-parse")
    triggers = parsed.groupBy("trigger").agg(F.count("*").alias("total"), F.min("phrase").alias("lo"), F.max("phrase").alias("hi")) \
        .where("total > 1").select("trigger", (F.col("lo") != F.col("hi")).alias("mixed"))
    shared = materialize(parsed.join(triggers, "trigger"), "pfp-shared")
    one = F.min_by(F.struct("d", "th", "pos", "before", "after"), F.struct("d", "th", "pos")).alias("one")
    phrases = materialize(shared.where("mixed").groupBy("trigger", "phrase").agg(F.count("*").alias("n"), one)
                          .select("trigger", "phrase", "n", "one.*"), "pfp-phrases")
    large = phrases.groupBy("trigger").count().where(F.col("count") > group).select("trigger")
    dictionary = materialize(_dictionary(docs, phrases), "pfp-dictionary")
    runs = _runs(dictionary.join(large, "trigger", "left_anti"))
    if not large.isEmpty():
        sides = materialize(_by_sides(dictionary.join(large, "trigger", "left_semi")), "pfp-sides")
        crowded = sides.select("trigger", "phrase").distinct().groupBy("trigger").count().where(F.col("count") > group).select("trigger")
        runs = runs.unionAll(_runs(sides.join(crowded, "trigger", "left_anti")))
        if not crowded.isEmpty():
            runs = runs.unionAll(_runs_by_shuffle(sides.join(crowded, "trigger", "left_semi")))
    # a phrase holds its trigger's bytes, so the phrase alone names its run
    runs = materialize(runs.groupBy("phrase").agg(F.min("low").alias("low"), F.max("high").alias("high")), "pfp-runs")
    some = shared.where("mixed").join(runs, "phrase").select("d", "th", (F.col("pos") + F.col("low")).alias("s"),
                                                             (F.col("pos") + F.col("high")).alias("e"))
    whole = shared.where(f"not mixed and before + after >= {LENGTH}").select(
        "d", "th", (F.col("pos") - F.col("before")).alias("s"), (F.col("pos") + F.col("after")).alias("e"))
    return some.unionAll(whole).groupBy("d", "th").agg(F.collect_set(F.struct("s", "e")).alias("ranges"))


def merge(ranges) -> list[tuple[int, int]]:
    out: list = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _removal(docs, id_column, text, group, fields, result):
    own = _with_key(docs, id_column, text)
    joined = own.join(repeated_ranges(own, group), ["d", "th"], "left").select("doc_id", "text", "ranges")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 1):
                rows = []
                for i, t, ranges in zip(*[piece.column(k).to_pylist() for k in range(3)]):
                    data = t.encode()
                    spans = merge((r["s"], r["e"]) for r in ranges or [])
                    cuts = [0, *(x for s in spans for x in s), len(data)]
                    rows.append((i, *result(data, spans, b"".join(data[s:e] for s, e in zip(cuts[::2], cuts[1::2])))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    names = ["doc_id", *[n for n, _, _ in fields]]
    types = [pa.int64(), *[t for _, t, _ in fields]]
    return joined.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} {s}" for n, _, s in fields))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """Per row: doc_id, the removed byte ``spans`` and the ``kept`` bytes."""
    return _removal(docs, id_column, text, group, [
        ("spans", pa.list_(pa.list_(pa.int64())), "array<array<long>>"), ("kept", pa.binary(), "binary")],
        lambda data, spans, kept: ([list(s) for s in spans], kept))


def removal_digests(docs: DataFrame, id_column: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, has_repeats, taken where the bytes are."""
    return _removal(docs, id_column, text, group, [
        ("n_bytes", pa.int64(), "long"), ("n_removed", pa.int64(), "long"), ("n_spans", pa.int64(), "long"),
        ("kept_sha256", pa.string(), "string"), ("has_repeats", pa.bool_(), "boolean")],
        lambda data, spans, kept: (len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), bool(spans)))


def op1_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: bytes, removed bytes and runs, digest of what is kept."""
    return removal_digests(read_table(spark, sf_dir, "documents"))
