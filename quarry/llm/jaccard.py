"""N-gram Jaccard join by universe partitioning and the pigeonhole principle (operator 6).

Documents are sets of hashed 5-word shingles; two link if 100 |x and y| >= 75 |x or y|, that is
if they differ in at most H = (|x| + |y|) / 7 shingles.

Candidates. Sizes fall into overlapping bands, so that the two documents of a link share a band.
In a band, hashing the universe of shingles into m segments splits every set; a link differs in
at most H segments, so of the segments of x that are not empty, all but H are equal in y. The
index holds for each document a subset of H + 1 of its non-empty segments, the first ones in one
global order; two such subsets of linked documents always share a segment. The order is the cost
model: segments made only of frequent shingles (by a counting sketch over all documents) come
last, so a passage that many documents share enters no index as long as a document has enough
else. Sets of at most six shingles are indexed whole, with their one-deletion neighbourhoods.

Verification. Equal sets are one class from the start. Among documents that share a segment,
each is first compared with the one document it shares most segments with (hub), then, in ROUNDS rounds,
with the most central document of another component. Pairs that are
still in different components must pass bounds that no link fails: sizes, the Hamming distance
of 1024-bit parity sketches (never above the true difference), and for large sets, which index
ell more keys than the pigeonhole needs, ell common keys instead of one. Every pair left is
verified on the texts unless its components have met. So no link is lost. Pairs of one component are
never emitted, nor those the bounds exclude; of a key with members of several components
that are alike but do not link, all pairs are counted, in blocks. A key's rows of that last step are
held by one task (128 bytes and four numbers each); all other groups are streams of sorted rows.

Node ids are document ids: rows with one doc_id are versions of one document. Defined results:
null or empty texts have no shingles and link with nothing; rows without doc_id are reported
with a null component; texts of fewer words than a shingle are one shingle; an empty table
gives no rows. Hashes of words are 64 bits wide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import discard, materialize, pieces, read_table
from quarry.llm.graph import components

SHINGLE = 5
#: Links need 4 |x and y| >= 3 |x or y|.
NEAR, WHOLE = 3, 4
#: Sets of at most this size (and their partners) are indexed whole with one deletion.
TINY = 6
#: Bands whose smallest set is smaller have a segment for each shingle.
SEGMENTED = 128
#: Sets of bands from this size on index a quarter more keys than the pigeonhole needs.
LARGE = 512
#: Counters of the frequency sketch. More give a sharper cost model on larger corpora; the
#: result does not depend on it.
SKETCH_BITS = 20
SLICES = 16
PARITY_BITS = 1024
#: Distinct sets a task remembers so as not to index copies again.
REMEMBERED = 200_000
#: Rounds of comparisons with central documents, at most; what they leave open is counted exhaustively.
ROUNDS = 1
#: Tasks that the open keys of one smallest component are dealt to.
SPREAD = 16
#: Pairs that a task counts in memory, at most.
PAIRS = 400_000
#: Members of a hub that go to one group of the verification.
HUB_MEMBERS = 256

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


POWERS = np.cumprod(np.full(SHINGLE, 0x9E3779B97F4A7C15, np.uint64))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = (text or "").encode().lower().split()       # ASCII lower case, ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < SHINGLE:
        return mix(np.array([(h * POWERS[:len(h)]).sum(dtype=np.uint64) + U(len(h))], np.uint64))
    n = len(h) - SHINGLE + 1
    total = h[:n] * POWERS[0]
    for j in range(1, SHINGLE):
        total = total + h[j:j + n] * POWERS[j]
    return np.unique(mix(total))


def parity_sketch(s: np.ndarray) -> bytes:
    bits = np.bincount((s >> U(54)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _bands() -> list[tuple[int, int, int]]:
    """(band, smallest size of the smaller set, first size beyond it), to sizes no text reaches."""
    out, low = [], TINY
    while low < 1 << 40:
        high = -(-low * WHOLE // NEAR)
        out.append((len(out), low, high))
        low = high
    return out[:63]             # the band is six bits of a key


BANDS = _bands()
LOWS = np.array([b[1] for b in BANDS])


def signatures(s: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Index keys of a set (sorted distinct hashes) over all its bands; ``hot``: which of its
    shingles are frequent."""
    size, out = len(s), []
    if not size:
        return np.zeros(0, np.int64)
    if size <= TINY:
        whole = mix(s).sum(dtype=np.uint64)
        keys = [np.array([whole], np.uint64)]
        if size > 3:                                    # smaller sets have partners of their own size only
            keys.append(whole - mix(s))
        out.append(mix(np.concatenate(keys) ^ U(0x5A5A)) >> U(8) << U(6) | U(len(BANDS)))
    k = int(np.searchsorted(LOWS, size, side="right")) - 1
    while k >= 0 and size <= (BANDS[k][2] - 1) * WHOLE // NEAR:
        band, low, high = BANDS[k]
        if size < high:
            most = (size + size * WHOLE // NEAR) // 7
        else:
            most = (size + high - 1) // 7
        label = mix(np.array([band + 1], np.uint64))[0]
        if low < SEGMENTED:
            keys, cold = mix(s ^ label), ~hot
        else:
            segment = ((s >> U(32)) * U(low)) >> U(32)          # grows with the hash: already sorted
            first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            content = np.add.reduceat(mix(s), first)
            keys = mix((content ^ label) + segment[first] * U(0x9E3779B97F4A7C15))
            cold = np.logical_or.reduceat(~hot, first)
        if len(keys) <= most + most // 4:
            raise ValueError("a set fills too few segments; this band needs more of them")
        if low >= LARGE:                                # so many more that a link shares as many, not one
            most += most // 4
        keys = (keys >> U(8) << U(6)) | U(band) | (U(1) << U(62)) * (~cold).astype(np.uint64)
        out.append(np.partition(keys, most)[:most + 1])
        k -= 1
    return np.concatenate(out).astype(np.int64)


def _describe(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text): n, set hashes s1 and s2, parity sketch; and at the end of each
    task its slices of the frequency sketch (slice number, saturating byte counters)."""
    def run(batches):
        counters = np.zeros(1 << SKETCH_BITS, np.int64)
        mask = U((1 << SKETCH_BITS) - 1)
        for batch in batches:
            for piece in pieces(batch, 1):
                sets = [shingles(t) for t in piece.column(1).to_pylist()]
                if sets:
                    counters += np.bincount((np.concatenate(sets) & mask).astype(np.int64), minlength=len(counters))
                mixed = [mix(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    piece.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([x.sum(dtype=np.uint64).astype(np.int64) for x in mixed], pa.int64()),
                    pa.array([mix(x + U(77)).sum(dtype=np.uint64).astype(np.int64) for x in mixed], pa.int64()),
                    pa.array([parity_sketch(s) for s in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names=names)
        parts = np.minimum(counters, 255).astype(np.uint8).reshape(SLICES, -1)
        some = [i for i in range(SLICES) if parts[i].any()]
        k = len(some)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
            pa.nulls(k, pa.binary()), pa.array(some, pa.int32()),
            pa.array([parts[i].tobytes() for i in some], pa.binary())], names=names)

    names = ["doc_id", "n", "s1", "s2", "parity", "slice", "counters"]
    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, parity binary, slice int, counters binary")


def _sum_slices(rows: DataFrame, kind: str) -> DataFrame:
    """(slice, counters) rows of little-endian ``kind`` numbers, added up by slice as int64."""
    def partial(batches):
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = np.frombuffer(x, kind).astype(np.int64)
                totals[i] = totals[i] + own if i in totals else own
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()),
                                          pa.array([v.tobytes() for v in totals.values()], pa.binary())],
                                         names=["slice", "counters"])

    def whole(table):
        total = sum(np.frombuffer(x, "<i8") for x in table.column(1).to_pylist())
        return pa.table({"slice": pa.array([table.column(0)[0].as_py()], pa.int32()),
                         "counters": pa.array([total.tobytes()], pa.binary())})

    schema = "slice int, counters binary"
    return rows.select("slice", "counters").mapInArrow(partial, schema).groupBy("slice").applyInArrow(whole, schema)


def _frequent(described: DataFrame) -> np.ndarray:
    """Bitmap of the sketch counters far above their mean (fixed size: 2 ** SKETCH_BITS bits)."""
    rows = described.where("slice is not null")
    total = described.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = max(64, 4 * (total >> SKETCH_BITS))
    width = (1 << SKETCH_BITS) // SLICES
    hot = np.zeros((SLICES, width), bool)

    def bits(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(
                [np.packbits(np.frombuffer(x, "<i8") >= limit).tobytes() for x in b.column(1).to_pylist()], pa.binary())],
                names=["slice", "counters"])

    for r in _sum_slices(rows, "u1").mapInArrow(bits, "slice int, counters binary").collect():
        hot[r["slice"]] = np.unpackbits(np.frombuffer(r["counters"], np.uint8))[:width].astype(bool)
    return np.packbits(hot.reshape(-1))


def _index(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(sig, id) of every distinct set of a task."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        hot = np.unpackbits(shared.value).astype(bool)
        mask, seen = U((1 << SKETCH_BITS) - 1), set()
        for batch in batches:
            for piece in pieces(batch, 1):
                ids, keys = [], []
                for i, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    s = shingles(t)
                    own = (len(s), int(mix(s).sum(dtype=np.uint64)))
                    if i is None or not len(s) or own in seen:
                        continue
                    if len(seen) < REMEMBERED:
                        seen.add(own)
                    keys.append(signatures(s, hot[(s & mask).astype(np.int64)]))
                    ids.append(i)
                if ids:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(keys), pa.int64()),
                        pa.array(np.repeat(np.array(ids, np.int64), [len(k) for k in keys]), pa.int64())], names=["sig", "id"])

    return docs.mapInArrow(run, "sig long, id long")


def _shared_groups(index: DataFrame) -> DataFrame:
    """(sig, id, hub) of the keys that several documents have; the hub is the smallest id. A group
    is a run of sorted rows: no group is held in memory."""
    def run(batches):
        sig = hub = None            # of the run that is going on
        held = False                # its first row is not yet out
        for b in batches:
            sigs, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(sigs):
                continue
            new = np.append(sig is None or sigs[0] != sig, (sigs[1:] != sigs[:-1]))
            start = np.maximum.accumulate(np.where(new, np.arange(len(sigs)), -1))
            hubs = np.where(start >= 0, ids[np.maximum(start, 0)], 0 if hub is None else hub)
            out = ~new
            first = np.append(~new[1:], False) & new
            lead_sig, lead_id = [], []
            if held and not new[0]:
                lead_sig, lead_id = [sig], [hub]
            held = (bool(new[-1])) or (held and len(sigs) == 0)
            sig, hub = sigs[-1], hubs[-1]
            if new[-1]:
                hub = ids[-1]
            take = out | first
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.array(lead_sig, np.int64), sigs[take]]), pa.int64()),
                pa.array(np.concatenate([np.array(lead_id, np.int64), ids[take]]), pa.int64()),
                pa.array(np.concatenate([np.array(lead_id, np.int64), hubs[take]]), pa.int64())], names=["sig", "id", "hub"])

    return index.repartition("sig").sortWithinPartitions("sig", "id").mapInArrow(run, "sig long, id long, hub long")


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids`` (id): a bitmap of fixed size drops most others
    before the texts are dealt out for the join."""
    bits = 1 << 23

    def mark(batches):
        seen = np.zeros(bits, bool)
        for b in batches:
            seen[_bit(b.column(0).to_numpy(), bits)] = True
        parts = np.packbits(seen).reshape(SLICES, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                                         names=["slice", "bits"])

    def either(table):
        total = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column(1).to_pylist()])
        return pa.table({"slice": pa.array([table.column(0)[0].as_py()], pa.int32()), "bits": pa.array([total.tobytes()], pa.binary())})

    schema = "slice int, bits binary"
    merged = ids.select("id").coalesce(16).mapInArrow(mark, schema).groupBy("slice").applyInArrow(either, schema).collect()
    packed = np.concatenate([np.frombuffer(r["bits"], np.uint8) for r in sorted(merged, key=lambda r: r["slice"])]) \
        if merged else np.zeros(bits // 8, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def sieve(batches):
        seen = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            known = b.column(0).is_valid().to_numpy(zero_copy_only=False)
            at = b.column(0).fill_null(0).to_numpy()
            yield b.filter(pa.array(known & seen[_bit(at, bits)]))

    return docs.mapInArrow(sieve, docs.schema).join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")


def _bit(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) & U(bits - 1)).astype(np.int64)


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that link. Hub a's text goes once to every group of at most about
    HUB_MEMBERS members; groups are streams of rows in which the hub's versions come first."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_MEMBERS).alias("parts")).where("parts > 1")
    pairs = pairs.join(many, "a", "left").withColumn("salt", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1)))).drop("parts")
    members = pairs.join(texts, F.col("b") == F.col("doc_id")).select("a", "salt", "b", "text")
    hubs = pairs.select("a", "salt").distinct().join(texts, F.col("a") == F.col("doc_id")) \
        .select("a", "salt", F.lit(None).cast("long").alias("b"), "text")

    def run(batches):
        group, own = None, []
        for batch in batches:
            for piece in pieces(batch, 3):
                a, b = [], []
                for x, salt, y, t in zip(*[piece.column(i).to_pylist() for i in range(4)]):
                    if (x, salt) != group:
                        group, own = (x, salt), []
                    s = shingles(t)
                    if y is None:
                        own.append(s)
                    elif any(linked(s, o) for o in own):
                        a.append(x)
                        b.append(y)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    rows = hubs.unionAll(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.mapInArrow(run, "a long, b long").distinct()


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    if not len(x) or not len(y):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return WHOLE * both >= NEAR * (len(x) + len(y) - both)


def _open_rows(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, id, component, lo) of the keys whose documents are in different components, ``lo`` the smallest."""
    own = groups.join(labels, "id", "left").select("sig", "id", F.coalesce("component", "id").alias("component"))
    open_keys = own.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .where("lo != hi")
    return own.join(open_keys.select("sig", "lo"), "sig")


def _central_pairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b), and the scratch table that it reads: for every document of the open rows one partner a key in another component, the most central
    one, and of these the one it shares most keys with. A document is central if its keys are shared
    by many: the text that a group of copies was made from rather than one of the copies. One row a
    document and key: nothing here grows with the square of a group."""
    size = rows.groupBy("sig").agg(F.count("*").alias("k"))
    score = rows.join(size, "sig").groupBy("id").agg(F.sum("k").alias("score"))
    scored = materialize(rows.select("sig", "id", "component").join(score, "id"), "jaccard-central")
    top = F.max(F.struct("score", F.col("id").alias("hub"), "component")).alias("t")
    first = scored.groupBy("sig").agg(top).select("sig", F.col("t.hub").alias("h1"), F.col("t.component").alias("c1"))
    second = scored.join(first, "sig").where("component != c1").groupBy("sig").agg(top) \
        .select("sig", F.col("t.hub").alias("h2"))
    partner = F.when(F.col("component") != F.col("c1"), F.col("h1")).otherwise(F.col("h2")).alias("hub")
    shared = scored.join(first, "sig").join(second, "sig").select("id", partner).groupBy("id", "hub").agg(F.count("*").alias("k"))
    best = shared.groupBy("id").agg(F.max_by("hub", F.struct("k", "hub")).alias("hub"))
    return best.select(F.col("hub").alias("a"), F.col("id").alias("b")), scored


def _open_pairs(open_rows: DataFrame, described: DataFrame) -> DataFrame:
    """(a, b, ca, cb, shared): pairs with a common key whose components differ, whose sizes and parity
    sketches allow a link, and which share as many keys of a band as a link must.

    The keys of one smallest component are dealt to SPREAD tasks, whatever their number: a pair with
    hundreds of common keys is counted there and leaves a task once, not once a key."""
    sketches = described.where("n > 0 and doc_id is not null").select(F.col("doc_id").alias("id"), "n", "parity")
    rows = open_rows.join(sketches, "id").select("sig", "id", "component", "n", "parity", "lo")
    names = ["a", "b", "ca", "cb", "na", "nb", "band", "shared"]

    def fitting(rows, i, j):
        """Those of the row pairs (i, j) that may link."""
        sig, ids, component, n, bits = rows
        ok = (component[i] != component[j]) & (NEAR * np.maximum(n[i], n[j]) <= WHOLE * np.minimum(n[i], n[j]))
        i, j = i[ok], j[ok]
        apart = np.concatenate([np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1) for x, y in zip(
            np.array_split(i, len(i) // 50_000 + 1), np.array_split(j, len(i) // 50_000 + 1))])
        ok = 7 * apart.astype(np.int64) <= n[i] + n[j]
        return i[ok], j[ok]

    def pairs(rows):
        """Tables of the fitting pairs of whole groups of sorted rows: of small groups by shifting all rows at
        once, of large ones in blocks; none grows beyond PAIRS and a block."""
        sig, ids, component, n, _ = rows
        cuts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        size = np.diff(np.append(cuts, len(sig)))
        small = np.repeat(size <= 16, size)
        found, total = [], 0

        def table():
            i, j = [np.concatenate(c) for c in zip(*found)]
            flip = ids[i] > ids[j]
            i, j = np.where(flip, j, i), np.where(flip, i, j)
            return np.column_stack([ids[i], ids[j], component[i], component[j], n[i], n[j], sig[i] & 63]).astype(np.int64)

        def candidates():
            for k in range(1, min(16, int(size.max()))):
                i = np.flatnonzero(small[:-k] & (sig[:-k] == sig[k:]))
                yield i, i + k
            for start, count in zip(cuts[size > 16], size[size > 16]):
                for x in range(0, count, 512):
                    for y in range(x, count, 512):
                        i, j = np.meshgrid(np.arange(x, min(x + 512, count)), np.arange(y, min(y + 512, count)), indexing="ij")
                        ahead = i < j
                        yield start + i[ahead], start + j[ahead]

        for i, j in candidates():
            found.append(fitting(rows, i, j))
            total += len(found[-1][0])
            if total > PAIRS:
                yield table()
                found, total = [], 0
        if total:
            yield table()

    def merged(parts):
        """Distinct pairs (with the band of their keys) and how many keys they have met in."""
        table = np.concatenate(parts)
        rows, place = np.unique(table[:, :7], axis=0, return_inverse=True)
        return np.column_stack([rows, np.bincount(place.reshape(-1), table[:, 7], len(rows)).astype(np.int64)])

    def batch_of(table):
        return pa.RecordBatch.from_arrays([pa.array(table[:, k]) for k in range(8)], names=names)

    def run(batches):
        held, parts = None, [np.zeros((0, 8), np.int64)]

        def met(table):
            parts.append(np.column_stack([table, np.ones(len(table), np.int64)]))
            if sum(map(len, parts)) > PAIRS:
                parts[:] = [merged(parts)]
                if len(parts[0]) > PAIRS // 2:
                    full = batch_of(parts[0])
                    parts[:] = [np.zeros((0, 8), np.int64)]
                    return full

        for b in batches:
            if not b.num_rows:
                continue
            bits = np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint64).reshape(b.num_rows, -1)
            rows = (*[b.column(k).to_numpy() for k in range(4)], bits)
            if held is not None:
                rows = tuple(np.concatenate(c) for c in zip(held, rows))
            whole = int(np.searchsorted(rows[0], rows[0][-1]))      # the last group may go on
            for table in pairs(tuple(c[:whole] for c in rows)) if whole else ():
                if full := met(table):
                    yield full
            held = tuple(c[whole:] for c in rows)
        for table in pairs(held) if held is not None else ():
            if full := met(table):
                yield full
        yield batch_of(merged(parts))

    def size_of_index(n):
        high = F.get(F.array(*[F.lit(h) for _, _, h in BANDS]), F.col("band").cast("int"))
        low = F.get(F.array(*[F.lit(x) for _, x, _ in BANDS]), F.col("band").cast("int"))
        most = F.when(n < high, F.floor((n + F.floor(n * WHOLE / NEAR)) / 7)).otherwise(F.floor((n + high - 1) / 7))
        return most + F.when(low >= LARGE, 1 + F.floor(most / 4)).otherwise(1)

    least = F.when(F.col("band") >= len(BANDS), 1).otherwise(
        F.least(size_of_index(F.col("na")), size_of_index(F.col("nb"))) - F.floor((F.col("na") + F.col("nb")) / 7))
    spread = F.pmod(F.shiftright("sig", 6), F.lit(SPREAD))
    counts = rows.repartition("lo", spread).sortWithinPartitions("sig", "id").drop("lo").mapInArrow(run, ", ".join(f"{c} long" for c in names)) \
        .groupBy(names[:-1]).agg(F.sum("shared").alias("shared"))
    return counts.where(F.col("shared") >= least).groupBy("a", "b", "ca", "cb").agg(F.max("shared").alias("shared"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    own = docs.select(docs[f"`{id_column}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    described = materialize(_describe(own), "jaccard-sets")
    rows = described.where("slice is null")
    copies = rows.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2") \
        .agg(F.min("doc_id").alias("b"))
    same = rows.where("n > 0 and doc_id is not null").join(copies, ["n", "s1", "s2"]) \
        .select(F.col("doc_id").alias("a"), "b").where("a != b")
    groups = materialize(_shared_groups(_index(own, _frequent(described))), "jaccard-groups")
    hubs = groups.where("id != hub").groupBy("id", "hub").count().groupBy("id").agg(
        F.max_by("hub", F.struct("count", -F.col("hub"))).alias("hub"))
    texts = materialize(_only(own, groups.select("id").distinct()), "jaccard-texts")
    links = materialize(_verify(hubs.select(F.col("hub").alias("a"), F.col("id").alias("b")), texts)
                        .unionAll(same), "jaccard-links")
    labels = materialize(components(links), "jaccard-components")
    # linear rounds: each document with the most central partner of another component; groups of near
    # copies whose hub was one of the copies come together here
    for turn in range(ROUNDS + 1):
        open_rows = materialize(_open_rows(groups, labels), "jaccard-rows")
        if turn == ROUNDS:
            break
        central, scored = _central_pairs(open_rows)
        found = materialize(_verify(central, texts), "jaccard-round")
        discard(scored)
        if found.isEmpty():
            break
        discard(open_rows)
        links = links.unionAll(found)
        labels = materialize(components(links), "jaccard-components")
    pairs = materialize(_open_pairs(open_rows, rows), "jaccard-open")
    discard(groups, open_rows)
    # first every document with the likeliest partner in each other component, which joins most of
    # them; then exhaustively all pairs that are still open
    first = pairs.groupBy("a", "cb").agg(F.max_by("b", F.struct("shared", "b")).alias("b")).select("a", "b") \
        .unionAll(pairs.groupBy("b", "ca").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")).distinct()
    found = materialize(_verify(first, texts), "jaccard-first")
    links = links.unionAll(found)
    labels = materialize(components(links), "jaccard-components")
    ends = [labels.select(F.col("id").alias(x), F.col("component").alias(f"now_{x}")) for x in "ab"]
    rest = pairs.select("a", "b").join(first, ["a", "b"], "left_anti").join(ends[0], "a", "left").join(ends[1], "b", "left") \
        .where(F.coalesce("now_a", "a") != F.coalesce("now_b", "b")).select("a", "b")
    found = materialize(_verify(rest, texts), "jaccard-rest")
    if not found.isEmpty():
        labels = materialize(components(links.unionAll(found)), "jaccard-components")
    discard(texts, pairs, found)
    return rows.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left") \
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every component: the one of smallest id, once, all its columns unchanged;
    rows without id stay."""
    gone = near_duplicates(docs, id_column, text).where("doc_id != component_id").select("doc_id").distinct()
    own = docs[f"`{id_column}`"].cast("long")
    marked = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), own.alias("i"))
    kept = marked.where("i is not null").join(gone, F.col("i") == F.col("doc_id"), "left_anti").dropDuplicates(["i"])
    return kept.unionAll(marked.where("i is null")).select("row.*")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: size of the shingle set and component of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS h
      FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.h = y.h AND x.doc_id != y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r(a, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a AND r.c < e.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(c) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""
