"""Operators 1 and 6 against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm import graph, jaccard, suffix_dedup
from tests.llm.cases import awkward, frame, key, supplied

L = suffix_dedup.LENGTH


# --- operator 1 ------------------------------------------------------------------------------

def removed(rows):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[p:p + L] for b in data for p in range(len(b) - L + 1))
    out = []
    for (i, _), b in zip(rows, data):
        keep = np.ones(len(b) + 1, bool)
        for p in range(len(b) - L + 1):
            if seen[b[p:p + L]] > 1:
                keep[p:p + L] = False
        runs = int((keep[:-1] & ~keep[1:]).sum()) + (len(b) > 0 and not keep[0])
        runs = int(sum(not keep[k] and (k == 0 or keep[k - 1]) for k in range(len(b))))
        kept = bytes(np.frombuffer(b, np.uint8)[keep[:-1]])
        out.append((i, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest(), len(kept) < len(b)))
    return out


def repeats():
    rng = random.Random(3)
    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared, long = noise(700), noise(3000)
    rows = [(200_000 + i, noise(rng.randrange(50, 900)) + shared[rng.randrange(0, 250):] + noise(rng.randrange(300))) for i in range(12)]
    rows += [(201_000, long), (201_001, long[:1200] + "#" + long[1201:]), (201_002, long[200:900] + long[300:1500]),
             (201_003, shared[:399]), (201_004, shared[:400]), (201_005, "ab" * 600), (201_006, noise(50) * 30), (201_007, "z" * 400)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return [r for r in supplied(60) + awkward() + repeats() if r[1] is None or len(r[1]) < 20_000]


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 2])
def test_removed_bytes(spark, rows, group):
    out = suffix_dedup.removal_digests(frame(spark, rows, extra=True), group=group)
    assert key([tuple(r) for r in out.collect()]) == key(removed(rows))


def test_kept_bytes_and_empty_table(spark):
    rows = repeats()
    out = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    for i, t in rows:
        spans, b = out[i]["spans"], t.encode()
        assert bytes(out[i]["kept"]) == b"".join(b[s:e] for s, e in zip([0, *[x[1] for x in spans]], [*[x[0] for x in spans], len(b)]))
    assert suffix_dedup.removal_digests(frame(spark, [])).count() == 0


@pytest.mark.parametrize("segment", [100, 401, 1 << 19])
def test_segments_of_a_long_text_find_the_same_triggers(segment):
    rng = np.random.default_rng(2)
    prints = suffix_dedup.Prints()
    for data in (rng.integers(97, 105, 5000).astype(np.uint8), np.full(3000, 97, np.uint8), np.tile(np.arange(50, 90, dtype=np.uint8), 60)):
        whole, cut = suffix_dedup.parse(data, prints), suffix_dedup.parse(data, prints, segment)
        for x, y in zip(whole, cut):
            assert (x == y).all()
        # every string of LENGTH bytes holds a trigger's gram
        for p in range(len(data) - L + 1):
            k = np.searchsorted(whole[0], p)
            assert whole[0][k] <= p + suffix_dedup.REACH


def balanced(u, w, swapped):
    """Words in Thue-Morse order: such texts cancel in a polynomial modulo a power of two, whatever its base."""
    return "".join((u, w)[(bin(i).count("1") + swapped) % 2] for i in range(64))


def test_structured_texts_that_do_not_repeat_keep_all_bytes(spark):
    rng, rows = random.Random(11), []
    for k in range(60):
        u, w, tail = ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (5, 5, 80))
        rows += [(2 * k, balanced(u, w, 0) + tail), (2 * k + 1, balanced(u, w, 1) + tail)]
    assert all(len(t) == L for _, t in rows) and len({t for _, t in rows}) == len(rows)
    out = suffix_dedup.removal_digests(frame(spark, rows)).collect()
    assert {r["n_removed"] for r in out} == {0} and not any(r["has_repeats"] for r in out)
    prints = suffix_dedup.Prints()
    strings = prints.strings(np.array([list(t.encode()) for _, t in rows], np.uint8))
    assert len(np.unique(strings)) == len(rows)


# --- operator 6 ------------------------------------------------------------------------------

def sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    own = [(i, sets(t)) for i, t in rows]
    parent = {i: i for i, _ in own if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for k, (i, x) in enumerate(own):
        for j, y in own[:k]:
            if i is None or j is None or not x or not y:
                continue
            both = len(x & y)
            if 100 * both >= 75 * (len(x) + len(y) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(i, len(x), None if i is None else find(i)) for i, x in own]


def edited():
    """Chains and clusters of near copies of many sizes, some just beside the threshold, and a
    passage that many documents share."""
    rng = random.Random(11)
    rows, i = [], 300_000
    passage = " ".join(f"p{k}" for k in range(60))
    for size in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 18, 25, 40, 80, 150, 170, 200, 400, 900):
        base = [f"s{size}w{k}" for k in range(size)]
        for copy in range(14):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, size // 25 + 2))):
                k = rng.randrange(len(words))
                rng.choice([lambda: words.__setitem__(k, f"e{rng.randrange(10 ** 9)}"), lambda: words.insert(k, f"e{rng.randrange(10 ** 9)}"),
                            lambda: words.pop(k) if len(words) > 1 else None])()
            if copy % 5 == 4:
                base = words        # a chain: the next copies are copies of this one
            rows.append((i, " ".join(words)))
            i += 1
    for k in range(120):
        rows.append((i, passage + " " + " ".join(f"u{rng.randrange(10 ** 9)}" for _ in range(rng.randrange(5, 120)))))
        i += 1
    rng.shuffle(rows)
    return rows


def test_components_of_links(spark):
    rows = edited() + awkward() + supplied(120)
    out = jaccard.near_duplicates(frame(spark, rows, extra=True))
    want = components(rows)
    assert key([tuple(r) for r in out.collect()]) == key(want)
    assert sum(1 for i, _, c in want if c is not None and c != i) > 150


def test_every_link_shares_a_key():
    """The pigeonhole bound itself, without frequent shingles and with many."""
    rng = np.random.default_rng(4)
    for size in [*range(1, 40), 60, 100, 127, 128, 129, 150, 171, 172, 200, 300, 500, 2000]:
        for _ in range(8):
            x = np.unique(rng.integers(0, 2 ** 64, size, dtype=np.uint64))
            drop = rng.integers(0, len(x) // 4 + 1)
            add = rng.integers(0, max(0, int((len(x) - drop) / 0.75 - len(x))) + 1)
            y = np.unique(np.concatenate([rng.permutation(x)[drop:], rng.integers(0, 2 ** 64, add, dtype=np.uint64)]))
            if not jaccard.linked(x, y):
                continue
            for share in (0, 0.5, 1):
                hot = lambda s: (s >> np.uint64(40)) % np.uint64(100) < np.uint64(int(100 * share))  # noqa: B023, E731
                keys = [set(jaccard.signatures(s, hot(s)).tolist()) for s in (x, y)]
                assert keys[0] & keys[1], (size, drop, add, share)


def test_keep_one_each(spark):
    rows = [(5, "a b c d e f g"), (3, "a b c d e f g"), (3, "a b c d e f g"), (9, None), (8, ""), (None, "a b c d e f g"), (None, None), (7, "x y")]
    kept = jaccard.keep_one_each(frame(spark, rows, extra=True))
    assert kept.columns == frame(spark, [], extra=True).columns
    assert key([(r["doc_id"], r["text"]) for r in kept.collect()]) == key([rows[1], *rows[3:]])
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0


def test_star_components_on_paths_and_hubs(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(1, 60)] + [(1000, 1000 + k) for k in range(1, 300)] + [(k, k) for k in (5, 4000)]
    links += [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(150)]
    rng.shuffle(links)
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i
    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert got == {i: find(i) for i in parent}
