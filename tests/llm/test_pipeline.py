"""The whole pipeline against brute force: plain Python for the stages, with fixed references for the quality rules
and no trees for personal data (base spans alone), and the library's own encoding."""

import hashlib
import math
import os
import random
import re
import tempfile
from collections import Counter

import sentencepiece

import corpus_pipeline
from quarry.llm import pii, quality
from quarry.llm.common import vocabulary_path

COMMON = quality.COMMON_WORDS["en"].split()


def prose(rng, n):
    words = []
    for _ in range(n):
        words.append(rng.choice(COMMON) if rng.random() < 0.45 else "".join(rng.choice("aeiourstlnmdhp") for _ in range(rng.randrange(4, 9))))
    return " ".join(w.capitalize() + "" if k % 14 == 0 else w + "." if k % 14 == 13 else w for k, w in enumerate(words))


def changed(rng, text, n):
    words = text.split()
    for k in rng.sample(range(len(words)), n):
        words[k] = f"zz{rng.randrange(10 ** 6)}"
    return " ".join(words)


def fixture():
    rng = random.Random(8)
    texts = [prose(rng, rng.randrange(150, 260)) for _ in range(14)]
    rows = list(enumerate(texts))
    rows += [(100, texts[0]), (101, changed(rng, texts[0], 3)), (102, changed(rng, texts[1], 5)), (103, changed(rng, texts[2], 25))]
    chain = changed(rng, texts[3], 4)
    rows += [(104, chain), (105, changed(rng, chain, 4)), (106, texts[4] + " " + texts[5])]
    items = [(k, prose(rng, n)) for k, n in enumerate((30, 12, 10, 4))] + [(9, None), (None, prose(rng, 15)), (10, "")]
    rows += [(200 + k, texts[6 + k] + " tail words " + " ".join(t.split()[:11]) + " " + prose(rng, 90)) for k, (_, t) in enumerate(items[:4])]
    rows += [(210, prose(rng, 160) + " " + items[5][1].upper()), (211, prose(rng, 160) + " " + " ".join(items[0][1].split()[:9]))]
    secrets = ["write to a.b+c@mail.example.org now", "host 10.20.30.40 is up", "paid with 4111 1111 1111 1111 today", "call +44 20 7946 0958 please",
               "not 999.1.1.1 nor 4111 1111 1111 1112"]
    rows += [(300 + k, prose(rng, 150) + " " + s + " " + prose(rng, 30)) for k, s in enumerate(secrets)]
    rows += [(400, "too short"), (401, "same words " * 100), (402, "#### $$$$ %%%% " * 60), (403, None), (404, ""), (405, prose(rng, 180).upper()),
             (406, " ".join(f"x{rng.randrange(10 ** 5)}" for _ in range(150))), (None, prose(rng, 170)), (None, texts[0])]
    rng.shuffle(rows)
    return rows, items


# --- plain statements of the stages ---------------------------------------------------------

def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    return math.sqrt(max(0, (kl(p) + kl(q)) / 2))


def class_of(c):
    if c in "aeiou":
        return 0
    if "a" <= c <= "z":
        return 1
    if c.isupper():
        return 2
    return 3 if c.isalpha() else 4 if c.isdigit() else 5 if c.isspace() else 6 if c in ".,;:!?'\"()-" else 7 if ord(c) < 128 else 8


def histograms(text):
    classes = [0.0] * 9
    for c in text:
        classes[class_of(c)] += 1
    words = text.split()
    bare = [w[:-1] if w[-1:] in ",.;:!?" and w else w for w in words]
    forms = {f: w for w in COMMON for f in (w, w.capitalize(), w.upper())}
    counts = Counter(forms[w] for w in bare if w in forms)
    own = [counts[w] for w in COMMON]
    return classes, own + [len(words) - sum(own)]


def good(text, references):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    if len(words) < 20 or 100 * len(again) > 30 * len(words):
        return False
    classes, common = histograms(text)
    limit = quality.MAX_WORD_DISTANCE
    if len(words) < quality.MIN_WORDS:
        limit = quality.word_limits(references[1], limit)[len(words)]
    return not (len(text) >= quality.MIN_CHARS and js(classes, references[0]) > quality.MAX_CLASS_DISTANCE) and js(common, references[1]) <= limit


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def one_each(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    least = {i: i for i, _ in sets}
    for _ in sets:
        for i, x in sets:
            for j, y in sets:
                if 100 * len(x & y) >= 75 * len(x | y):
                    least[i] = least[j] = min(least[i], least[j])
    seen, out = set(), []
    for i, t in rows:
        if i is None or (least[i] == i and i not in seen):
            seen.add(i)
            out.append((i, t))
    return out


def clean(text, items):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own = words.findall(text.lower())
    for _, t in items:
        w = words.findall((t or "").lower())
        m = min(10, len(w))
        windows = {tuple(w[i:i + m]) for i in range(len(w) - m + 1)} if m else set()
        if any(tuple(own[i:i + m]) in windows for i in range(len(own) - m + 1)):
            return False
    return True


def masked(text):
    text = re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[EMAIL]", text)
    for found, kind in (("10.20.30.40", "[IP]"), ("4111 1111 1111 1111", "[CARD]"), ("+44 20 7946 0958", "[PHONE]")):
        text = text.replace(found, kind)
    return text


def test_pipeline_equals_brute_force(spark, monkeypatch):
    import numpy as np
    rows, items = fixture()
    sample = histograms(" ".join(t for i, t in rows if i is not None and i < 14))
    references = (np.array(sample[0]), np.array(sample[1], float))
    monkeypatch.setattr(quality, "language_references", lambda *a: {"en": references})
    monkeypatch.setattr(pii, "fit_models", lambda *a: {})
    folder = tempfile.mkdtemp()
    spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int") \
        .repartition(3).write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))

    left = [(i, t) for i, t in rows if good(t, references)]
    assert {100, 101, 200, 300, 406} - {i for i, _ in left} == {406} and not {400, 401, 402, 403, 404} & {i for i, _ in left}
    single = one_each(left)
    assert len(single) < len(left) and {106} <= {i for i, _ in single} and not {100, 101, 104, 105} & {i for i, _ in single}
    kept = [(i, t) for i, t in single if clean(t, items)]
    assert not {200, 201, 202, 203, 210} & {i for i, _ in kept} and 211 in {i for i, _ in kept}
    texts = [(i, masked(t)) for i, t in kept]
    assert sum("[" in t for _, t in texts) == 4
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    want = []
    for i, t in texts:
        ids = sp.encode(t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, folder).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(got, key=order) == sorted(want, key=order)
