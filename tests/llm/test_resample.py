import random
import re
import zlib
from collections import Counter
from hashlib import sha256
from math import floor, log

from shelfwise.llm import resample as R


def words_of(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", data)


def features(text, most=1):
    own = words_of(text)
    return [b" ".join(own[i:i + k]) for k in range(1, most + 1) for i in range(len(own) - k + 1)]


def brute(docs, target, most=1, buckets=10_000, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, most))
    t = Counter(bucket(f) for x in target for f in features(x, most))
    total, wanted = sum(s.values()), sum(t.values())
    gain = lambda b: floor(1000 * log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets))))
    rows = []
    for i, text in docs:
        own = features(text, most)
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in own)
        rows.append((i, len(words_of(text)), len(own), weight, weight + floor(-1000 * log(-log((h + .5) / 4294967296)))))
    enough = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = enough[:percent * len(enough) // 100]
    left = list(rows)
    for r in drawn:
        left.remove(r)
    return [(*r, k) for k, r in enumerate(drawn, 1)] + [(*r, None) for r in left]


def corpus(seed=1):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choices("abcdeé漢Z9", k=rnd.randrange(1, 7))) for _ in range(300)] + ["w" * 200]
    text = lambda: "".join(rnd.choice(pool) + rnd.choice([" ", ". ", "-", "\n", "\0"]) for _ in range(rnd.randrange(70)))
    docs = [(i, text()) for i in range(500)]
    docs += [(900, None), (901, ""), (902, "!! --"), (None, text()), (903, "Ab aB AB " * 20_000)] + [(950, docs[3][1] + " z" * 30)] * 40
    return docs, [text() for _ in range(20)] + [None, ""]


def test_matches_brute_force_on_odd_rows(spark):
    docs, target = corpus()
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, weight int, rank string")
    b = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    for most, share in ((1, R.MIN_SHARE), (1, 0.01), (3, 0.002), (2, 1.0)):     # with most words in the dictionary, few, and none
        out = R.resample(d, b, max_words=most, min_share=share, percent=30)
        assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
        assert sorted(map(tuple, out.collect()), key=str) == sorted(brute(docs, target, most, percent=30), key=str)


def test_ranks_over_many_parts_have_no_gap_and_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words " * 15) for i in range(400)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    flat = lambda key, seed: key * 0
    out = R.resample(d, spark.createDataFrame([("other",)], "text string"), percent=50, noise=flat).collect()
    assert sorted((r.rank, r.doc_id) for r in out if r.rank) == [(i + 1, i) for i in range(200)]


def test_composition_of_payloads():
    rnd = random.Random(4)
    scanner = R.Scanner([], 2)
    import numpy as np
    for _ in range(200):
        a, b = rnd.randbytes(rnd.randrange(30)), rnd.randbytes(rnd.choice([0, 1, 5, 300, 70_000]))
        got = scanner.shifted(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)])) ^ np.uint32(zlib.crc32(b))
        assert int(got[0]) == zlib.crc32(a + b)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a " * 30), (2, None)], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert sorted((r.doc_id, r.rank) for r in R.resample(d, b, percent=100).collect()) == [(1, 1), (2, None)]
    assert R.resample(d.limit(0), b).count() == 0
