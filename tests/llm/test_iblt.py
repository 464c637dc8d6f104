import random
from hashlib import sha256

import numpy as np

from shelfwise.llm import iblt as I


def texts(n, seed):
    rnd, out = random.Random(seed), []
    for _ in range(n):
        lines = [" ".join(rnd.choices(["ab", "c.", "déf", "g!", "漢字"], k=rnd.randrange(1, 30))) for _ in range(rnd.choice([0, 1, 5, 60]))]
        out.append("\n".join(lines + lines[:2]))
    return out


def alike(a, b):
    x, y = set(I.digests(a).tolist()), set(I.digests(b).tolist())
    return len(x & y) / len(x | y) if x | y else 1.0


def test_versions_match_brute_force(spark):
    rnd = random.Random(8)
    rows = [(i * 3, t) for i, t in enumerate(texts(120, 1))] + [(None, "zero\nnull"), (5000, None), (5001, ""), (9, "tie"), (9, "tie"), (5002, "x. " * 30000)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(*r, "p") for r in rows], "doc_id long, text string, part string").repartition(5)
    got = I.fingerprint_versions(docs).collect()
    assert len(got) == len(rows)
    order = {}
    for r in got:
        order.setdefault(r.doc_id, []).append(r)
    ids = [None] + sorted({d for d, _ in rows if d is not None})
    by = {}
    for d, t in rows:
        by.setdefault(d, []).append(t or "")
    prints = {}
    for k, d in enumerate(ids):
        if len(by[d]) > 1:
            continue
        nxt = by[ids[(k + 1) % len(ids)]]
        (t,), (r,) = by[d], order[d]
        if len(nxt) > 1:
            continue
        h = len(t) // 2
        e = t[:len(t) - h] + nxt[0][:h]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha256(e.encode()).hexdigest())
        assert abs(r.near_edited - alike(t, e)) < 1e-12 and abs(r.near_next - alike(t, nxt[0])) < 1e-12
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)


def test_small_tables(spark):
    one = spark.createDataFrame([(7, "a b")], "doc_id long, text string")
    (r,) = I.fingerprint_versions(one).collect()
    assert (r.near_next, r.edited_sha256) == (1.0, sha256(b"a a").hexdigest())
    nulls = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert [r.n_chars for r in I.fingerprint_versions(nulls).collect()] == [0, 0]
    assert I.fingerprint_versions(one.limit(0)).count() == 0


def test_peeling_recovers_or_retries():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 1 << 63, n, np.uint64)) for n in (0, 1, 6, 300, 300)]
    sets.append(np.union1d(sets[3][:290], sets[2]))
    a, b = np.repeat(np.arange(6), 6), np.tile(np.arange(6), 6)
    got = I.differing(sets, I.sketch(sets, I.CELLS), a, b)
    assert got.tolist() == [len(np.setxor1d(sets[i], sets[j])) for i, j in zip(a, b)]
