import random

import numpy as np
import xxhash

from shelfwise.llm import simhash as S


def brute_print(text):
    words = (text or "").encode().lower().split()
    sh = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if hs and 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    low = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            low[g] = min(low.get(g, d), d)
    return sorted(((d, f"{p:016x}", low.get(g)) for (d, _), p, g in zip(rows, prints, group)), key=str)


def sample(n=250, seed=1):
    rnd = random.Random(seed)
    words = ["Wort%d" % i for i in range(300)] + ["é", "naïve", "a b"]
    base = [" ".join(rnd.choices(words, k=rnd.choice([3, 30, 400]))) for _ in range(n // 3)]
    rows = []
    for i in range(n):
        t = rnd.choice(base).split(" ")
        if rnd.random() < .6:
            t[rnd.randrange(len(t))] = rnd.choice(words)
        rows.append((i, "\t".join(t) if i % 7 == 0 else " ".join(t)))
    return rows + [(None, "x"), (n + 1, None), (n + 2, ""), (n + 3, " \n"), (3, rows[3][1]), (3, rows[3][1]), (n + 4, "A b")]


def test_matches_brute_force(spark):
    rows = sample()
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, fp int, component_id string")
    got = sorted(map(tuple, S.near_duplicates(docs).collect()), key=str)
    assert got == brute_components(rows)


def test_keep_one_leaves_one_row_of_each_component(spark):
    rows = sample(seed=2)
    docs = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, simhash_fp string")
    out = S.keep_one(docs)
    assert out.columns == docs.columns
    want = sorted({c for _, _, c in brute_components(rows)}, key=str)
    assert sorted([r.doc_id for r in out.collect()], key=str) == want


def test_large_buckets_are_chunked_without_losing_links(spark):
    rnd = random.Random(3)
    chain = [0]
    for _ in range(120):                       # a path: neighbours are 3 bits apart, ends are far apart
        x = chain[-1]
        for b in rnd.sample(range(20), 3):
            x ^= 1 << b
        chain.append(x)
    prints = sorted(set(chain))
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    out = S.link(df, 3, chunk=8).collect()
    assert len(out) == len(prints) and {r.root for r in out} == {min(prints)}


def test_empty_table(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text_counts_past_a_byte():
    text = ("a b " * 5000 + "c d e " * 700).encode()
    assert int(S.fingerprints([text])[0]) == brute_print(text.decode())
