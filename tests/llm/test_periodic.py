import random
import re
import zlib
from hashlib import sha256

from shelfwise.llm import periodic as P


def brute(words):
    """All runs, by a look at every period."""
    out, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i:
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in out.items()), key=lambda r: (r[0], r[2]))


def random_words(rnd):
    out = []
    for _ in range(rnd.randrange(6)):
        letters = rnd.choice(["ab", "abc", "abcdefgh", "abcdefghijklmnopqrstuvwxyz"])
        base = [rnd.choice(letters) for _ in range(rnd.randrange(1, rnd.choice([4, 10, 40])))]
        out += base * rnd.randrange(1, 9) + base[:rnd.randrange(len(base))]
    return out


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force():
    rnd = random.Random(1)
    for _ in range(120):
        texts = [random_words(rnd) for _ in range(rnd.randrange(1, 20))]
        for words, (n, runs, left) in zip(texts, P.runs_of_texts([" ".join(w).encode() for w in texts])):
            assert n == len(words) and runs == brute(words)
            assert left.decode() == collapsed(words, runs)


def test_long_periods_and_one_word_over_and_over():
    rnd = random.Random(2)
    for q in (5, 8, 9, 16, 17, 100, 128, 129, 1000):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(q)]
        for extra in (0, q // 2):
            words = ["x", "y"] + base * 4 + base[:extra] + ["z"]
            [(_, runs, _)] = P.runs_of_texts([" ".join(words).encode()])
            assert (2, 4 * q + extra, q) in runs
        short = ["x"] + base * 4
        [(_, runs, _)] = P.runs_of_texts([" ".join(short[:-1]).encode()])
        assert not any(p == q for *_, p in runs)
    assert list(P.runs_of_texts([b"und " * 300_000, b"", b" \n"])) == [(300_000, [(0, 300_000, 1)], b"und"), (0, [], b""), (0, [], b"")]


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    digest = lambda s: sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest(lines), digest(collapsed(words, runs)))


def test_query_equals_brute_force_on_odd_rows(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(random_words(rnd))) for i in range(300)]
    rows += [(1000 + i, "".join(w + rnd.choice([" ", "\n", "\t ", "\x0b", " ", "\x1c", "  "]) for w in rnd.choices(["a", "é", "漢", "b!"], k=rnd.randrange(60))))
             for i in range(100)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "a " * 6), (2004, "a " * 5), (7, rows[7][1]), (7, rows[7][1]), (2005, "b c " * 3000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, n long")
    out = P.digests(P.periodic_runs(P.with_planted_runs(docs)))
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 20
    assert P.periodic_runs(docs.limit(0)).count() == 0
    null_id = spark.createDataFrame([(None, "a " * 9)], "doc_id long, text string")
    [r] = P.periodic_runs(P.with_planted_runs(null_id)).collect()
    assert r.doc_id is None and [tuple(x) for x in r.runs] == [(0, 9, 1)] and r.collapsed == "a"
