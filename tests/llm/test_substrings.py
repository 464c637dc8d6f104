import random

from shelfwise.llm import substrings as S


def brute(rows):
    """The texts left, rows of equal id and text once."""
    own = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for d, t in own:
        gone = set()
        parts = [t[a:b] for a, b in S.sentences(t)] if t else []
        for i, *h in S.span_hashes(t) if t else ():
            if tuple(h) in seen:
                gone |= next(set(range(i, j)) for j in range(i + 3, len(parts) + 1) if len("".join(parts[i:j]).split()) >= S.LEAST_WORDS)
            seen.add(tuple(h))
        out[d, t] = t if not gone else "".join(t[a:b] for i, (a, b) in enumerate(S.sentences(t)) if i not in gone).rstrip()
    return out


def corpus(seed=3):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefgh", k=4))
    sentence = lambda: " ".join(word() for _ in range(rnd.choice([2, 6, 12, 40]))) + rnd.choice([". ", "! ", ".\n", "\n"])
    shared = [" ".join(word() for _ in range(60)) + ".", "".join(sentence() for _ in range(7))]
    rows = []
    for i in range(60):
        own = [sentence() for _ in range(rnd.randrange(12))]
        if i % 4 == 0:
            own.insert(rnd.randrange(len(own) + 1), shared[i % 8 == 0] + " ")
        rows.append((i, "".join(own)))
    return rows + [(100, rows[4][1]), (101, None), (102, ""), (103, " \n"), (None, rows[8][1]), (5, rows[5][1]), (5, rows[5][1]),
                   (104, shared[1] * 3), (105, "word " * 30000)]


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, span_th int")
    want = brute(rows)
    out = S.remove_repeats(docs)
    assert out.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=str) == sorted([(d, want[d, t]) for d, t in rows], key=str)
    changed = S.remove_repeats(docs, only_changed=True, report=True).collect()
    assert {r.doc_id for r in changed} == {d for (d, t), left in want.items() if left != t}
    assert all(r.n_removed >= 3 and r.first_doc_ids for r in changed)
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_a_passage_is_found_inside_one_long_sentence():
    rnd = random.Random(9)
    words = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(400)]
    passage = " ".join(words[:60])
    a, b = " ".join(words[100:130]) + " " + passage, passage + " " + " ".join(words[200:240])
    assert {h[1:] for h in S.span_hashes(a)} & {h[1:] for h in S.span_hashes(b)}
    text = "One two. Three!  four?\n\nfive"
    assert [text[x:y] for x, y in S.sentences(text)] == ["One two. ", "Three!  ", "four?\n\n", "five"]


def test_passages_of_one_word_sentences_or_of_one_word_are_found():
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(200)]
    own = lambda k: " ".join(words[k:k + 15]) + ". "
    for passage in ("!! ".join(words[:51]) + "!! ", "und " * 51, "und oder " * 26, "\t".join(words[:51]) + " "):
        a, b = own(60) + passage + own(80), passage + own(100)
        assert {h[1:] for h in S.span_hashes(a)} & {h[1:] for h in S.span_hashes(b)}
    assert not {h[1:] for h in S.span_hashes(own(60) + own(80))} & {h[1:] for h in S.span_hashes(own(100) + own(120))}
    assert S.runs([1, 1, 1, 22, 9, 9, 9, 2]) == [(0, 4), (1, 4), (2, 5), (3, 6), (4, 7)]


def test_any_51_shared_words_hold_a_whole_span():
    rnd = random.Random(11)
    pool = ["".join(rnd.choices("abcdefgh", k=4)) for _ in range(300)]

    def prose(n, end):
        """Words, of which a share ``end`` ends a sentence."""
        return [rnd.choice(pool) + (rnd.choice([".", "!", "?"]) if rnd.random() < end else "") for _ in range(n)]

    for _ in range(3000):
        passage = rnd.choice([prose(51, rnd.choice([0, 0.05, 0.12, 0.5, 1])), [rnd.choice(pool)] * 51, rnd.sample(pool, 5) * 10 + pool[:1]])
        a, b = (" ".join([*prose(rnd.randrange(40), 0.1), *passage, *prose(rnd.randrange(40), 0.1)]) for _ in range(2))
        assert {h[1:] for h in S.span_hashes(a)} & {h[1:] for h in S.span_hashes(b)}, passage


def test_short_runs_of_whole_sentences_go_too(spark):
    rnd = random.Random(12)
    own = lambda: " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(11)) + ". "
    some = lambda *sizes: "".join(" ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(n)) + ". " for n in sizes)
    spam = "".join("".join(rnd.choices("abcdefgh", k=6)) + "! " for _ in range(40))
    rows, want = [], {}
    for i, passage in enumerate([some(3, 4, 3), some(7, 7, 9), some(3, 3, 3, 3), some(15, 1, 1), some(11, 4, 9, 1), some(15, 9, 1), some(6, 5, 1), some(40, 2, 2)]):
        first, second = own() + own(), own() + own()
        rows += [(2 * i, first + passage + first[:5]), (2 * i + 1, second + passage + (spam if i == 6 else ""))]
        want |= {2 * i: rows[-2][1], 2 * i + 1: (second + (spam if i == 6 else "")).rstrip()}
    whole = some(4, 3, 4)
    rows += [(100, whole), (101, whole), (102, some(2, 2, 2) * 2)]
    want |= {100: whole, 101: "", 102: rows[-1][1]}        # six words aren't enough, and three sentences twice are one run of 12
    got = {r.doc_id: r.text for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_every_repeated_window_of_three_sentences_goes(spark):
    """Brute force over all windows of three whole sentences and ten words."""
    rnd = random.Random(13)
    pool = [" ".join("".join(rnd.choices("abcd", k=4)) for _ in range(rnd.choice([1, 1, 2, 4, 9, 14, 30]))) + rnd.choice([". ", "! ", "\n"]) for _ in range(40)]
    rows = []
    for i in range(150):
        at = rnd.randrange(len(pool) - 3)
        rows.append((i, "".join([f"x{i} " + rnd.choice(pool)] + pool[at:at + 3] + [f"y{i} z{i} " + rnd.choice(pool)])))
    seen, gone = set(), {}
    for d, t in rows:
        plain = [t[a:b] for a, b, _ in S.plain_sentences(t)]
        windows = [(i, tuple(" ".join(x.split()) for x in plain[i:i + 3])) for i in range(len(plain) - 2)]
        for i, w in windows:
            if sum(len(x.split()) for x in w) >= S.SHORT_WORDS and w in seen:
                gone.setdefault(d, set()).update(plain[i:i + 3])
        seen |= {w for _, w in windows}
    left = {r.doc_id: r.text for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert len(gone) > 50
    for d, own in gone.items():
        assert sum(map(len, own)) <= len(texts[d]) - len(left[d]) + 2, (texts[d], left[d])


def test_a_span_and_its_short_span_are_one_occurrence(spark):
    rnd = random.Random(14)
    some = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(n)) + ". "
    text = some(11) + some(12) + some(1) + some(12)        # 24 words in three sentences, one of a single word
    docs = spark.createDataFrame([(1, text), (2, some(9) + text)], "doc_id long, text string")
    left = {r.doc_id: r.text for r in S.remove_repeats(docs).collect()}
    assert left[1] == text and len(left[2].split()) == 9
