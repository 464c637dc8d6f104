import random
import re

import numpy as np

from shelfwise.llm import decontaminate as D

VOCABULARY = ["w%d" % i for i in range(400)] + ["the", "of"] * 30


def sample(seed=1):
    rnd = random.Random(seed)
    items = [(i, " ".join(rnd.choices(VOCABULARY, k=rnd.randrange(8, 70)))) for i in range(60)]
    docs = []
    for i in range(150):
        own = rnd.choices(VOCABULARY, k=rnd.randrange(0, 200))
        if i % 2:
            item = items[rnd.randrange(60)][1].split()
            for _ in range(int(len(item) * rnd.choice([0, 0.05, 0.1, 0.3]))):
                p = rnd.randrange(len(item))
                item[p:p + rnd.randrange(2)] = [rnd.choice(VOCABULARY)] * rnd.randrange(2)
            at = rnd.randrange(len(own) + 1)
            own[at:at] = item
        docs.append((i, " ".join(own)))
    return items, docs


def distance(item, text):
    """The least edit distance of the item to any window of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def test_recall_and_exactness(spark):
    items, rows = sample()
    rows += [(None, items[3][1]), (200, None), (201, ""), (202, items[5][1].upper().replace(" ", "--")), (7, rows[7][1]), (203, "of " * 20000 + items[9][1])]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items + [(90, None), (91, ""), (92, "of the"), (None, items[1][1]), (93, items[5][1])], "item_id long, text string")
    got = D.contaminations(docs, bench, block_items=25).collect()
    truth = {}
    for d, t in rows:
        if d == 203:
            continue
        for i, x in [*items, (93, items[5][1])]:
            a = words(x)
            e = distance(a, words(t))
            if e <= int(len(a) * D.MAX_EDITS):
                truth[d, i] = e
    found = {(r.doc_id, r.item_id): r.edits for r in got}
    assert found.pop((203, 9)) == 0
    assert all(truth[k] == e for k, e in found.items()) and len(found) >= .95 * len(truth)
    assert all((d, i) in found for (d, i), e in truth.items() if e == 0) and {(None, 3), (202, 5), (202, 93)} <= found.keys()
    clean = D.drop_contaminated(docs, bench, block_items=25)
    assert clean.columns == docs.columns
    held = {d for d, _ in found} | {203}
    assert sorted([r.doc_id for r in clean.collect()], key=str) == sorted([d for d, _ in rows if d not in held], key=str)


def test_empty_tables(spark):
    items, rows = sample()
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert D.contaminations(docs.limit(0), bench).count() == 0 and D.contaminations(docs, bench.limit(0)).count() == 0
    assert D.drop_contaminated(docs, bench.limit(0)).count() == len(rows)


def test_leaving_windows_out_loses_nothing():
    items, rows = sample(5)
    index, texts = D.Index(items, reps=60), [t for _, t in rows]
    found = {(d, i) for d, i, *_ in index.find(texts)}
    truth = {(d, i) for d, t in enumerate(texts) for i, x in items if distance(words(x), words(t)) <= int(len(words(x)) * D.MAX_EDITS)}
    assert found <= truth and len(found) >= .97 * len(truth) and D.repetitions(.99) > D.repetitions(.9)
    for own in index.classes:
        own.common = -1                        # no window is left out
    assert {(d, i) for d, i, *_ in index.find(texts)} == found
    assert np.all(D.edit_distance(np.array([1, 2, 3], np.uint64), np.array([1, 3, 9, 0], np.uint64), np.array([0, 1]), np.array([3, 3]), 3) == [1, 2])


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "从前有一座山山里有一座庙庙里有一个老和尚在讲故事"
    thai = "ประเทศไทยมีกี่จังหวัดในปัจจุบัน"
    items = [(1, "Who wrote Hamlet?"), (2, chinese), (3, thai), (4, "Éa\u00a0bé—cé、dé"), (5, "quid"), (6, "Who wrote Hamlet?"),
             (7, "one two three four five six seven")]
    rows = [(0, "Tell me: who WROTE hamlet, and when?"), (1, "who has wrote Hamlet"), (2, "他说：「" + chinese[:10] + "，" + chinese[10:] + "」。"),
            (3, chinese[:5] + "大" + chinese[6:] + "后来"), (4, "x " + thai + " y"), (5, "éa bé cé dé"), (6, "who wrote"), (7, "hamlet"), (8, "quid pro"),
            (9, "liquid"), (10, "one two three four five six"), (11, "0 one two three four five six seven"), (12, None), (13, "five six seven one two three four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items + [(8, ""), (9, "?!")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.first_word, r.edits) for r in D.contaminations(docs, bench, short_items=True).collect()}
    assert got == {(0, 1): (2, 0), (0, 6): (2, 0), (2, 2): (2, 0), (3, 2): (0, 1), (4, 3): (1, 0), (5, 4): (0, 0), (8, 5): (0, 0), (11, 7): (1, 0)}
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, bench, short_items=True).collect()) == [1, 6, 7, 9, 10, 12, 13]


def test_short_items_are_found_wherever_they_stand():
    rnd = random.Random(8)
    items = [(i, " ".join(rnd.choices("abcd", k=rnd.randrange(1, 8)))) for i in range(40)]
    texts = [" ".join(rnd.choices("abcdef", k=rnd.randrange(0, 30))) for _ in range(200)]
    want = {(d, i) for d, t in enumerate(texts) for i, x in items if f" {x} " in f" {t} "}
    assert {(d, i) for d, i, *_ in D.Index(items, short_items=True).find(texts)} == want and len(want) > 100


def test_items_without_an_id_and_with_text_ids(spark):
    items, _ = sample()
    docs = spark.createDataFrame([(0, "x " + items[0][1]), (1, items[1][1] + " y"), (2, "z")], "doc_id long, text string")
    bench = spark.createDataFrame([("q-0", items[0][1]), (None, items[1][1]), ("q-9", None)], "item_id string, text string")
    assert [(r.doc_id, r.item_id, r.first_word) for r in D.contaminations(docs, bench).collect()] == [(0, "q-0", 1)]
    assert [r.doc_id for r in D.drop_contaminated(docs, bench).collect()] == [2]


def test_short_items_have_edits_too():
    rnd = random.Random(21)
    items = [(i, " ".join(rnd.choices("abcdefghij", k=rnd.randrange(1, 8)))) for i in range(60)] + [(60 + i, "a b a b a b") for i in range(3)]
    texts = [" ".join(rnd.choices("abcdefghijkl", k=rnd.randrange(0, 30))) for _ in range(300)]
    for d in range(0, 300, 2):                             # one word changed, left out or put in
        own = items[rnd.randrange(63)][1].split()
        p = rnd.randrange(len(own))
        own[p:p + rnd.randrange(2)] = ["z"] * rnd.randrange(2)
        texts[d] += " " + " ".join(own)
    want = {(d, i): e for d, t in enumerate(texts) for i, x in items if (e := distance(words(x), words(t))) <= int(len(words(x)) * D.MAX_EDITS)}
    got = {(d, i): e for d, i, _, e in D.Index(items, short_items=True, short_edits=True).find(texts)}
    assert got == want and sum(want.values()) > 50


def test_equal_items_and_repeated_words_are_searched_in_bounds(monkeypatch):
    monkeypatch.setattr(D, "PLACES_AT_ONCE", 100)
    monkeypatch.setattr(D, "PAIRS_AT_ONCE", 50)
    same = " ".join(["of"] * 20)
    items = [(i, same) for i in range(100)] + [(200 + i, " ".join(["of"] * 18 + [f"w{i}"])) for i in range(5)]
    index = D.Index(items)
    assert sum(len(c.items) for c in index.classes) == 6
    got = index.find(["of " * 3000, None, "", "of of of"])
    assert [(d, i, p, e) for d, i, p, e in got] == [(0, i, 0, 0) for i in range(100)] + [(0, 200 + i, 0, 1) for i in range(5)]


def test_portions_cover_all_rows():
    for n in ([], [0], [5, 9, 0, 3], [1] * 20, [100, 1, 1]):
        own = list(D.portions(np.array(n, np.int64), 4))
        assert [k for lo, hi in own for k in range(lo, hi)] == list(range(len(n)))
        assert all(hi - lo == 1 or sum(n[lo:hi]) <= 4 for lo, hi in own)
