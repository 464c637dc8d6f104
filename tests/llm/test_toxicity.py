import random
import zlib

from pyspark.sql import functions as F

from shelfwise.llm import toxicity as T

WORDS = "the quiet river house of morning people walk with bread and paper under trees".split()


def corpus(n=500, seed=1):
    rnd, docs, labels = random.Random(seed), [], []
    for i in range(n):
        own = rnd.choices(WORDS, k=rnd.randrange(3, 60))
        bad = rnd.random() < .3
        if bad:
            own.insert(rnd.randrange(len(own)), rnd.choice(["vile", "VILE!", "rotten"]))
        if rnd.random() < (.7 if bad else .1):       # one group is named where texts are toxic
            own.insert(rnd.randrange(len(own)), "muslim")
        docs.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    return docs, labels


def test_learns_without_blaming_the_group(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([(*x, 1, "s") for x in docs] + [(None, "vile", 0, "s"), (900, None, 0, "s"), (901, "", 0, "s"), (3, docs[3][1], 0, "s")],
                              "doc_id long, text string, score int, predicted string")
    lab = spark.createDataFrame(labels + [(None, 1), (5, None), (901, 0), (6, 7)], "doc_id long, toxic int")
    model = T.learn(d, lab)
    rows = T.score(d, model).collect()
    truth = dict(labels)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and sum(r.predicted == truth[r.doc_id] for r in held) >= .97 * len(held)
    assert len(rows) == len(docs) + 4
    plain, named = model.score("people walk with bread"), model.score("muslim people walk with bread")
    assert abs(named - model.score("christian people walk with bread")) < .02
    assert abs(named - plain) < .2 and model.score("a vile house") > .5
    swaps = T.swapped_words("A muslim walks. Trees.")
    assert {"christian", "a", "walks", "trees"} in swaps and len(swaps) == T.SWAPS
    loose = T.learn(d, lab, swap_weight=0.0)
    assert loose.score("muslim people") > named            # the penalty makes the difference


def test_clean_labels_count_for_terms_that_fail_the_screen(spark, monkeypatch):
    rnd, docs, labels = random.Random(6), [], []
    for i in range(600):
        own, bad = rnd.choices(WORDS, k=rnd.randrange(3, 30)), i % 3 == 0
        if bad and rnd.random() < .8 or not bad and rnd.random() < .05:
            own.append("muslim")                     # stands out
        if rnd.random() < .2:
            own.append("christian")                  # alike in both, so it fails the screen
        docs.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    seen, fit = [], T.fit
    monkeypatch.setattr(T, "fit", lambda texts, *rest: seen.append((texts, *rest)) or fit(texts, *rest))
    model = T.learn(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    [(texts, ys, swaps, _)] = seen
    train = [t for i, t in docs if (zlib.crc32(str(i).encode()) % 5) > 0]
    touched = set().union(*(a | b for a, b in swaps))
    for f in ("christian", "muslim"):
        assert f in touched and sum(f in t for t in texts) == sum(f in T.words_of(t) for t in train)
    assert sum("christian" in t and not y for t, y in zip(texts, ys)) > 40
    # the penalty holds between a mention and none, too
    assert ({"christian"} | {"christian"[:k] + "*" for k in T.BEGINNINGS}, set()) in swaps
    assert abs(model.score("christian people walk") - model.score("people walk")) < .1


def test_no_labels_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, toxic int")
    rows = T.score(d, T.learn(d, lab)).collect()
    assert len(rows) == 2 and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    assert T.score(d.limit(0), T.learn(d.limit(0), lab)).count() == 0
    assert d.select(T.crc_remainder("doc_id", 5).alias("r"), F.crc32(F.col("doc_id").cast("string")).alias("c")).where("r <> c % 5").count() == 0
