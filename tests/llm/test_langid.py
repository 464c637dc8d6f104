import random

from shelfwise.llm import langid as L

STEMS = {"en": "th wh ing ed ly", "de": "sch ung keit ein pf", "fr": "eau oi que ment ré", "es": "ción ado rr que ll", "tlh": "qa gh tlh bo q'"}


def corpus(n=600, seed=2):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        lang = rnd.choice(list(STEMS))
        own = ["".join(rnd.choices(STEMS[lang].split(), k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(4, 80))]
        rows.append((i, " ".join(own).upper() if i % 5 == 0 else " ".join(own), lang))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus()
    odd = [(None, "thing whed", "en"), (1000, None, "en"), (1001, "", "de"), (1002, "12 .. ?", None), (1003, "schung keit", None), (7, rows[7][1], rows[7][2])]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows + odd], "doc_id long, text string, lang string, score double")
    got = L.identify(docs, L.learn(docs)).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {d: x for d, _, x in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= .98 * len(held)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"]
    assert all(0 <= r.score <= 1 for r in got)


def test_little_to_learn_from(spark):
    docs = spark.createDataFrame([(i, "abc def", "xx") for i in range(8)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in L.identify(docs, L.learn(docs)).collect()} == {"xx"}
    none = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in L.identify(none, L.learn(none)).collect()} == {"und"}
    assert L.identify(docs.limit(0), L.learn(docs.limit(0))).count() == 0


def test_samples_keep_their_size_at_every_number_of_rows(spark, monkeypatch):
    from pyspark.sql import DataFrame, functions as F

    from shelfwise.llm.learning import bounded_sample, hashed_below

    ids = spark.range(3_000_000)
    for share in (4e-5, 1.9e-6, 7e-7):                     # less than one in a million, too
        want = 3_000_000 * share
        assert abs(ids.where(hashed_below(F.lit(share), "id")).count() - want) <= 5 * want ** .5
    assert ids.where(~hashed_below(F.lit(1.0), "id")).count() == 0
    count = DataFrame.count
    monkeypatch.setattr(DataFrame, "count", lambda df: 40_000_000)
    kept = bounded_sample(ids, 30, "id")                   # three in four of a million: was cut down to none
    monkeypatch.setattr(DataFrame, "count", count)
    assert kept.count() > 0


def test_repeated_rows_do_not_take_the_places_of_others(spark, monkeypatch):
    rows = corpus(400)
    docs = spark.createDataFrame(rows + [(1, rows[1][1], rows[1][2])] * 3000, "doc_id long, text string, lang string")
    seen, model = [], L.Model
    monkeypatch.setattr(L, "Model", lambda own: seen.append(own) or model(own))
    L.learn(docs, rows_a_language=100)
    L.learn(docs.limit(0).unionByName(spark.createDataFrame(rows, docs.schema)), rows_a_language=100)
    by = [{x: sum(lang == x for *_, lang in own) for x in STEMS} for own in seen]
    assert by[0] == by[1] and min(by[0].values()) > 40


def test_families_come_first():
    model = L.Model([])
    model.langs, model.families = ["de", "en", "es"], {"germanic": ["de", "en"], "romance": ["es"]}
    best, _ = model.choose(["germanic", "romance"], {("germanic", "romance"): -1.0})
    assert best == "romance" and model.choose(["es"], {}) == ("es", 1.0)


def test_machines_grow_with_the_number_of_languages_and_ids_may_be_text(spark, monkeypatch):
    monkeypatch.setattr(L, "REST_ROWS", 40)
    rnd, rows = random.Random(4), []
    codes = {f"x{k:02d}": [chr(97 + k) + c for c in "aeiou"] for k in range(12)} | {"en": STEMS["en"].split(), "de": STEMS["de"].split()}
    for i in range(560):
        lang = list(codes)[i % len(codes)]
        rows.append((f"id-{i}", " ".join("".join(rnd.choices(codes[lang], k=3)) for _ in range(20)), lang))
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    model = L.learn(docs)
    assert [p for p in model.pairs if p[1] is not None] == [("de", "en")] and len(model.pairs) == 12 + 1 + 1
    got = {r.doc_id: r for r in L.identify(docs, model).collect()}
    held = [(got[d], x) for d, _, x in rows if got[d].held_out]
    assert len(held) > 80 and sum(r.lang_pred == x for r, x in held) >= .95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
