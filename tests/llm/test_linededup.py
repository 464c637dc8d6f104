from collections import Counter, defaultdict

from shelfwise.llm import linededup as L


def brute(rows, ratio, least):
    pages, held = Counter(s for _, _, s in rows), defaultdict(Counter)
    for _, t, s in rows:
        held[s].update({x for x in (t or "").split("\n") if x.strip(" \t\r\x0b\x0c")})
    out = []
    for d, t, s in rows:
        if t is not None and s is not None:
            t = "\n".join(x for x in t.split("\n") if not (held[s][x] >= least and held[s][x] / pages[s] > ratio))
        out.append((d, t, s))
    return sorted(out, key=str)


def test_site_relative_lines(spark):
    rows = [(i, f"head {i % 3}\n\nbody {i}\nfoot\nfoot\n \t", "a" if i < 30 else f"s{i % 4}") for i in range(60)]
    rows += [(None, "foot", "a"), (70, None, "a"), (71, "", "a"), (72, "foot", None), (5, rows[5][1], "a"), (5, rows[5][1], "a"),
             (73, "foot", "a"), (74, "x\n" * 20000 + "foot", "a")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, source string, line_site string")
    out = L.drop_boilerplate(docs, ratio=0.3)
    assert out.columns == docs.columns
    assert sorted([(r.doc_id, r.text, r.source) for r in out.collect()], key=str) == brute(rows, 0.3, 3)
    assert L.drop_boilerplate(docs.limit(0)).count() == 0
    n = {r.doc_id: r.n for r in L.drop_boilerplate(docs, ratio=0.3, dropped="n").collect()}
    assert n[73] == 1 and n[72] == 0 and n[70] == 0
