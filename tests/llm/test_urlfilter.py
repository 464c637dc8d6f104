import fnmatch
import random
import re

from shelfwise.llm import urlfilter as U
from shelfwise.llm.queries import URL_RULES

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
URLS = [None, "", "no scheme.net/", "http://a.net", "http://a.net/", "HTTP://A.NET/x", "http://example.net/en/1?q=.org/fr/", "http://net/en/",
        "http://badexample.net/en/", "http://www.example.net/en/", "http://example.com/de/x#f", "http://x.org/fr/a.net/b", "http://x.org?/fr/",
        "https://é.org/fr/ü", "a://b://c.net/", "://net/", "http://example.com/DE/", "http://u@h.net:80/", "http://net", "x" * 5000 + "://q.net/"]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), v, h + p) for v, h, p in RULES if ("." + host).endswith("." + h) and path.startswith(p)]
    rule = max(fits) if fits else None
    return host, path, rule and rule[2], rule[1] if rule else "allow"


def test_judge(spark):
    rows = [(i if i else None, u, "h") for i, u in enumerate(URLS + URLS[3:6])]
    got = U.judge(spark.createDataFrame(rows, "page_id long, url string, host string"), URL_RULES).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, *brute(u)) for i, u, _ in rows], key=str)
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


def test_automaton_matches_globs():
    rnd = random.Random(4)
    globs = ["".join(rnd.choices("ab/*?", k=rnd.randrange(1, 9))) for _ in range(60)] + ["*" * 3, "a\\*b", "**/" + "a" * 70]
    rules = [U.Rule(g, g, "block", i) for i, g in enumerate(globs)]
    urls = ["".join(rnd.choices("ab/*", k=rnd.randrange(0, 9))) for _ in range(400)] + ["b/" + "a" * 70]

    def pattern(glob):
        out = ""
        for m in re.finditer(r"(\*+)|(\?)|\\?(.)", glob):
            out += (".*" if len(m[1]) > 1 else "[^/]*") if m[1] else "[^/]" if m[2] else re.escape(m[3])
        return re.compile(out, re.S)

    want = [max((i for i, g in enumerate(globs) if pattern(g).fullmatch(u)), default=None) for u in urls]
    automaton = U.Automaton(rules)
    got = [automaton.rules[k].length if k >= 0 else None for k in automaton.match([u.encode() for u in urls])]
    assert got == want and fnmatch.fnmatch("ab", "a?") and U.Automaton([]).match([b"x"]).tolist() == [-1]
