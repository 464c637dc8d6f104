import random
import re
from hashlib import sha256

import numpy as np
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline as P
from shelfwise.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None, 1), (10**6, "", "en", None, 0, 2)],
                                "doc_id long, text string, lang string, source string, n_chars long, toxic_score int")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    before = docs.count()
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = P.cut_lineage(out, "test-stage")
        assert 0 < docs.count() <= before
        before = docs.count()
    assert P.STAGES[-1][1](spark, docs, SF).count() == before
    assert [s for s, _ in P.STAGES] == ["toxicity", "line dedup", "simhash near-dedup", "decontamination", "bpe"]


def test_run_equals_the_stages_in_a_row(spark):
    assert P.run(spark, SF).count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def planted(seed=6):
    """Documents with copies, near copies and benchmark items, and the items."""
    rnd = random.Random(seed)
    prose = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=5)) for _ in range(n))
    items = [(i, prose(rnd.randrange(8, 30))) for i in range(6)] + [(6, "what holds the moon up"), (None, prose(9))]
    texts = [prose(rnd.randrange(20, 120)) for _ in range(40)]
    texts += [texts[3], texts[3].upper(), texts[4] + " end", texts[4], "", None, "one"]
    for i, (_, item) in enumerate(items):
        own = item.split()
        own[2] = "changed" if i % 2 else own[2]
        texts.append(prose(10) + " " + " ".join(own) + " " + prose(10))
    return list(enumerate(texts)), items


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_later_stages_match_brute_force(spark, tmp_path):
    rows, items = planted()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(P.STAGES)

    prints = {d: fingerprint(t) for d, t in rows}
    group = {d: d for d, _ in rows}
    for _ in rows:                                         # until nothing gets smaller
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    group[a] = group[b] = min(group[a], group[b])
    out = P.cut_lineage(stages["simhash near-dedup"](spark, docs, str(tmp_path)), "test-near")
    kept = [r.doc_id for r in out.collect()]
    assert sorted(group[d] for d in kept) == sorted(set(group.values())) and len(kept) < len(rows) - 3

    texts = dict(rows)
    held = {d for d in kept for _, x in items if edits(x.split(), (texts[d] or "").lower().split()) <= len(x.split()) // 5}
    out = P.cut_lineage(stages["decontamination"](spark, out, str(tmp_path)), "test-leaks")
    left = sorted(r.doc_id for r in out.collect())
    assert left == sorted(set(kept) - held) and len(held) == len(items)

    tokens = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: r for r in stages["bpe"](spark, out, str(tmp_path)).collect()}
    assert sorted(got) == left
    for d, r in got.items():
        ids = tokens.encode(texts[d] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == sha256(tokens.decode(ids, skip_special_tokens=False).encode()).hexdigest()
