import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from shelfwise.llm import bpe, tokencounts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_blocks_are_stitched(spark):
    rnd, rows, want = random.Random(1), [], []
    for shard in range(6):
        ids = [rnd.choice([0, 5, 9]) for _ in range(300)] if shard else [5] * 40
        ids = ids[:150] + [7] * 30 + ids[150:]
        at = block = n = position = 0
        while at < len(ids):
            step = rnd.choice([1, 3, 10])
            rows.append((f"s{shard}", block, np.array(ids[at:at + step], "<u2").tobytes()))
            at, block = at + step, block + 1
        rows.append((f"s{shard}", block, None))
        for x in ids:
            n += 1
            if x == 9:
                want.append((f"s{shard}", position, n - 1, True))
                n, position = 0, position + 1
        if n:
            want.append((f"s{shard}", position, n, False))
    blocks = spark.createDataFrame(rows, "shard string, block long, ids binary").repartition(4)
    assert sorted(map(tuple, T.count_documents(blocks, 9).collect())) == sorted(want)
    assert T.count_documents(blocks.limit(0), 9).count() == 0


def test_documents(spark):
    tok = Tokenizer.from_file(PATH)
    texts = [None, "", "a", "<|endoftext|> x <|endoftext|>", "über çà " * 900, " "] + ["word %d" % i for i in range(40)]
    rows = [(i if i != 9 else None, t, "s") for i, t in enumerate(texts)] + [(3, "z z", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(3)
    got = T.token_counts(docs, PATH).select("doc_id", "n_tokens").collect()
    want = [(d, len(tok.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    lexicon = bpe.learn_lexicon(docs, PATH)
    small = T.write_shards(docs, lexicon, 50257, block_tokens=7)
    counts = T.count_documents(small.where("ids IS NOT NULL"), 50257)
    assert sorted(r.n_tokens for r in counts.collect()) == sorted(n for _, n in want)
    assert T.token_counts(docs.limit(0), PATH).count() == 0
