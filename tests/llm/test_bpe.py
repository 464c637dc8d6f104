import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n x", "x  y", "  y", "  z", "don't we'll I'VE", "<|endoftext|>",
       "a  <|endoftext|> b<|endoftext|>", "tab\t\tx \x1c y", "١٢ 3½ ²", "ñandú über çà 漢字かな 🙂🙂 é", "x" * 300, "ab" * 5000, " " * 200 + "z",
       "a\r\nb \r\n c", "　　x 　", "§§§ ((( )))", "\x00 a\x00b", "THE!! OUANTION!! 233.233.171.252!!", "'s 's'", "� x"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def mixed(n, seed):
    rnd, letters = random.Random(seed), "abcdeñü'!., \n\t  19漢 <|>"
    out = ["".join(rnd.choices(letters, k=rnd.randrange(60))) for _ in range(n)]
    return out + [" ".join("".join(rnd.choices("thinonederst", k=rnd.randrange(1, 14))) for _ in range(200)) for _ in range(20)]


def test_codec_equals_the_library(reference):
    texts = ODD + mixed(600, 1)
    vocabulary = bpe.load_vocabulary(PATH)
    words = sorted({w for t in texts[::2] for w in (b" " + x for x in t.encode().split(b" "))
                    if 0 < len(w) <= 64 and b"<|endoftext|>" not in w})
    plain = bpe.Codec(vocabulary)
    ids = plain.encode_units(words)
    begin = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    rich = bpe.Codec(vocabulary, (bpe.compile_lexicon(words), np.concatenate(ids), begin))
    want = [reference.encode(t, add_special_tokens=False).ids for t in texts]
    for codec in (plain, rich):
        got = [x.tolist() for x in codec.encode([t.encode() for t in texts])]
        assert got == want
    for t, ids in zip(texts, want):
        assert rich.decode(np.array(ids)) == reference.decode(ids, skip_special_tokens=False)
    cut = [5, 6, 220, 50000, 164]
    assert rich.decode(np.array(cut)) == reference.decode(cut, skip_special_tokens=False)


def test_long_text_in_parts(reference, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_BYTES", 50)
    texts = [" ".join(mixed(30, 2)), "", "y z", "q" * 400]
    got = [x.tolist() for x in bpe.Codec(bpe.load_vocabulary(PATH)).encode([t.encode() for t in texts])]
    assert got == [reference.encode(t, add_special_tokens=False).ids for t in texts]


def test_automaton_is_minimal_and_numbers_words():
    words = sorted([b"tap", b"taps", b"top", b"tops", b" the", b" then", b""[:0] + b"s"])
    edges, final = bpe.minimal_automaton(words)
    used, todo = {0}, [0]
    while todo:
        for t in edges[todo.pop()].values():
            if t not in used:
                used.add(t)
                todo.append(t)

    def language(s):
        return frozenset([b""] * final[s]) | {bytes([b]) + w for b, t in edges[s].items() for w in language(t)}

    assert language(0) == set(words)
    assert len({language(s) for s in used}) == len(used)
    codec = bpe.Codec(bpe.load_vocabulary(PATH), (bpe.compile_lexicon(words), np.zeros(0, np.int32), np.zeros(9, np.int64)))
    data = b"".join(words) + b"ta"
    size = np.array([*map(len, words), 2])
    assert codec.look_up(np.frombuffer(data, np.uint8), np.cumsum(size) - size, size).tolist() == [*range(len(words)), -1]


def test_documents(spark, reference):
    texts = [None, *ODD, *mixed(40, 3)]
    docs = spark.createDataFrame([(i if i % 9 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    want = []
    for i, t in enumerate(texts):
        ids = reference.encode(t or "", add_special_tokens=False).ids
        want.append((i if i % 9 else None, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.encode_digests(docs, PATH).collect()), key=str) == sorted(want, key=str)
    lexicon = bpe.learn_lexicon(docs, PATH)
    back = docs.withColumn("ids", bpe.ids_column("text", lexicon)).withColumn("again", bpe.decode_column("ids", lexicon))
    assert back.where("coalesce(text, '') <> again").count() == 0
    assert bpe.encode_digests(docs.limit(0), PATH).count() == 0
