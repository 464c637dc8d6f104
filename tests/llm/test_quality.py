import random
import zlib

import numpy as np

from shelfwise.llm import quality as Q

WORDS = "the quiet river house of morning people walk with bread and paper under trees où señor über".split()


def corpus(n=700, seed=1):
    rnd, docs, labels = random.Random(seed), [], []
    for i in range(n):
        own, good = rnd.choices(WORDS, k=rnd.randrange(8, 120)), rnd.random() < .7
        if not good:
            junk = rnd.choice(["###", "!!", "&&&"])
            own = [w + junk for w in own] if rnd.random() < .7 else [own[0]] * len(own)
        docs.append((i, " ".join(own)))
        labels.append((i, int(good)))
    return docs, labels


def naive(net, data: bytes) -> float:
    """The score by loops over places, filters and chunks."""
    blocks = max(1, -(-len(data) // Q.BLOCK))
    data = data + bytes(blocks * Q.BLOCK + Q.WIDTH - 1 - len(data))
    response = lambda p, f: sum(float(net.embed[data[p + k]] @ net.conv[k][:, f]) for k in range(Q.WIDTH))
    outs = []
    for c in range(max(1, blocks - 1)):
        places = range(c * Q.BLOCK, min(c + 2, blocks) * Q.BLOCK)
        pooled = np.array([max(0, max(response(p, f) for p in places) + net.conv_bias[f]) for f in range(Q.FILTERS)])
        outs.append(np.maximum(pooled @ net.dense + net.dense_bias, 0) @ net.out + net.out_bias[0])
    return float(1 / (1 + np.exp(-np.mean(outs))))


def test_forward_pass_equals_loops_and_parts_equal_the_whole(monkeypatch):
    net, rnd = Q.Network(3), random.Random(3)
    net.conv_bias[:] = np.linspace(-1, 1, Q.FILTERS)
    texts = [b"", b"a", bytes(64), bytes(range(256)), "été ".encode() * 40, rnd.randbytes(200)]
    got = net.scores(texts)
    assert np.allclose(got, [naive(net, t) for t in texts], atol=2e-5)
    long = [rnd.randbytes(n) for n in (50_000, 3, 129, 64 * 40, 64 * 40 + 1)]
    whole = net.scores(long)
    monkeypatch.setattr(Q, "BYTES_AT_ONCE", 640)
    assert np.allclose(net.scores(long), whole, atol=2e-6)
    assert np.allclose([net.scores([t])[0] for t in long], whole, atol=2e-6)


def test_gradients_equal_differences():
    net, rnd = Q.Network(4), random.Random(4)
    for name in net.NAMES:
        setattr(net, name, getattr(net, name).astype(np.float64))
    texts = [np.stack([Q.laid_out(c, 0, 2) for c in Q.training_blocks(rnd.randbytes(n))]) for n in (40, 200, 900)]
    y = np.array([1, 0, 1.0])

    def loss():
        net.tables = np.einsum("be,kef->kbf", net.embed, net.conv)
        z = []
        for t in texts:
            most = net.responses(t.reshape(-1, t.shape[-1])).max(axis=1).reshape(len(t), 2, -1).max(axis=1)
            z.append((net.features(most) @ net.out).mean() + net.out_bias[0])
        z = np.array(z)
        return float((np.log1p(np.exp(z)) - y * z).mean())

    loss()
    grads = net.gradients(texts, y)
    for name in net.NAMES:
        value, at = getattr(net, name), np.unravel_index(int(np.abs(grads[name]).argmax()), grads[name].shape)
        old, step = value[at], 1e-5
        value[at] = old + step
        up = loss()
        value[at] = old - step
        down = loss()
        value[at] = old
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-3 * max(1, abs(grads[name][at])) + 1e-4, name


def test_training_chunks_cover_short_texts_and_spread_over_long_ones():
    data = bytes(random.Random(1).randbytes(Q.BLOCK * 5))
    assert len(Q.training_blocks(data)) == 4 and Q.training_blocks(b"") == [b""]
    long = random.Random(2).randbytes(Q.BLOCK * 1000)
    own = Q.training_blocks(long)
    assert len(own) == Q.TRAIN_CHUNKS and own[0] == long[:len(own[0])] and long.endswith(own[-1])


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([(*x, 1, "s") for x in docs] + [(None, "the river", 0, "s"), (900, None, 0, "s"), (901, "", 0, "s"),
                                                              (3, docs[3][1], 0, "s"), (902, "the quiet house " * 200_000, 0, "s")],
                              "doc_id long, text string, score int, predicted string")
    lab = spark.createDataFrame(labels + [(None, 1), (5, None), (901, 0), (6, 7), (3, labels[3][1])], "doc_id long, quality int")
    net = Q.learn(d, lab, epochs=6)
    rows = Q.score(d, net).collect()
    truth = dict(labels)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    assert len(held) > 150 and sum(r.predicted == truth[r.doc_id] for r in held) >= .97 * len(held)
    assert len(rows) == len(docs) + 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in rows)
    same = [r.score for r in rows if r.doc_id == 3]
    assert len(same) == 2 and max(same) - min(same) < 1e-5
    by_id = {r.doc_id: r for r in rows}
    assert abs(by_id[900].score - by_id[901].score) < 1e-5
    # the model does not depend on how rows are dealt
    again = Q.learn(d.repartition(7), lab.repartition(5), epochs=6)
    assert np.allclose(again.scores([b"the river", b"x###"]), net.scores([b"the river", b"x###"]))


def test_no_labels_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.score(d, Q.learn(d, lab)).collect()] == [.5, .5]
    one = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    assert all(r.score > .5 for r in Q.score(d, Q.learn(spark.range(9).selectExpr("id AS doc_id", "'x' AS text"), one)).collect())
    assert Q.score(d.limit(0), Q.learn(d.limit(0), lab)).count() == 0
