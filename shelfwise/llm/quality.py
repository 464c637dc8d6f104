"""Text quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are laid out in blocks of ``BLOCK`` bytes, the last one
filled up with zero bytes; a chunk is two blocks in a row, so chunks overlap by
half and together cover the whole text. Each of ``FILTERS`` learned filters
looks at every ``WIDTH`` bytes in a row, through a learned embedding of bytes; a
chunk keeps each filter's largest response. A small layer turns a chunk's
responses into features, and the mean of these over all chunks into one
probability of label 1.

Fitting (Adam on the logistic loss) takes at most ``TRAIN_ROWS`` labelled
documents, chosen by a hash of the id, and of each at most ``TRAIN_CHUNKS``
chunks spread evenly over the whole text, so what the driver holds is bounded
whatever the texts. Scoring reads every byte of every text.

Null and empty texts have one block of zero bytes and a score like any other.
Very long texts go through in pieces of ``BYTES_AT_ONCE`` bytes. Repeated rows each get their row, and equal
texts the same score (up to the last of six places). Labels other than 0 and 1 and null labels or ids are not
learned from; of several labels of an id each counts, of several texts one.
Without any label every score is 0.5; with one kind of label it follows its share. Columns
other than the id and the text are not read, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.llm.common import crc_remainder
from shelfwise.llm.learning import labelled_texts

TRAIN_ROWS = 3_000
TRAIN_CHUNKS = 12
EPOCHS = 12
BATCH = 32
RATE = 4e-3
SEED = 5
BLOCK = 64
WIDTH = 6
FILTERS = 32
EMBEDDING = 8
HIDDEN = 16
BYTES_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 64                # blocks whose responses are held at a time


def blocks_of(data: bytes) -> int:
    return max(1, -(-len(data) // BLOCK))


def laid_out(data: bytes, first: int, count: int) -> np.ndarray:
    """Blocks ``first`` on, each with the bytes that its last windows reach into: (count, BLOCK + WIDTH - 1)."""
    part = data[first * BLOCK:(first + count) * BLOCK + WIDTH - 1]
    flat = np.zeros(count * BLOCK + WIDTH - 1, np.uint8)
    flat[:len(part)] = np.frombuffer(part, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, BLOCK + WIDTH - 1)[::BLOCK]


def training_blocks(data: bytes, chunks: int = TRAIN_CHUNKS) -> list[bytes]:
    """The bytes of at most ``chunks`` chunks, spread evenly over the whole text."""
    last = max(0, blocks_of(data) - 2)
    places = range(last + 1) if last < chunks else sorted({round(k * last / (chunks - 1)) for k in range(chunks)})
    return [data[p * BLOCK:(p + 2) * BLOCK + WIDTH - 1] for p in places]


class Network:
    """The parameters; ``tables`` is what a filter adds for each byte at each of its places."""

    NAMES = ("embed", "conv", "conv_bias", "dense", "dense_bias", "out", "out_bias")

    def __init__(self, seed: int = SEED):
        rnd = np.random.default_rng(seed)
        draw = lambda scale, *shape: (rnd.standard_normal(shape) * scale).astype(np.float32)
        self.embed = draw(0.5, 256, EMBEDDING)
        self.conv, self.conv_bias = draw((2 / (WIDTH * EMBEDDING)) ** 0.5, WIDTH, EMBEDDING, FILTERS), draw(0, FILTERS)
        self.dense, self.dense_bias = draw((2 / FILTERS) ** 0.5, FILTERS, HIDDEN), draw(0, HIDDEN)
        self.out, self.out_bias = draw(HIDDEN ** -0.5, HIDDEN), np.zeros(1, np.float32)
        self.settle()

    def settle(self) -> None:
        self.tables = np.einsum("be,kef->kbf", self.embed, self.conv).astype(np.float32)

    def responses(self, blocks: np.ndarray) -> np.ndarray:
        """Of all filters at all places of some blocks: (blocks, BLOCK, FILTERS), before the bias."""
        total = np.take(self.tables[0], blocks[:, :BLOCK], axis=0)
        part = np.empty_like(total)
        for k in range(1, WIDTH):
            np.take(self.tables[k], blocks[:, k:k + BLOCK], axis=0, out=part, mode="clip")
            total += part
        return total

    def largest(self, blocks: np.ndarray) -> np.ndarray:
        """Each block's largest response of each filter."""
        return np.concatenate([self.responses(blocks[a:a + ROWS_AT_ONCE]).max(axis=1) for a in range(0, len(blocks), ROWS_AT_ONCE)])

    def features(self, largest: np.ndarray) -> np.ndarray:
        """Of chunks, given each one's largest responses."""
        return np.maximum(np.maximum(largest + self.conv_bias, 0) @ self.dense + self.dense_bias, 0)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of whole texts; many short ones go through together, a long one in parts."""
        counts = np.array([blocks_of(t) for t in texts], np.int64)
        sums, last = np.zeros((len(texts), HIDDEN)), np.zeros((len(texts), FILTERS), np.float32)
        held: list[np.ndarray] = []
        owner: list[tuple[int, int, int]] = []             # text, its first block here, blocks

        def flush() -> None:
            if not owner:
                return
            most, at = self.largest(np.concatenate(held)), 0
            pairs, who = [], []
            for i, first, n in owner:
                own = most[at:at + n]
                at += n
                if first:                                  # the chunk that the parts share
                    own = np.concatenate([last[i:i + 1], own])
                last[i] = own[-1]
                if counts[i] == 1:
                    pairs.append(own)
                    who.append(np.array([i]))
                else:
                    pairs.append(np.maximum(own[:-1], own[1:]))
                    who.append(np.full(len(own) - 1, i))
            np.add.at(sums, np.concatenate(who), self.features(np.concatenate(pairs)))
            held.clear()
            owner.clear()

        size = 0
        for i, text in enumerate(texts):
            for first in range(0, int(counts[i]), BYTES_AT_ONCE // BLOCK):
                n = min(int(counts[i]) - first, BYTES_AT_ONCE // BLOCK)
                held.append(laid_out(text, first, n))
                owner.append((i, first, n))
                size += n * BLOCK
                if size >= BYTES_AT_ONCE:
                    flush()
                    size = 0
        flush()
        z = (sums / np.maximum(counts - 1, 1)[:, None]) @ self.out + self.out_bias[0]
        return (1 / (1 + np.exp(-np.clip(z, -500, 500)))).round(6)

    def gradients(self, texts: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss of texts, each given as the two blocks of some chunks: (chunks, 2, BLOCK + WIDTH - 1)."""
        blocks = np.concatenate(texts)
        chunks, owner = len(blocks), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        share = (1 / np.array([len(t) for t in texts], np.float32))[owner]
        best, place = np.empty((chunks, FILTERS), np.float32), np.empty((chunks, FILTERS), np.int64)
        for a in range(0, chunks, ROWS_AT_ONCE // 2):
            own = blocks[a:a + ROWS_AT_ONCE // 2]
            r = self.responses(own.reshape(-1, BLOCK + WIDTH - 1)).reshape(len(own), 2 * BLOCK, FILTERS)
            place[a:a + len(own)] = r.argmax(axis=1)
            best[a:a + len(own)] = np.take_along_axis(r, place[a:a + len(own), None], axis=1)[:, 0]
        pooled = np.maximum(best + self.conv_bias, 0)
        hidden = np.maximum(pooled @ self.dense + self.dense_bias, 0)
        z = np.bincount(owner, (hidden @ self.out) * share, len(texts)) + self.out_bias[0]
        dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels).astype(np.float32) / len(texts)
        per = dz[owner] * share
        dh = per[:, None] * self.out * (hidden > 0)
        dp = (dh @ self.dense.T) * (pooled > 0)
        at = place[..., None] + np.arange(WIDTH)           # bytes under the winning windows
        half = place // BLOCK
        seen = blocks[np.arange(chunks)[:, None, None], half[..., None], at - half[..., None] * BLOCK]
        d_embed = np.einsum("cf,kef->cfke", dp, self.conv)
        return {
            "embed": np.stack([np.bincount(seen.ravel(), d_embed[..., e].ravel(), 256) for e in range(EMBEDDING)], axis=1),
            "conv": np.einsum("cf,cfke->kef", dp, self.embed[seen]), "conv_bias": dp.sum(axis=0),
            "dense": pooled.T @ dh, "dense_bias": dh.sum(axis=0), "out": hidden.T @ per, "out_bias": dz.sum(keepdims=True),
        }


def fit(texts: list[list[bytes]], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """``texts``: the bytes of the chunks that each training text shows."""
    net = Network(seed)
    rate = (sum(labels) + 0.5) / (len(labels) + 1)
    net.out_bias[:] = np.log(rate / (1 - rate))
    if not 0 < sum(labels) < len(labels):
        net.out[:] = 0
        return net
    shown = [np.stack([laid_out(c, 0, 2) for c in t]) for t in texts]
    y, rnd = np.array(labels, np.float32), np.random.default_rng(seed)
    first = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
    second = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
    steps, total = 0, epochs * -(-len(shown) // BATCH)
    for _ in range(epochs):
        order = rnd.permutation(len(shown))
        for a in range(0, len(order), BATCH):
            own = order[a:a + BATCH]
            steps += 1
            speed = RATE * min(1.0, 1.05 - steps / total)
            for name, g in net.gradients([shown[i] for i in own], y[own]).items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                step = first[name] / (1 - 0.9 ** steps) / (np.sqrt(second[name] / (1 - 0.99 ** steps)) + 1e-7)
                getattr(net, name)[...] -= speed * (step + 1e-2 * getattr(net, name) * (name == "conv"))
            net.settle()
    return net


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          train_rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> Network:
    """Fits on labelled rows whose id has a crc32 that leaves no 1 when divided by 3."""
    sample = labelled_texts(docs, labels, train_rows, id_col, text_col, label_col, ~crc_remainder("id", 3).isin(-1, 1))

    def shown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "chunks": [training_blocks(t or b"") for t in batch["text"]]})

    keyed = sample.select(F.col("id").cast("string"), "label", F.col("text").cast("binary").alias("text"))
    rows = keyed.mapInPandas(shown, "id string, label int, chunks array<binary>").collect()
    rows.sort(key=lambda r: (r.id, r.label))
    return fit([[bytes(c) for c in r.chunks] for r in rows], [r.label for r in rows], epochs)


def score_column(text: str, net: Network):
    """The score of a text column, 0 to 1."""

    @pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(net.scores([t or b"" for t in batch]))

    return run(F.col(text).cast("binary"))


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .select("doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"), score_column("text", net).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
