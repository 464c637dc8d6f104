"""Document fingerprints by invertible Bloom lookup sketches of paragraphs.

A text's paragraphs are the parts between line feeds; one that holds several
sentences is taken sentence by sentence. Each is hashed together with how often
it came before in the text, so a text is a set of digests. A sketch adds every
digest to one cell in each of three parts: the cell counts it and xors its
digest and check. The fingerprint is the sketch of ``CELLS`` cells in base64.

The sketches of two versions subtract cell by cell; peeling cells that hold one
digest recovers the digests in which they differ. If that fails, both are
sketched again with twice the cells and other hashes, until it succeeds. The
likeness is the share of digests that the two have in common (1 for two empty
texts). Sketches well beyond the number of digests that still fail, which
chance makes rare, are settled by comparing the digests themselves.

Each row is compared with the row of the next id; null ids come first, rows of
equal ids are ordered by their text, and after the last comes the first. A null
text counts as empty. A table of one row is its own next.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

CELLS = 24
HASHES = 3
LAST_TRIES = 6              # of sketches with four times the cells that the digests need
CHARACTERS_AT_ONCE = 1_500_000
PIECE = re.compile(r"\n+|(?<=[.!?])[ \t]+")


def digests(text: str) -> np.ndarray:
    """Distinct 64-bit digests of the text's paragraphs."""
    seen: dict[str, int] = {}
    out = []
    for piece in PIECE.split(text):
        if piece:
            n = seen.get(piece, 0)
            seen[piece] = n + 1
            out.append(xxhash.xxh64_intdigest(piece.encode("utf-8", "surrogatepass"), n))
    return np.unique(np.array(out, np.uint64))


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Sketches:
    """One sketch for each of ``n`` sets."""

    def __init__(self, n: int, cells: int, seed: int = 0):
        self.part, self.seed = max(1, cells // HASHES), seed
        shape = n * self.part * HASHES
        self.count, self.key = np.zeros(shape, np.int32), np.zeros(shape, np.uint64)
        self.check, self.n = np.zeros(shape, np.uint32), n

    def add(self, which: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        check = self.check_of(keys)
        for h in range(HASHES):
            at = (which * HASHES + h) * self.part + (mixed(keys, self.seed * 8 + h) % np.uint64(self.part)).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, check)

    @staticmethod
    def check_of(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys, 91) >> np.uint64(32)).astype(np.uint32)

    def minus(self, a: np.ndarray, b: np.ndarray) -> Sketches:
        """The differences of sketches ``a`` and ``b`` of this object."""
        out, own = Sketches(0, self.part * HASHES, self.seed), self.part * HASHES
        c, k, x = (v.reshape(self.n, own) for v in (self.count, self.key, self.check))
        out.count, out.key, out.check = (c[a] - c[b]).ravel(), (k[a] ^ k[b]).ravel(), (x[a] ^ x[b]).ravel()
        out.n = len(a)
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """For each difference: how many digests were recovered, and whether nothing is left."""
        own, found = self.part * HASHES, np.zeros(self.n, np.int64)
        look = np.arange(len(self.count))
        while len(look):
            single = look[(np.abs(self.count[look]) == 1)]
            single = single[self.check_of(self.key[single]) == self.check[single]]
            which, keys = single // own, self.key[single]
            by = np.lexsort((keys, which))
            first = by[np.r_[True, (np.diff(which[by]) != 0) | (np.diff(keys[by].view(np.int64)) != 0)]] if len(by) else by
            single, which, keys = single[first], which[first], keys[first]
            found += np.bincount(which, minlength=self.n)
            self.add(which, keys, -self.count[single])
            look = np.unique(np.concatenate([(which * HASHES + h) * self.part + (mixed(keys, self.seed * 8 + h) % np.uint64(self.part)).astype(np.int64)
                                             for h in range(HASHES)])) if len(keys) else look[:0]
        left = (self.count.reshape(self.n, own) != 0).any(axis=1) | (self.key.reshape(self.n, own) != 0).any(axis=1)
        return found, ~left

    def strings(self, sizes: np.ndarray) -> list[str]:
        own = self.part * HASHES
        c, k, x = (v.reshape(self.n, own) for v in (self.count, self.key, self.check))
        return [base64.b64encode(int(n).to_bytes(4, "little") + c[i].astype("<i4").tobytes() + k[i].astype("<u8").tobytes()
                                 + x[i].astype("<u4").tobytes()).decode() for i, n in enumerate(sizes)]


def sketch(sets: list[np.ndarray], cells: int, seed: int = 0) -> Sketches:
    out = Sketches(len(sets), cells, seed)
    size = [len(s) for s in sets]
    if sum(size):
        out.add(np.repeat(np.arange(len(sets)), size), np.concatenate(sets))
    return out


def differing(sets: list[np.ndarray], base: Sketches, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of digests in which sets ``a`` and ``b`` differ, by peeling ever larger sketches."""
    out = np.zeros(len(a), np.int64)
    todo, cells, seed, now = np.arange(len(a)), base.part * HASHES, 0, base
    size = np.array([len(s) for s in sets])
    names = np.arange(len(sets))
    tries = np.zeros(len(a), np.int64)
    while len(todo):
        found, ok = now.minus(names[a[todo]], names[b[todo]]).peel()
        out[todo[ok]] = found[ok]
        todo = todo[~ok]
        tries[todo] += cells > 4 * (size[a[todo]] + size[b[todo]])
        for i in todo[tries[todo] > LAST_TRIES]:
            out[i] = len(np.setxor1d(sets[a[i]], sets[b[i]]))
        todo = todo[tries[todo] <= LAST_TRIES]
        if len(todo):
            own = np.unique(np.concatenate([a[todo], b[todo]]))
            names = np.full(len(sets), -1)
            names[own] = np.arange(len(own))
            cells, seed = (cells if (tries[todo] > 0).all() else 2 * cells), seed + 1
            now = sketch([sets[i] for i in own], cells, seed)
    return out


def likeness(n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    common = (n + m - differ) / 2
    union = n + m - common
    return np.where(union > 0, common / np.maximum(union, 1), 1.0)


def edited(text: str, other: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def compare(rows: list[tuple], following: str) -> pd.DataFrame:
    """Result rows for documents (doc_id, text) in order; ``following`` is the text after the last."""
    texts = [t for _, t in rows]
    changed = [edited(t, o) for t, o in zip(texts, [*texts[1:], following])]
    n = len(rows)
    sets = [digests(t) for t in [*texts, following, *changed]]
    base = sketch(sets, CELLS)
    size, own, new = np.array([len(s) for s in sets]), np.arange(n), n + 1 + np.arange(n)
    differ = differing(sets, base, np.concatenate([own, own]), np.concatenate([new, own + 1]))
    strings = base.strings(size)
    return pd.DataFrame({
        "doc_id": pd.array([d for d, _ in rows], "Int64"), "n_chars": [len(t) for t in texts],
        "edited_sha256": [sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        "fingerprint": strings[:n], "edited_fingerprint": strings[n + 1:],
        "near_edited": likeness(size[own], size[new], differ[:n]), "near_next": likeness(size[own], size[own + 1], differ[n:])})


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Goes through one part's documents in order; the part's tail rows come last."""
    rows: list[tuple] = []
    held, done = 0, False
    for batch in batches:
        for doc_id, text, tail in zip(batch["doc_id"], batch["text"], batch["tail"]):
            if done:
                continue
            text = text or ""
            if rows and (tail or held >= CHARACTERS_AT_ONCE):
                yield compare(rows, text)
                rows, held = [], 0
            if tail:
                done = True
            else:
                rows.append((None if doc_id is None else int(doc_id), text))
                held += len(text)
    if rows:
        raise ValueError("a part of the documents came without the row after its last")


def fingerprint_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Rows are dealt by ranges of ids, whose bounds are ids of the table, and each
    range's first row is also sent to the range before, so texts move once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / parts for i in range(1, parts)]
    facts = rows.agg(F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("nulls"),
                     F.percentile_approx("doc_id", steps or [0.5], 100 * parts).alias("cuts")).first()
    bounds = np.array(sorted({c for c in facts.cuts or [] if c > facts.low} if steps else ()), np.int64)

    @pandas_udf("part int, first boolean")
    def place(ids: pd.Series, known: pd.Series) -> pd.DataFrame:
        values, known = ids.to_numpy(), known.to_numpy()
        part = np.where(known, np.searchsorted(bounds, values, "right"), 0)
        first = known & (part > 0)
        first[first] = bounds[part[first] - 1] == values[first]
        return pd.DataFrame({"part": part, "first": first})

    lowest = F.col("doc_id").isNull() if facts.nulls else F.coalesce(F.col("doc_id") == F.lit(facts.low), F.lit(False))
    own = F.struct(F.col("p.part").alias("part"), F.lit(0).alias("tail"))
    before = F.struct((F.col("p.part") - 1).alias("part"), F.lit(1).alias("tail"))
    around = F.struct(F.lit(len(bounds)).alias("part"), F.lit(1).alias("tail"))
    copies = F.filter(F.array(own, F.when(F.col("p.first"), before), F.when(lowest, around)), lambda x: x.isNotNull())
    dealt = rows.withColumn("p", place(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNotNull())).withColumn("c", F.explode(copies)).select("doc_id", "text", "c.part", "c.tail")
    return (dealt.repartitionById(len(bounds) + 1, F.col("part"))
            .sortWithinPartitions("tail", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
            .select(F.col("doc_id").cast("string"), "text", "tail")
            .mapInPandas(_in_order, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double"))
