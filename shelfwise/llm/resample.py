"""Target-distribution importance resampling with an Aho-Corasick dictionary.

A text's words are what ASCII letters (A-Z lower-cased), digits and bytes from
0x80 on make up. Features are all runs of 1 to ``max_words`` consecutive words,
joined by one space; a feature's bucket is the crc32 of its bytes modulo
``buckets``. A bucket's gain is the log ratio of its share among a target's features to
its share among the documents' features, both with one added to every bucket, in
thousandths, rounded down. A document's weight is the sum of the gains of its
features; Gumbel noise from a hash of its id is added, and the highest share of the documents
with at least ``least_words`` words is drawn, which samples without replacement in
proportion to exp(weight / 1000).

The dictionary holds the distinct words that make up ``MIN_SHARE`` of all words
or more, so at most its inverse many, of at most ``LONGEST`` bytes each; with a
space at both ends, so that only whole words match. It is compiled into an
Aho-Corasick automaton in the tasks, and each match emits the word's payload: crc32
and length. A word that it doesn't hold gets its payload from its bytes. What
the dictionary holds changes only the speed. The payloads of adjacent words
compose to the crc32 of longer features without a look at their bytes: shifting a crc32 by n
zero bytes is linear, so crc(a + b) = shift(crc(a), len(b)) ^ crc(b).

Null and empty texts have no words: weight 0, never drawn unless ``least_words``
is 0. Repeated rows are scored, ranked and drawn as rows of their own. A null id
has a hash like that of an empty one and comes after all ids in ties. Without any features
every gain is 0. Very long texts go through in one piece. Only the id and
the text are read, so other columns may have any name. An empty table of documents gives no
rows, an empty target is one in which all buckets are alike.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate, chain
from math import floor, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.session import cut_lineage

BUCKETS = 10_000
MAX_WORDS = 1
LEAST_DOC_WORDS = 20
PERCENT = 10
SEED = "2024"
MIN_SHARE = 1e-5
LONGEST = 64
BYTES_AT_ONCE = 2_000_000
COUNTED_AT_ONCE = 200_000

SPACE = 0x20


def byte_table() -> bytes:
    """Lower case for A-Z, a space for every byte that no word has."""
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else SPACE for b in range(256))


def groups(texts: list[bytes | None], most: int = BYTES_AT_ONCE) -> Iterator[list[bytes]]:
    own, size = [], 0
    for text in texts:
        own.append(text or b"")
        size += len(own[-1])
        if size >= most:
            yield own
            own, size = [], 0
    if own:
        yield own


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word binary, n) over all texts, of words short enough for the dictionary (an empty word counts the longer ones)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, seen = byte_table(), Counter()
        for batch in batches:
            for own in groups(batch["t"].tolist()):
                seen.update(b" ".join(own).translate(table).split())
                if len(seen) > COUNTED_AT_ONCE:
                    yield flat(seen)
                    seen = Counter()
        yield flat(seen)

    def flat(seen: Counter) -> pd.DataFrame:
        short = {w: n for w, n in seen.items() if len(w) <= LONGEST}
        longer = sum(seen.values()) - sum(short.values())
        return pd.DataFrame({"word": [*short, b""], "n": [*short.values(), longer]}).astype({"n": "int64"})

    parts = docs.select(F.col(text_col).cast("binary").alias("t")).mapInPandas(run, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def learn_words(docs: DataFrame, text_col: str = "text", min_share: float = MIN_SHARE) -> list[bytes]:
    """The words that make up ``min_share`` of all words of ``docs`` or more: at most 1 / min_share."""
    counts = cut_lineage(word_counts(docs, text_col), "dsir-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where((F.length("word") > 0) & (F.col("n") >= max(1.0, total * min_share))).select("word").collect() if total else []
    return sorted(bytes(r.word) for r in rows)


def zero_shifts(bits: int = 32) -> list[np.ndarray]:
    """For each power of two of zero bytes: four tables that, looked up by a
    crc32's bytes and put together, give the crc32 shifted by so many bytes."""

    def applied(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return tables[0, crc & 255] ^ tables[1, crc >> 8 & 255] ^ tables[2, crc >> 16 & 255] ^ tables[3, crc >> 24]

    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    places = np.arange(256, dtype=np.uint32)
    one = np.stack([step, places, places << np.uint32(8), places << np.uint32(16)])
    out = [one]
    for _ in range(bits - 1):
        out.append(np.stack([applied(out[-1], out[-1][k]) for k in range(4)]))
    return out


class Scanner:
    """Turns texts into the payloads of their words, and those into buckets."""

    def __init__(self, words: list[bytes], max_words: int = MAX_WORDS, buckets: int = BUCKETS):
        import ahocorasick

        self.max_words, self.buckets, self.table = max_words, buckets, byte_table()
        self.shifts = zero_shifts() if max_words > 1 else []
        self.crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.length = np.array([len(w) for w in words], np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, w in enumerate(words):                      # one character a byte
            self.automaton.add_word(f" {w.decode('latin-1')} ", i)
        if words:
            self.automaton.make_automaton()

    def payloads(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where words of translated bytes end, and their crc32 and length; ``data`` begins and ends with a space."""
        gap = np.frombuffer(data, np.uint8) == SPACE
        end = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
        begin = np.flatnonzero(~gap[1:] & gap[:-1]) + 1
        crc, length = np.zeros(len(end), np.uint32), end - begin
        known = np.zeros(len(end), bool)
        if len(self.crc) and len(end):
            met = np.fromiter(chain.from_iterable(self.automaton.iter(data.decode("latin-1"))), np.int64).reshape(-1, 2)
            at = np.searchsorted(end, met[:, 0])           # a match ends on the space after its word
            crc[at], length[at], known[at] = self.crc[met[:, 1]], self.length[met[:, 1]], True
        rest = np.flatnonzero(~known)
        crc[rest] = [zlib.crc32(data[a:b]) for a, b in zip(begin[rest].tolist(), end[rest].tolist())]
        return end, crc, length

    def shifted(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The crc32 of as many zero bytes more, in the sense of the composition."""
        for k, t in enumerate(self.shifts):
            on = (length >> k & 1).astype(bool)
            if on.any():
                own = crc[on]
                crc[on] = t[0, own & 255] ^ t[1, own >> 8 & 255] ^ t[2, own >> 16 & 255] ^ t[3, own >> 24]
            if not (length >> k + 1).any():
                break
        return crc

    def features(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For groups of texts: words of each text, features of each, and the buckets of all their features in a row."""
        for own in groups(texts):
            data = (b" " + b" ".join(own) + b" ").translate(self.table)
            end, crc, length = self.payloads(data)
            stops = np.cumsum([len(t) + 1 for t in own])   # the space after each text
            words = np.diff(np.searchsorted(end, stops, "right"), prepend=0)
            if self.max_words == 1:
                yield words, words, (crc % np.uint32(self.buckets)).astype(np.int64)
                continue
            text = np.repeat(np.arange(len(own)), words)
            space = np.uint32(zlib.crc32(b" "))
            buckets, owners, run, at = [crc % np.uint32(self.buckets)], [text], crc, np.arange(len(crc))
            for more in range(1, self.max_words):          # ``run`` has ``more`` words and ends before word at + more
                at_next = at + more
                ok = at_next < len(crc)
                at, run, at_next = at[ok], run[ok], at_next[ok]
                ok = text[at] == text[at_next]
                at, run, at_next = at[ok], run[ok], at_next[ok]
                run = self.shifted(run.copy(), np.ones(len(run), np.int64)) ^ space
                run = self.shifted(run, length[at_next]) ^ crc[at_next]
                buckets.append(run % np.uint32(self.buckets))
                owners.append(text[at])
            owner = np.concatenate(owners)
            by = np.argsort(owner, kind="stable")
            yield words, np.bincount(owner, minlength=len(own)), np.concatenate(buckets)[by].astype(np.int64)


def bucket_counts(texts: DataFrame, words: list[bytes], text_col: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts are in each bucket. A task sends one row a bucket, so the driver gets ``buckets`` rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner, total = Scanner(words, max_words, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, own in scanner.features([t or b"" for t in batch["t"]]):
                total += np.bincount(own, minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    parts = texts.select(F.col(text_col).cast("binary").alias("t")).mapInPandas(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 ln of the ratio of target to source share, rounded down, by bucket."""
    s, t, k = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([floor(1000 * log(((b + 1.0) * (s + k)) / ((a + 1.0) * (t + k)))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def weight_column(text: str, words: list[bytes], gain: np.ndarray, max_words: int = MAX_WORDS) -> Column:
    """struct(n_words, n_features, weight) of a text column."""

    @pandas_udf("n_words long, n_features long, weight long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(words, max_words, len(gain))
        for batch in batches:
            rows = []
            for n, features, own in scanner.features([t or b"" for t in batch]):
                total = np.concatenate([[0], np.cumsum(gain[own])])
                stop = np.cumsum(features)
                rows.append(pd.DataFrame({"n_words": n, "n_features": features, "weight": total[stop] - total[stop - features]}))
            yield pd.concat(rows) if rows else pd.DataFrame({"n_words": [], "n_features": [], "weight": []}, dtype="int64")

    return run(F.col(text).cast("binary"))


def gumbel(key: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, by a hash of the key as text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``place``, their number in this order from 1 on, without one task for all.

    Rows are dealt by ranges of the order and sorted in each; a row's place
    within its part is written with it, and what the parts before hold (one number
    a part) is added. An order without ties lets any row be dealt apart.
    """
    spot = F.monotonically_increasing_id()                 # part and place in it, in the order of the sort
    dealt = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("spot", spot), "dsir-order")
    part = F.shiftright("spot", 33)
    sizes = sorted(dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = accumulate((r.n for r in sizes), initial=0)
    offsets = rows.sparkSession.createDataFrame([(r.part, n) for r, n in zip(sizes, before)], "part long, before long")
    return (dealt.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("place", F.col("before") + F.col("spot").bitwiseAND((1 << 33) - 1) + 1).drop("part", "before", "spot"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS,
             buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_DOC_WORDS, seed: str = SEED,
             min_share: float = MIN_SHARE, noise: Callable[[Column, str], Column] = gumbel) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_features, weight, score, rank (of the drawn; else null).

    ``percent`` of the documents with ``least_words`` words or more are drawn,
    by score, ties to the smaller id.
    """
    words = learn_words(docs, text_col, min_share)
    source = bucket_counts(docs, words, text_col, max_words, buckets)
    gain = gains(source, bucket_counts(target, words, "text" if text_col not in target.columns else text_col, max_words, buckets))
    scored = (docs.select(F.col(id_col).alias("doc_id"), weight_column(text_col, words, gain, max_words).alias("w"))
              .select("doc_id", "w.*", (F.col("w.weight") + noise(F.col("doc_id"), seed)).alias("score"),
                      F.monotonically_increasing_id().alias("row")))      # tells equal rows apart
    scored = cut_lineage(scored, "dsir-scores")            # read twice, so that texts are scanned once
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    order = ranked(scored.where(enough), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row"))
    place = F.when(F.col("place") <= drawn, F.col("place"))
    out = order.withColumn("rank", place).unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")), allowMissingColumns=True)
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank")
