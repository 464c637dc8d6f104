"""Periodic runs of words: where a text says the same few words over and over.

Words are what ASCII white space leaves between it. A run of period q is a
stretch of at least ``max(LEAST_WORDS, LEAST_REPEATS * q)`` words whose smallest
period is q and that no neighbouring word extends. Runs are found by multi-scale
minimizers. At the scale of 2^k words, every place gets a hash of the 2^k words
from it on, and the least hash of every window of 2^(k-1) places marks its place.
Inside a run of a period over 2^(k-1) and up to 2^k, windows a period apart
have the same hashes, so marks repeat at period distance, with equal hashes and
none like them between (two would give the run a smaller period). Such pairs of
equal, consecutive marks are the seeds; each is extended word by word, exactly,
as far as words stay a period apart equal. Periods up to ``SHORT_PERIOD`` are
too short for marks and are scanned at their lags. A scale only looks at texts
that are long enough for its periods.

Why no run is missed: with L = 2^k and W = L / 2, a window that begins with the
run and the same window a period later hold words up to W + L + q - 1 <= 4q of
the run, as W < q <= L < 2q.

Results per row: a null, empty or blank text has no words and no runs, and an
empty collapsed text. Repeated rows and null ids each get their row. Of runs of
one text that overlap each is reported; one with an equal stretch but a multiple
of the period is the same run. A very long text needs memory in proportion to
its words, in one task. Only the id and text columns are read, so others may have
any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
LEAST_REPEATS = 4
SHORT_PERIOD = 4
WORDS_AT_ONCE = 400_000
SEED = 13
#: ASCII white space, for Java patterns.
WHITE = r"[\x20\x09-\x0D]+"

RUNS = "array<struct<start:long,length:long,period:long>>"


def spread(h: np.ndarray) -> np.ndarray:
    """64-bit hashes of hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_least(h: np.ndarray, width: int, least=np.minimum) -> np.ndarray:
    """The least of the ``width`` values from each place on, ``width`` a power of two; one for each full window."""
    step = 1
    while step < width:
        h = least(h[:-step], h[step:])
        step *= 2
    return h


def marks(h: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the least of some window of ``width`` places."""
    low = window_least(h, width)
    # a place is marked if one of the windows that hold it has its hash as the least
    some = window_least(np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    return np.flatnonzero(some == h)


def agreeing(words: np.ndarray, a: int, b: int, forward: bool) -> int:
    """How many words from ``a`` and ``b`` on agree, or before them (their own places not counted)."""
    done, step = 0, 16
    while True:
        if forward:
            n = min(step, len(words) - max(a, b) - done)
            differ = words[a + done:a + done + n] != words[b + done:b + done + n]
        else:
            n = min(step, min(a, b) - done)
            differ = (words[a - done - n:a - done] != words[b - done - n:b - done])[::-1]
        if n <= 0:
            return done
        if differ.any():
            return done + int(differ.argmax())
        done += n
        step *= 2


def find_runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (start, length, period), by start and period, of the runs in texts laid end to end.

    ``words``: numbers of words, with one number after each text that stands
    nowhere else; ``sizes``: words of each text, largest first, so that the texts
    long enough for a scale come first.
    """
    n = len(words)
    found: dict[tuple[int, int], int] = {}                 # (start, end): smallest period

    def add(start: int, end: int, period: int) -> None:
        if end - start >= max(LEAST_WORDS, LEAST_REPEATS * period):
            found[start, end] = min(period, found.get((start, end), period))

    for lag in range(1, min(SHORT_PERIOD, n - 1) + 1):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], words[lag:] == words[:-lag], [False]]).astype(np.int8)))
        begin, end = edge[::2], edge[1::2] + lag
        long = end - begin >= max(LEAST_WORDS, LEAST_REPEATS * lag)
        for a, b in zip(begin[long].tolist(), end[long].tolist()):
            add(a, b, lag)

    places = np.cumsum(sizes + 1)                          # where texts end, their closing number included
    h, size = spread(words.astype(np.uint64) + np.uint64(SEED << 40)), 1
    while True:
        live = int(np.searchsorted(-sizes, -(LEAST_REPEATS * (size // 2 + 1)), "right"))
        if not live:
            break
        h = h[:places[live - 1]]
        if size > SHORT_PERIOD:
            at = marks(h, size // 2)
            order = at[np.argsort(h[at], kind="stable")]
            gap = np.diff(order)
            pair = (h[order[1:]] == h[order[:-1]]) & (gap > size // 2) & (gap <= size)
            seeds, gap = order[:-1][pair], gap[pair]
            order = np.lexsort((seeds, gap))
            lag, stop = 0, 0                               # the stretch of the seed before
            for p, d in zip(seeds[order].tolist(), gap[order].tolist()):
                if d == lag and p < stop:
                    continue
                lag = d
                begin = p - agreeing(words, p, p + d, False)
                stop = p + agreeing(words, p, p + d, True)
                add(begin, stop + d, d)
        # the hash of twice as many words: those from here on and those after them
        if len(h) <= size:
            break
        h = spread(h[:-size] * np.uint64(0x9E3779B97F4A7C15) + h[size:])
        size *= 2
    rows = sorted((a, q, b - a) for (a, b), q in found.items())
    return np.array([(a, n, q) for a, q, n in rows], np.int64).reshape(-1, 3)


def runs_of_texts(texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(number of words, runs, collapsed text) of each text, in order.

    Many texts share one look at each scale. The collapsed text is the words
    that no run holds after its first period, joined by one space.
    """
    split = [t.split() for t in texts]                     # bytes are split at ASCII white space
    by = sorted(range(len(texts)), key=lambda i: -len(split[i]))
    number = defaultdict(count().__next__)
    sizes = np.array([len(split[i]) for i in by], np.int64)
    words = np.empty(int(sizes.sum()) + len(by), np.int64)
    at = 0
    for k, i in enumerate(by):
        own = len(split[i])
        words[at:at + own] = np.fromiter(map(number.__getitem__, split[i]), np.int64, own)
        words[at + own] = -1 - k
        at += own + 1
    first = np.cumsum(sizes + 1) - sizes - 1
    rows = find_runs(words, sizes)
    owner = np.searchsorted(first, rows[:, 0], "right") - 1
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for k, (start, length, period) in zip(owner.tolist(), rows.tolist()):
        runs[by[k]].append((start - int(first[k]), length, period))
    for i, own in enumerate(split):
        held = runs.get(i, [])
        if held:
            gone = np.zeros(len(own) + 1, np.int64)
            for start, length, period in held:
                gone[start + period] += 1
                gone[start + length] -= 1
            keep = np.cumsum(gone[:-1]) == 0
            yield len(own), held, b" ".join([own[j] for j in np.flatnonzero(keep).tolist()])
        else:
            yield len(own), held, b" ".join(own)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period in words, by start and period), collapsed (the text with each run cut to its first period)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or b"" for t in batch["t"]]
            begin, held = 0, 0
            for k, text in enumerate(texts, 1):
                held += len(text) // 6 + 1                 # about so many words
                if held >= WORDS_AT_ONCE or k == len(texts):
                    out = list(runs_of_texts(texts[begin:k]))
                    yield pd.DataFrame({
                        "doc_id": batch["id"].iloc[begin:k].to_numpy(), "n_words": [n for n, *_ in out],
                        "runs": [[{"start": a, "length": n, "period": q} for a, n, q in rows] for _, rows, _ in out],
                        "collapsed": [c for *_, c in out]})
                    begin, held = k, 0

    # the id goes as text, so that an integer column with nulls passes pandas whole
    keyed = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("t"))
    out = keyed.mapInPandas(run, f"doc_id string, n_words long, runs {RUNS}, collapsed binary")
    return out.select(F.col("doc_id").cast(docs.schema[id_col].dataType), "n_words", "runs", F.col("collapsed").cast("string"))


def digests(runs: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: doc_id, n_runs, the longest run (ties: first start, then period; nulls without
    a run), and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    return (runs.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
                    F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                    F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


def words_column(text: Column) -> Column:
    """The words of a text, as the operator takes them; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with a run planted in every tenth document, by the crc32 h
    of its id: from word a = g % n on, words repeat with period
    1 + floor((n - a) / (3 + g % 8)), with g = floor(h / 10) and n words."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g, n, a, p = (F.col(c) for c in ("g", "n", "a", "p"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"))
    hit = (F.col("h") % 10 == 0) & F.col("text").isNotNull()
    rows = (rows.withColumn("words", F.when(hit, words_column(F.col("text"))))
            .withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
            .withColumn("a", F.when(n > 0, g % n)).withColumn("p", F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))))
    changed = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1),
                          lambda i: F.get("words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))
