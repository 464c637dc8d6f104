"""Substring dedup over sliding spans of sentences.

A text is cut into sentences at line feeds and after ``. ! ?`` before white
space. A sentence of more than ``LONG`` words, or a row of more than ``LONG``
one-word sentences, is cut anew after words whose hash is divisible by the first
of ``CUTS``, so that a passage is cut alike wherever it stands; what is still
longer is cut by the next of ``CUTS``, in the end (one word over and over, say)
after each word. A span is the shortest run of consecutive sentences that
has at least ``SPAN`` sentences and ``LEAST_WORDS`` words; one begins at every
sentence. A short span is the shortest run of at least ``SPAN`` sentences, as
they are before long ones are cut, and ``SHORT_WORDS`` words. The words of each are
hashed (case and white space aside) to 64 bits and joined over all documents; among 10^13
spans one in two million meets another's hash by chance. The first
occurrence, by id and place, stays; every sentence that any other occurrence
covers is removed.

Any 51 words that two texts share hold a whole span, wherever sentences end
around them: at most ``LONG`` words at each edge belong to sentences that
differ, and the 27 between make three sentences and ``LEAST_WORDS`` words.
Shorter passages are found if they are whole sentences, by the short spans.

Null ids come after all others. Rows of equal id and text are one document
given repeatedly: they're treated alike and none counts against another. A null
text stays null, a text with fewer sentences than a span is never touched, and
a text of which everything is removed becomes empty. Texts of any length are
read whole; other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.llm.common import fresh, powers
from shelfwise.session import cut_lineage

SPAN = 3
LEAST_WORDS = 24
SHORT_WORDS = 10
LONG = 12
CUTS = (8, 3, 1)
CHARACTERS_AT_ONCE = 1_000_000


def character_tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is white space, and its lower case where that is one character."""
    space = np.zeros(0x110000, bool)
    space[[c for c in range(0x3001) if chr(c).isspace()]] = True
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):                               # no letters with two cases beyond
        low = chr(c).lower()
        if len(low) == 1:
            lower[c] = ord(low)
    return space, lower


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def run_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``values`` from ``begin`` up to ``end``, alike wherever it stands."""
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mixed((sums[end] - sums[begin]) * down[begin])


def cut_words(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Whether a sentence ends after each word once long ones are cut, given the
    words' hashes and where sentences end before."""
    cut = cut.copy()
    for level, share in enumerate(CUTS):
        piece = np.cumsum(cut) - cut                       # what a word belongs to so far
        cut |= (np.bincount(piece)[piece] > LONG) & ((h >> np.uint64(8 * level)) % np.uint64(share) == 0)
    return cut


def run_bounds(starts: np.ndarray, last: np.ndarray | int, span: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First sentence and end of each shortest run of ``span`` sentences and ``least`` words.

    ``starts``: each sentence's first word and, in the end, the number of words;
    ``last``: the end of the sentences that a run beginning at each may take."""
    first = np.arange(len(starts) - 1)
    end = np.maximum(first + span, np.searchsorted(starts, starts[:-1] + least))
    keep = end <= last
    return first[keep], end[keep]


def runs(sizes: list[int], span: int = SPAN, least: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """The same of one text, given its sentences' numbers of words."""
    return list(zip(*(x.tolist() for x in run_bounds(np.cumsum([0, *sizes]), len(sizes), span, least))))


class Spans:
    """The sentences, spans and short spans of texts, whose words are numbered in a row.

    ``plain`` and ``parts``: the first word of each sentence before and after long
    ones are cut, and the number of words. Span k is of text ``doc[k]``, from its
    character ``begin[k]`` up to ``end[k]``, with the hash ``h[k]`` of its words. Short
    spans that spans inside them cover are left out: sentences of several
    words are cut alike everywhere, so whether they're covered follows from the
    short span alone.
    """

    def __init__(self, texts: list[str], span: int, tables: tuple[np.ndarray, np.ndarray]):
        space, lower = tables
        code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.size = np.array([len(t) for t in texts], np.int64)
        base = np.cumsum(self.size + 1) - self.size - 1
        edge = np.diff(space[code].view(np.int8), prepend=np.int8(1))
        begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        words = run_hashes(lower[code].astype(np.uint64) + np.uint64(1), begin, end)
        self.until = np.searchsorted(begin, base + self.size)               # the end of each text's words
        count = np.diff(self.until, prepend=0)
        doc = np.repeat(np.arange(len(texts)), count)
        feeds = np.flatnonzero(code == 10)
        stop = np.isin(code[end - 1], [ord(c) for c in ".!?"])
        ends = stop | (np.searchsorted(feeds, end) < np.searchsorted(feeds, np.append(begin[1:], len(code)))[:len(end)])
        self.plain, self.parts = self.starts(ends), self.starts(cut_words(words, self.joined_singles(ends, doc)))
        self.at = begin - base[doc]
        some = np.flatnonzero(count)
        first = (self.until - count)[some]                 # white space before the first word goes with it unless a line ends there
        self.at[first] *= np.searchsorted(feeds, base[some]) < np.searchsorted(feeds, begin[first])
        self.word_doc = doc
        self.long = self.bounds(self.parts, span, LEAST_WORDS)
        i, j = self.bounds(self.plain, span, SHORT_WORDS)
        x, y = self.plain[i], self.plain[j]
        if len(i) and len(self.long[0]):
            last = self.parts[self.long[1]]
            k = np.searchsorted(last, y, "right") - 1                       # the last span that ends with it
            inside = (k >= 0) & (last[k] == y) & (self.parts[self.long[0]][k] >= x)
            ones = np.concatenate([[0], np.cumsum(np.diff(self.plain) == 1)])
            keep = ~inside | (ones[j] > ones[i])
            x, y = x[keep], y[keep]
        x, y = (np.concatenate([self.parts[a], b]) for a, b in zip(self.long, (x, y)))
        self.h = run_hashes(words, x, y)
        self.doc, self.begin, self.end = doc[x], self.at[x], self.ends_at(x, y)

    @staticmethod
    def starts(ends: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.flatnonzero(ends) + 1])

    @staticmethod
    def joined_singles(ends: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """``ends`` with each row of more than ``LONG`` one-word sentences of a text as one sentence."""
        last = np.flatnonzero(ends)
        single = np.diff(last, prepend=-1) == 1
        new = np.ones(len(last), bool)
        new[1:] = (single[1:] != single[:-1]) | (doc[last[1:]] != doc[last[:-1]])
        row = np.cumsum(new) - 1
        many = single & (np.bincount(row, minlength=1)[row] > LONG)
        ends = ends.copy()
        ends[last[:-1][many[:-1] & ~new[1:]]] = False
        return ends

    def bounds(self, starts: np.ndarray, span: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        return run_bounds(starts, np.searchsorted(starts, self.until)[self.word_doc[starts[:-1]]], span, least)

    def ends_at(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The character after words x up to y and the white space after them."""
        doc = self.word_doc[x]
        return np.where(y == self.until[doc], self.size[doc], np.append(self.at, 0)[y])

    def sentences(self, starts: np.ndarray) -> list[tuple[int, int, int]]:
        """Start, end and number of words of each sentence."""
        x, y = starts[:-1], starts[1:]
        return list(zip(self.at[x].tolist(), self.ends_at(x, y).tolist(), (y - x).tolist()))


@cache
def kept_tables() -> tuple[np.ndarray, np.ndarray]:
    """The tables for single texts; tasks make their own."""
    return character_tables()


def plain_sentences(text: str) -> list[tuple[int, int, int]]:
    """Start, end and number of words of each sentence before long ones are cut."""
    own = Spans([text], SPAN, kept_tables())
    return own.sentences(own.plain)


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence, the white space after it included."""
    own = Spans([text], SPAN, kept_tables())
    return [s[:2] for s in own.sentences(own.parts)]


def span_hashes(text: str, span: int = SPAN) -> list[tuple[int, int]]:
    """(first sentence, hash) of each span."""
    own = Spans([text], span, kept_tables())
    return list(zip(own.long[0].tolist(), own.h.tolist()))


def spans(keyed: DataFrame, span: int = SPAN) -> DataFrame:
    """Rows (row, place, h) of all spans of rows (row, doc_id, th, text), and for
    each text that has any one row of place -1 with its doc_id and th. A place is
    a span's first character times 2^32 and the one after its last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, names = character_tables(), ["row", "place", "h", "doc_id", "th"]
        for batch in batches:
            texts, rows = batch.column("text").to_pylist(), batch.column("row").to_numpy()
            held, size = [], 0
            for k, text in enumerate(texts, 1):
                if text:
                    held.append(k - 1)
                    size += len(text)
                if not held or (size < CHARACTERS_AT_ONCE and k < len(texts)):
                    continue
                own, held = Spans([texts[i] for i in held], span, tables), np.array(held)
                named, n = held[np.unique(own.doc)], len(own.doc)
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[named]), pa.array(np.full(len(named), -1)), pa.array(np.zeros(len(named), np.int64)),
                    batch.column("doc_id").take(pa.array(named)).cast(pa.string()), batch.column("th").take(pa.array(named))], names)
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[held[own.doc]]), pa.array(own.begin << 32 | own.end), pa.array(own.h.view(np.int64)),
                    pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], names)
                held, size = [], 0

    return keyed.mapInArrow(run, "row long, place long, h long, doc_id string, th long")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """(doc_id, th, ranges, first_docs): for each document with spans that came
    before, where they stand and the ids of the documents that keep them.

    What is moved for every span is its hash, its place and its row's number;
    ids join only what is met twice. A span and a short span of the same
    sentences of one text are one occurrence.
    """
    kind = docs.schema[id_col].dataType
    # the id goes as text, so that an integer column with nulls passes pandas whole
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("string").alias("doc_id"),
                        F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    every = cut_lineage(spans(keyed, span), "span-all")     # numbers, ids and spans from one pass
    names = every.where("place < 0").select("row", F.col("doc_id").cast(kind).alias("doc_id"), "th")
    every = every.where("place >= 0").select("h", "row", "place")
    twice = cut_lineage(every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "span-hashes")
    # merged, so that what is moved grows in proportion
    shared = cut_lineage(every.join(twice.hint("merge"), "h").join(names.hint("merge"), "row")
                         .select("h", "doc_id", "th", "place"), "span-shared")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "place")
    first = shared.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = cut_lineage(first.where(~F.col("first").eqNullSafe(F.col("last"))).select("h", "first"), "span-first")
    later = shared.join(first, "h").where(~place.eqNullSafe(F.col("first")))
    later = later.groupBy("doc_id", "th").agg(F.collect_set("place").alias("places"), F.sort_array(F.collect_set("first.doc_id")).alias("first_docs"))
    return cut_lineage(later.select("doc_id", "th", joined(F.col("places")).alias("ranges"), "first_docs"), "span-later")


def joined(places):
    """The ranges that the places of spans make together, in the same form, sorted."""

    @pandas_udf("array<long>")
    def run(batch: pd.Series) -> pd.Series:
        out = []
        for own in batch:
            own = np.sort(np.asarray(own, np.int64))
            begin, stop = own >> 32, np.maximum.accumulate(own & 0xFFFFFFFF)
            apart = np.concatenate([[True], begin[1:] > stop[:-1]])
            out.append(begin[apart] << 32 | stop[np.append(np.flatnonzero(apart)[1:] - 1, len(own) - 1)])
        return pd.Series(out, dtype=object)

    return run(places)


def without(text, ranges):
    """struct(text, n_removed): a text column without ranges of its characters, and how many characters went."""

    @pandas_udf("text string, n_removed int")
    def run(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        out = []
        for t, own in zip(texts, places):
            if t is None or own is None:
                out.append((t, 0))
                continue
            kept, at = [], 0
            for r in own.tolist():
                kept.append(t[at:r >> 32])
                at = r & 0xFFFFFFFF
            left = "".join([*kept, t[at:]]).rstrip()
            out.append((left, len(t) - len(left)))
        return pd.DataFrame(out, columns=["text", "n_removed"])

    return run(text, ranges)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, only_changed: bool = False,
                   report: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` with repeated sentences gone from the
    text. ``only_changed``: rows in which something was removed. ``report``:
    with n_removed (characters) and first_doc_ids, the documents that keep what was removed."""
    found = repeats(docs, id_col, text_col, span)
    names = {n: fresh(docs, f"span_{n}") for n in ("doc_id", "th", "ranges", "first_docs", "new")}
    found = found.select(*[F.col(n).alias(names[n]) for n in ("doc_id", "th", "ranges", "first_docs")])
    same = docs[id_col].eqNullSafe(found[names["doc_id"]]) & (F.xxhash64(docs[text_col]) == found[names["th"]])
    # merged at every size, so that what texts cost to move grows in proportion
    joined = docs.join(found.hint("merge"), same, "inner" if only_changed else "left")
    joined = joined.withColumn(names["new"], without(F.col(text_col), F.col(names["ranges"])))
    columns = [F.col(f"{names['new']}.text").alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if report:
        columns += [F.col(f"{names['new']}.n_removed").alias("n_removed"), F.col(names["first_docs"]).alias("first_doc_ids")]
    return joined.select(*columns)
