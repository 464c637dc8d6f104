"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and benchmark items are rows of words: letters and digits in lower case,
with their marks, cut at everything else. Chinese, Japanese, Thai, Lao, Khmer
and Burmese are written without spaces, so each of their characters is a word.
The CGK embedding walks over a row, writes the current word at every step and
moves on or stays by a random bit of the step and word; rows a few edits apart
fall into step again, so edit distance becomes Hamming distance. A repetition
has its own walk and samples ``SAMPLED`` steps of it; an item and the window of
its size that begins at some word of a document meet if the sampled words
agree. The number of repetitions follows from the target recall. Every meeting
is verified by the exact edit distance of the item to the windows from that
word on: at most ``MAX_EDITS`` of the item's words.

Items are grouped into classes of similar size, since a walk has to span the
windows. Before walking, windows are left out that no item of the class can be
within reach of, as too few of their words are words of its items; this loses
nothing. The benchmark is read in blocks of ``BLOCK_ITEMS`` items, each checked
against all documents, so no more than a block is ever sent to tasks.

With ``short_items`` items of fewer than ``LEAST_WORDS`` words are searched, too:
where all their words stand in a row or, with ``short_edits``, with the same share
of edits as others, one from five words on (the query and the pipeline have both).
For these, pieces that stand word by word replace the walk, which loses
nothing. Without ``short_items`` they count as ordinary phrases and are not
searched. Items without a word (null and empty ones too) never are. Null and
empty documents hold no item. Repeated rows of documents each get results; items
of equal words are searched once and all their ids found. An item without an id
is searched, too, when documents are dropped; it has no row in the report, which
names items by their ids. Ids are integers or text. Texts and items of any length
are read whole, in memory that grows with the longest; other columns stay as
they are, whatever their names.
"""

from __future__ import annotations

import pickle
import unicodedata
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from shelfwise.llm.common import fresh, powers

MAX_EDITS = 0.2             # of an item's words
TARGET_RECALL = 0.95        # for an item at the largest number of edits
SAMPLED = 4
STEP_AGREES = 0.6           # least share of steps that agree at the largest number of edits, as measured
LEAST_WORDS = 8
CLASS_RATIO = 1.3
BLOCK_ITEMS = 5000
BYTES_AT_ONCE = 4_000_000
PLACES_AT_ONCE = 1 << 18
PAIRS_AT_ONCE = 1 << 20
CELLS_AT_ONCE = 1 << 18     # of the table of distances
SEED = 20


def repetitions(recall: float = TARGET_RECALL, sampled: int = SAMPLED, agrees: float = STEP_AGREES) -> int:
    return ceil(log(1 - recall) / log(1 - agrees ** sampled))


#: Scripts without spaces between words: each character is a word.
NO_SPACES = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x30FF),
             (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF),
             (0xFF66, 0xFF9D), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF))


def character_table() -> np.ndarray:
    """By code point: 0 for what cuts words, 1 for letters, digits and marks, 2 for a character that is a word."""
    kinds = [unicodedata.category(chr(c)) for c in range(0x110000)]
    out = np.fromiter((k[0] in "LNM" for k in kinds), np.int8, 0x110000)
    out[0x200C:0x200E] = 1                                 # joiners inside words
    for a, b in NO_SPACES:
        out[a:b + 1] *= 2
    return out


def words_of(texts: list[str | None], table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in a row, and where each text's begin (one more at the end).
    ``table``: the character table, where the caller has it."""
    data = [(t or "").lower() + " " for t in texts]
    buf = np.frombuffer("".join(data).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = (character_table() if table is None else table)[buf]
    good = kind > 0
    before = np.concatenate([[0], kind[:-1]]) if len(kind) else kind
    first = good & ((before == 0) | (kind == 2) | (before == 2))
    begin = np.flatnonzero(first)
    stop = np.concatenate([~good | first, [True]])
    ends = np.flatnonzero(stop)
    end = ends[np.searchsorted(ends, begin, "right")] if len(begin) else begin
    up, down = powers(len(buf))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:len(buf)], out=sums[1:])
    h = (sums[end] - sums[begin]) * down[begin]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) | np.uint64(1)          # never 0, which stands for the end of a text
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    return h, np.searchsorted(begin, bounds)


class SizeClass:
    """Items of similar size, with their repetitions' walks, samples and keys."""

    limit = None                # of edits: the share of each item's words

    def __init__(self, items: list[np.ndarray], ids: list[list], seed: int, reps: int):
        self.items, self.ids = items, ids
        size = np.array([len(x) for x in items])
        edits = np.floor(size * MAX_EDITS).astype(int)
        self.least = int((size - edits).min())             # words of the window that decide about leaving it out
        self.common = self.least - int(edits.max())
        self.vocabulary = np.unique(np.concatenate(items))
        self.marks = bitmap(self.vocabulary)
        rnd = np.random.default_rng(seed)
        steps = 2 * self.least
        flat = np.concatenate([*items, np.zeros(1, np.uint64)])
        begin = np.cumsum(size) - size
        self.reps = []
        for _ in range(reps):
            odd = rnd.integers(0, 1 << 63, steps, np.uint64) * np.uint64(2) + np.uint64(1)
            sampled = np.sort(rnd.choice(steps, SAMPLED, replace=False))
            key, marks = np.zeros(len(items), np.uint64), []
            for symbols in walk(flat, begin.copy(), begin + size, odd, sampled):
                marks.append(bitmap(symbols[1]))
                key = fold(key, symbols[1])
            by = np.argsort(key, kind="stable")
            self.reps.append((odd, sampled, marks, key[by], by))


def bitmap(symbols: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 16, bool)
    out[(symbols >> np.uint64(48)).astype(np.int64)] = True
    return out


def fold(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return (key ^ symbol) * np.uint64(0x94D049BB133111EB) + np.uint64(0x5BD1E995)


def walk(flat: np.ndarray, at: np.ndarray, end: np.ndarray, odd: np.ndarray, sampled: np.ndarray):
    """The CGK walk from each place of ``flat`` up to its ``end``; yields the
    walkers' numbers and words at the sampled steps. A caller may send back
    which walkers go on. ``flat`` ends with a 0."""
    who, step = np.arange(len(at)), 0
    last = len(flat) - 1
    for goal in sampled.tolist():
        while True:
            symbol = flat[np.where(at < end, at, last)]
            if step == goal:
                keep = yield who, symbol
                if keep is not None:
                    who, at, end, symbol = who[keep], at[keep], end[keep], symbol[keep]
                    yield None
            at = at + ((symbol * odd[step]) >> np.uint64(63)).astype(np.int64)
            step += 1
            if step > goal:
                break


class ShortItems:
    """Items of ``size`` words, too few for a walk. An item is cut into one
    piece more than it may have edits, so that one of them stands word by word
    wherever the item does; places of that piece are verified."""

    def __init__(self, size: int, items: list[np.ndarray], ids: list[list], edits: bool):
        self.items, self.ids, self.limit = items, ids, int(size * MAX_EDITS) if edits else 0
        words = np.array(items, np.uint64)
        self.pieces = []
        for k in range(self.limit + 1):
            a, b = k * size // (self.limit + 1), (k + 1) * size // (self.limit + 1)
            key = self.keys(words[:, a:b].ravel(), b - a)[::b - a]
            by = np.argsort(key, kind="stable")
            self.pieces.append((a, b - a, key[by], by, bitmap(key)))

    @staticmethod
    def keys(flat: np.ndarray, size: int) -> np.ndarray:
        """Of the words from each place on."""
        n = len(flat) - size + 1
        key = np.zeros(max(0, n), np.uint64)
        for k in range(size if n > 0 else 0):
            key = fold(key, flat[k:k + n])
            key = key ^ (key >> np.uint64(32))
        return key

    def meetings(self, flat: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and items to verify, a bounded number at a time; places lie in texts from ``begin`` to ``stop``."""
        for a, size, keys, by, marks in self.pieces:
            key = self.keys(flat[:len(stop)], size)
            place = np.flatnonzero(marks[(key >> np.uint64(48)).astype(np.int64)])
            place = place[place + size <= stop[place]]
            low, high = np.searchsorted(keys, key[place], "left"), np.searchsorted(keys, key[place], "right")
            place, low, n = place[high > low], low[high > low], (high - low)[high > low]
            for lo, hi in portions(n):
                many = n[lo:hi]
                item = by[np.repeat(low[lo:hi] - np.cumsum(many) + many, many) + np.arange(many.sum())]
                at = np.repeat(place[lo:hi], many)
                for shift in range(-self.limit, self.limit + 1) if a else (0,):
                    first = at - a + shift
                    keep = (first >= begin[at]) & (first < stop[at])
                    yield first[keep], item[keep]


def portions(n: np.ndarray, most: int = PAIRS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Bounds of rows one after the other whose numbers ``n`` add up to ``most`` or less, or of one row."""
    total, lo = np.cumsum(n), 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


class Index:
    """A block of items, ready to be searched in documents."""

    def __init__(self, items: list[tuple[int | str, str | None]], reps: int | None = None, short_items: bool = False,
                 short_edits: bool = False):
        self.table = character_table()
        hashes, begin = words_of([t for _, t in items], self.table)
        ids: dict[bytes, list] = {}                        # items of the same words are one
        for (i, _), a, b in zip(items, begin, begin[1:]):
            if b - a >= (1 if short_items else LEAST_WORDS):
                ids.setdefault(hashes[a:b].tobytes(), []).append(i)
        rows = sorted(((np.frombuffer(w, np.uint64), own) for w, own in ids.items()), key=lambda r: (len(r[0]), r[1]))
        self.classes: list[ShortItems | SizeClass] = []
        while rows:
            least = len(rows[0][0])
            most = least if least < LEAST_WORDS else CLASS_RATIO * least
            n = next((k for k, r in enumerate(rows) if len(r[0]) > most), len(rows))
            (words, own), rows = zip(*rows[:n]), rows[n:]
            if least < LEAST_WORDS:
                self.classes.append(ShortItems(least, list(words), list(own), short_edits))
            else:
                number = sum(isinstance(c, SizeClass) for c in self.classes)
                self.classes.append(SizeClass(list(words), list(own), SEED + number, reps or repetitions()))

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(number of the text, item id, first word, edits) of each item in each text, its nearest and then first window."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        group, size, base = [], 0, 0
        for k, text in enumerate(texts, 1):
            group.append(text)
            size += len(text or "")
            if size >= BYTES_AT_ONCE or k == len(texts):
                for doc, item, place, edits in self.find_in(group):
                    key = (base + doc, item)
                    best[key] = min(best.get(key, (edits, place)), (edits, place))
                group, size, base = [], 0, k
        return sorted((doc, item, place, edits) for (doc, item), (edits, place) in best.items())

    def find_in(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        hashes, begin = words_of(texts, self.table)
        flat = np.append(hashes, np.uint64(0))
        doc = np.repeat(np.arange(len(texts)), np.diff(begin))
        stop = begin[1:][doc] if len(doc) else np.zeros(0, np.int64)
        start = begin[:-1][doc] if len(doc) else stop
        for own in self.classes:
            if isinstance(own, ShortItems):
                meetings = own.meetings(hashes, start, stop)
            else:
                meetings = self.meetings(own, flat, hashes, stop)
            for place, item in meetings:
                for p, i, edits in verified(own.items, flat, stop, place, item, own.limit):
                    for name in own.ids[i]:
                        yield int(doc[p]), name, int(p - begin[doc[p]]), edits

    def meetings(self, own: SizeClass, flat: np.ndarray, hashes: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and items of a class that meet in any repetition, for a bounded number of places at a time."""
        inside = own.marks[(hashes >> np.uint64(48)).astype(np.int64)]
        look = np.flatnonzero(inside)                      # the bitmap lets a few more through
        inside[look] = own.vocabulary[np.minimum(np.searchsorted(own.vocabulary, hashes[look]), len(own.vocabulary) - 1)] == hashes[look]
        total = np.concatenate([[0], np.cumsum(inside)])
        place = np.arange(len(hashes))
        enough = place + own.least <= stop
        enough[enough] = (total[place[enough] + own.least] - total[place[enough]]) >= own.common
        every = np.flatnonzero(enough)
        for first in range(0, len(every), PLACES_AT_ONCE):
            place = every[first:first + PLACES_AT_ONCE]
            met = []
            for odd, sampled, marks, keys, by in own.reps:
                who, key = self.meet(flat, place, stop[place], odd, sampled, marks)
                low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                who, low, n = who[high > low], low[high > low], (high - low)[high > low]
                for lo, hi in portions(n):
                    many = n[lo:hi]
                    item = by[np.repeat(low[lo:hi] - np.cumsum(many) + many, many) + np.arange(many.sum())]
                    met.append(np.repeat(place[who[lo:hi]], many) * len(own.items) + item)
                    if sum(map(len, met)) > PAIRS_AT_ONCE:
                        met = [np.unique(np.concatenate(met))]
                        if len(met[0]) > PAIRS_AT_ONCE // 2:
                            yield met[0] // len(own.items), met[0] % len(own.items)
                            met = []
            if met:
                pairs = np.unique(np.concatenate(met))
                yield pairs // len(own.items), pairs % len(own.items)

    @staticmethod
    def meet(flat, place, stop, odd, sampled, marks) -> tuple[np.ndarray, np.ndarray]:
        """The windows whose sampled words may be an item's, and their keys."""
        key, steps = np.zeros(len(place), np.uint64), walk(flat, place, stop, odd, sampled)
        who = np.arange(len(place))
        for mark, (who, symbol) in zip(marks, steps):
            keep = mark[(symbol >> np.uint64(48)).astype(np.int64)]
            key = fold(key[keep], symbol[keep])
            who = who[keep]
            steps.send(keep)
        return who, key


def verified(items: list[np.ndarray], flat: np.ndarray, stop: np.ndarray, place: np.ndarray, item: np.ndarray,
             most: int | None) -> Iterator[tuple[int, int, int]]:
    """(place, item, edits) of the pairs that are within ``most`` edits, or the item's."""
    by = np.argsort(item, kind="stable")
    place, item = place[by], item[by]
    bounds = np.append(np.flatnonzero(np.diff(item, prepend=-1)), len(item))
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        i = int(item[a])
        words = items[i]
        limit = int(len(words) * MAX_EDITS) if most is None else most
        rows = max(1, CELLS_AT_ONCE // (len(words) + limit))
        for lo in range(a, b, rows):
            part = place[lo:min(b, lo + rows)]
            edits = edit_distance(words, flat, part, stop[part], limit)
            for p, e in zip(part[edits <= limit].tolist(), edits[edits <= limit].tolist()):
                yield p, i, e


def edit_distance(words: np.ndarray, flat: np.ndarray, place: np.ndarray, stop: np.ndarray, limit: int) -> np.ndarray:
    """The least edit distance of ``words`` to a window that begins at each place."""
    width = len(words) + limit
    at = place[:, None] + np.arange(width)
    window = flat[np.where(at < stop[:, None], at, len(flat) - 1)]
    cols = np.arange(width + 1)
    row = np.tile(cols, (len(place), 1))
    for i, word in enumerate(words, 1):
        new = np.empty_like(row)
        new[:, 0] = i
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (window != word))
        row = np.minimum.accumulate(new - cols, axis=1) + cols
    return row.min(axis=1)


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block_items: int = BLOCK_ITEMS,
                short_items: bool = False, without_ids: bool = False, short_edits: bool = False) -> Iterator[Index]:
    """The benchmark's items, a bounded block at a time. ``without_ids``: then
    the texts that have no id in any row, under a number of their own."""
    items = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    parts = [items.where("i IS NOT NULL").distinct()]
    if without_ids:
        parts.append(items.groupBy("t").agg(F.max("i").alias("i")).where("i IS NULL").select(F.xxhash64("t").alias("i"), "t"))
    for part in parts:
        n = ceil(part.count() / block_items)
        for b in range(n):
            rows = part.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).collect()
            yield Index(sorted((r.i, r.t) for r in rows), short_items=short_items, short_edits=short_edits)


def contaminations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", block_items: int = BLOCK_ITEMS, short_items: bool = False,
                   short_edits: bool = False) -> DataFrame:
    """(doc_id, item_id, first_word, edits) for each document and item that it holds."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    item_kind = "string" if benchmark.schema[item_col].dataType == StringType() else "long"
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for index in item_blocks(benchmark, item_col, text_col="text", block_items=block_items, short_items=short_items, short_edits=short_edits):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(index))     # by value: workers need no copy of the class

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = pickle.loads(shared.value)
            for batch in batches:
                ids = batch["doc_id"].tolist()
                found = [(ids[d], i, p, e) for d, i, p, e in index.find(batch["text"].tolist())]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "first_word", "edits"])

        part = rows.mapInPandas(run, f"doc_id string, item_id {item_kind}, first_word int, edits int")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], f"doc_id string, item_id {item_kind}, first_word int, edits int")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def clean_column(text: str, index: Broadcast):
    """Whether a text holds none of the items of a block, which is broadcast as cloudpickle's bytes."""

    @pandas_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = pickle.loads(index.value)
        for batch in batches:
            held = {d for d, *_ in items.find(batch.tolist())}
            yield pd.Series([i not in held for i in range(len(batch))], dtype=bool)

    return run(F.col(text))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      block_items: int = BLOCK_ITEMS, short_items: bool = False,
                   short_edits: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item, with or without an id."""
    context = docs.sparkSession.sparkContext
    for index in item_blocks(benchmark, item_col, block_items=block_items, short_items=short_items, without_ids=True,
                             short_edits=short_edits):
        flag = fresh(docs, "is_clean")
        docs = docs.withColumn(flag, clean_column(text_col, context.broadcast(cloudpickle.dumps(index)))).where(flag).drop(flag)
    return docs
