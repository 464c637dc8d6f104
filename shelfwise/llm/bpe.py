"""Byte-level BPE encoding and decoding with a minimal acyclic transducer lexicon.

The text is cut into units where the byte-level splitting pattern is sure to
break (see ``unit_starts``), so units encode independently. Unit counts over all documents choose the frequent units; those, with the ids they
encode to, are compiled into a minimal acyclic automaton whose edges carry
output numbers that add up to the unit's row in an id table. The automaton is
written to the shared folder, given to executors with ``addFile`` and
memory-mapped by their workers, which run it over all units of a batch at once.
A unit that isn't in it is split by the pattern and merged exactly. What the
lexicon holds decides only the speed.

Null texts count as empty; an empty text has no ids. Every row yields a row.
"""

from __future__ import annotations

import heapq
import json
import uuid
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.session import cut_lineage, scratch_dir

#: Units that make up at least this share of all units are compiled, so at most its inverse many.
MIN_SHARE = 5e-7
LONGEST_UNIT = 64
BATCH_BYTES = 4_000_000
#: Fixed values of the byte-level splitting rule, with its white space spelt out.
SPACE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
           rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
EMPTY = np.uint32(0xFFFFFFFF)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
    return [other.get(b, chr(b)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """Plain tables of a byte-level BPE file: token bytes by id, merges, special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, letters = spec["model"], byte_characters()
    byte_of = {c: b for b, c in enumerate(letters)}
    vocab = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    tokens = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
    for token, i in vocab.items():
        tokens[i] = bytes(byte_of[c] for c in token)
    special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
    for content, i in special.items():
        tokens[i] = content
    order = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int32)
    by = np.argsort(order)
    return {"tokens": tokens, "special": special, "base": np.array([vocab[c] for c in letters], np.int32),
            "pairs": order[by], "rank": by.astype(np.int32), "made": made}


class Merger:
    """Exact merging of words: always the leftmost pair of the lowest rank."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, vocabulary: dict):
        self.__dict__.update(vocabulary)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank[at], self.NONE)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > LONGEST_UNIT:
                out[i] = self.merge_long(w)
            else:
                by_size.setdefault(len(w), []).append(i)
        for size, own in by_size.items():
            for at in range(0, len(own), 50_000):
                part = own[at:at + 50_000]
                rows = self.merge_equal(np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(-1, size))
                for i, ids in zip(part, rows):
                    out[i] = ids
        return out

    def merge_equal(self, data: np.ndarray) -> list[np.ndarray]:
        """Words of one length, as rows of bytes; one merge a word and round."""
        n, size = data.shape
        done = np.zeros((n, size), np.int32)
        ids, length = self.base[data], np.full(n, size)
        rank = self.ranks(ids[:, :-1], ids[:, 1:]) if size > 1 else np.zeros((n, 0), np.int32)
        live, cols = np.arange(n), np.arange(size)
        while rank.shape[1]:
            at = rank.argmin(axis=1)
            low = rank[np.arange(len(at)), at]
            go = low < self.NONE
            if not go.all():
                done[live[~go]] = ids[~go]
                live, ids, rank, at, low = live[go], ids[go], rank[go], at[go], low[go]
            if not len(live):
                break
            rows = np.arange(len(live))
            length[live] -= 1
            ids[rows, at] = self.made[low]
            shift = np.minimum(cols + (cols > at[:, None]), size - 1)
            ids = np.take_along_axis(ids, shift, axis=1)
            rank = np.take_along_axis(rank, np.minimum(shift[:, :-1], size - 2), axis=1)
            left = length[live]
            rank[cols[:-1] >= left[:, None] - 1] = self.NONE
            for near in (at - 1, at):
                ok = (near >= 0) & (near + 1 < left)
                r, c = rows[ok], near[ok]
                rank[r, c] = self.ranks(ids[r, c], ids[r, c + 1])
        done[live] = ids
        return [row[:k] for row, k in zip(done, length.tolist())]

    def merge_long(self, word: bytes) -> np.ndarray:
        ids = self.base[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(int(r), i) for i, r in enumerate(self.ranks(np.array(ids[:-1]), np.array(ids[1:]))) if r < self.NONE]
        heapq.heapify(queue)
        rank_of = lambda a, b: int(self.ranks(np.array([a]), np.array([b]))[0])
        known: dict[tuple[int, int], int] = {}
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i] if ids[i] is not None else n
            if j >= n:
                continue
            pair = (ids[i], ids[j])
            if pair not in known:
                known[pair] = rank_of(*pair)
            if known[pair] != r:
                continue
            ids[i], ids[j] = int(self.made[r]), None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    pair = (ids[a], ids[b])
                    if pair not in known:
                        known[pair] = rank_of(*pair)
                    if known[pair] < self.NONE:
                        heapq.heappush(queue, (known[pair], a))
        return np.array([x for x in ids if x is not None], np.int32)


def minimal_automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Edges and final marks of the smallest acyclic automaton of sorted, distinct words.

    Words come in order, so once a branch is left behind nothing is added to it
    and each of its states is replaced by an equal one met before, if any.
    State 0 is the start.
    """
    edges: list[dict[int, int]] = [{}]
    final, known, free = [False], {}, []
    path: list[tuple[int, int, int]] = []      # (parent, byte, child) of the newest word

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, byte, child = path.pop()
            same = known.setdefault((final[child], *edges[child].items()), child)
            if same != child:
                edges[parent][byte] = same
                edges[child], final[child] = {}, False
                free.append(child)

    last = b""
    for word in words:
        shared = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        settle(shared)
        state = path[-1][2] if path else 0
        for byte in word[shared:]:
            if free:
                child = free.pop()
            else:
                child = len(edges)
                edges.append({})
                final.append(False)
            edges[state][byte] = child
            path.append((state, byte, child))
            state = child
        final[state] = True
        last = word
    settle(0)
    return edges, final


def compile_lexicon(words: list[bytes]) -> np.ndarray:
    """A table (3 x slots, uint32) of hashed edges: key (state * 256 + byte),
    target * 2 + final, and output. The outputs on a word's path add up to its
    place among the sorted words."""
    edges, final = minimal_automaton(words)
    count: dict[int, int] = {}
    for root in range(len(edges)):             # words below each state, without recursion
        stack = [root]
        while stack:
            s = stack[-1]
            todo = [t for t in edges[s].values() if t not in count] if s not in count else []
            if todo:
                stack += todo
            else:
                count[s] = final[s] + sum(count[t] for t in edges[s].values())
                stack.pop()
    rows = []
    for s, own in enumerate(edges):
        passed = int(final[s])
        for byte in sorted(own):
            t = own[byte]
            rows.append((s << 8 | byte, t << 1 | final[t], passed))
            passed += count[t]
    slots = 1 << max(4, (2 * len(rows)).bit_length())
    table = np.zeros((3, slots), np.uint32)
    table[0] = EMPTY
    left = np.array(rows, np.uint32).reshape(-1, 3)
    at = home_slot(left[:, 0], slots)
    while len(left):
        open_ = np.flatnonzero(table[0, at] == EMPTY)
        _, first = np.unique(at[open_], return_index=True)
        put = open_[first]
        table[:, at[put]] = left[put].T
        keep = np.ones(len(left), bool)
        keep[put] = False
        left, at = left[keep], (at[keep] + 1) & (slots - 1)
    return table


def home_slot(key: np.ndarray, slots: int) -> np.ndarray:
    return ((key * np.uint32(2654435769)) >> np.uint32(32 - slots.bit_length() + 1)).astype(np.int64)


#: By byte: letters, other visible characters but digits, all visible characters of ASCII, and what a unit may
#: begin with after a space (bytes that may begin white space are left out).
LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
VISIBLE = np.array([0x21 <= b <= 0x7E for b in range(256)])
MARK = VISIBLE & ~LETTER & ~np.array([0x30 <= b <= 0x39 for b in range(256)])
OPENS = VISIBLE | np.array([b >= 0x80 and b not in (0xC2, 0xE1, 0xE2, 0xE3) for b in range(256)])


def unit_starts(buf: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where units begin in pieces of UTF-8 bytes laid end to end: at a piece's
    start, before a space that no white space follows, between a letter and a
    mark, and around a line break that stands alone between visible characters."""
    cut = np.zeros(len(buf) + 1, bool)
    now, then = buf[:-1], buf[1:]
    inner = np.ones(len(buf), bool)
    inner[first + size - 1] = False            # what follows is another piece's
    inner = inner[:-1]
    cut[:-2] = (now == 0x20) & OPENS[then] & inner
    cut[1:-1] |= LETTER[now] & MARK[then] & inner
    alone = np.flatnonzero(buf[1:-1] == 0x0A) + 1
    alone = alone[VISIBLE[buf[alone - 1]] & VISIBLE[buf[alone + 1]] & inner[alone - 1] & inner[alone]]
    cut[alone] = cut[alone + 1] = True
    cut[first] = True
    return np.flatnonzero(cut[:-1])


class Codec:
    """Encodes and decodes batches of UTF-8 texts. ``lexicon``: its table, the
    ids of all its units in a row, and where each unit's begin."""

    KEPT = 200_000

    def __init__(self, vocabulary: dict, lexicon: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
        self.tokens, self.special = vocabulary["tokens"], vocabulary["special"]
        self.merger = Merger(vocabulary)
        self.split = regex.compile(PATTERN).findall
        table, self.flat, self.begin = lexicon or (compile_lexicon([]), np.zeros(0, np.int32), np.zeros(1, np.int64))
        self.keys, self.targets, self.outputs = table
        self.stop = regex.compile(b" (?=[!-~])")
        self.named = regex.compile(b"(" + b"|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + b")") if self.special else None
        self.special_sizes = {len(s) for s in self.special}
        self.unseen: dict[bytes, np.ndarray] = {}

    def pieces(self, text: bytes) -> Iterator[bytes]:
        """The text between special tokens, and those; a long one in parts that end where a unit does."""
        for part in self.named.split(text) if self.named and any(s in text for s in self.special) else [text]:
            while len(part) > BATCH_BYTES and (m := self.stop.search(part, BATCH_BYTES)):
                yield part[:m.start()]
                part = part[m.start():]
            if part:
                yield part

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        own: list[bytes] = []
        ends: list[int] = []                   # for each text that ends in this group: pieces so far
        size, ready = 0, []                    # ready: ids of the current text from earlier groups

        def flush() -> Iterator[np.ndarray]:
            nonlocal own, ends, size, ready
            ids, counts = self.encode_pieces(own)
            at = np.concatenate([[0], np.cumsum(counts)])
            begin = 0
            for end in ends:
                got = ids[at[begin]:at[end]]
                yield np.concatenate([*ready, got]) if ready else got
                begin, ready = end, []
            if begin < len(own):
                ready.append(ids[at[begin]:])
            own, ends, size = [], [], 0

        for text in texts:
            for piece in self.pieces(text):
                own.append(piece)
                size += len(piece)
                if size >= BATCH_BYTES:
                    yield from flush()
            ends.append(len(own))
        yield from flush()

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many are each piece's."""
        if not pieces:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        data = b"".join(pieces)
        buf = np.frombuffer(data, np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        first = np.cumsum(size) - size
        start = unit_starts(buf, first, size)
        if named := [i for i, p in enumerate(pieces) if len(p) in self.special_sizes and p in self.special]:
            whole = np.zeros(len(buf) + 1, np.int8)
            np.add.at(whole, first[named] + 1, 1)
            np.add.at(whole, first[named] + size[named], -1)
            start = start[np.cumsum(whole)[start] == 0]
        length = np.diff(np.append(start, len(buf)))
        begin, count = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        row = self.look_up(buf, start, length)
        hit = row >= 0
        begin[hit] = self.begin[row[hit]]
        count[hit] = self.begin[row[hit] + 1] - begin[hit]
        miss = np.flatnonzero(~hit)
        units = [data[a:a + n] for a, n in zip(start[miss].tolist(), length[miss].tolist())]
        places = {u: i for i, u in enumerate(dict.fromkeys(units))}
        extra = self.encode_units(list(places))
        sizes = np.fromiter(map(len, extra), np.int64, len(extra))
        flat = np.concatenate([self.flat, *extra]) if extra else self.flat
        at = np.fromiter((places[u] for u in units), np.int64, len(units))
        begin[miss] = (len(self.flat) + np.cumsum(sizes) - sizes)[at] if len(at) else 0
        count[miss] = sizes[at] if len(at) else 0
        total = np.cumsum(count)
        ids = flat[np.repeat(begin - total + count, count) + np.arange(total[-1])]
        return ids, np.add.reduceat(count, np.searchsorted(start, first))

    def look_up(self, buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Each unit's row in the lexicon, -1 if it has none."""
        row = np.full(len(start), -1, np.int64)
        live = np.flatnonzero(length <= LONGEST_UNIT)
        state, out = np.zeros(len(live), np.uint32), np.zeros(len(live), np.uint32)
        at, left = start[live], length[live]
        slots = len(self.keys)
        for _ in range(LONGEST_UNIT):
            if not len(live):
                break
            key = state << np.uint32(8) | buf[at]
            slot = home_slot(key, slots)
            seen = self.keys[slot]
            again = np.flatnonzero((seen != key) & (seen != EMPTY))
            while len(again):
                slot[again] = (slot[again] + 1) & (slots - 1)
                seen[again] = self.keys[slot[again]]
                again = again[(seen[again] != key[again]) & (seen[again] != EMPTY)]
            ok = seen == key
            target = self.targets[slot]
            out = out + self.outputs[slot]
            ends = ok & (left == 1)
            found = ends & (target & np.uint32(1) == 1)
            row[live[found]] = out[found]
            go = ok & ~ends
            live, at, left, state, out = live[go], at[go] + 1, left[go] - 1, target[go] >> np.uint32(1), out[go]
        return row

    def encode_units(self, units: list[bytes]) -> list[np.ndarray]:
        if len(self.unseen) > self.KEPT:
            self.unseen.clear()
        todo = [u for u in units if u not in self.unseen]
        plain, other = [], []
        for u in todo:
            if u in self.special:
                self.unseen[u] = np.array([self.special[u]], np.int32)
            else:
                text = u.decode()
                (plain if text.isalpha() or text[0] == " " and text[1:].isalpha() else other).append(u)
        split = [[p.encode() for p in self.split(u.decode())] for u in other]
        words = list(dict.fromkeys([*plain, *(w for own in split for w in own)]))
        ids = dict(zip(words, self.merger.merge(words)))
        for u in plain:
            self.unseen[u] = ids[u]
        for u, own in zip(other, split):
            self.unseen[u] = np.concatenate([ids[w] for w in own])
        return [self.unseen[u] for u in units]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def rolling_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    base = 0x9E3779B97F4A7C15
    powers = [np.full(n + 1, x, np.uint64) for x in (base, pow(base, -1, 1 << 64))]
    for p in powers:
        p[0] = 1
        np.multiply.accumulate(p, out=p)
    return powers[0], powers[1]


def unit_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(unit binary, n) over all documents, of units short enough to be compiled.

    Units are told apart in a batch by a 64-bit hash of their bytes; should two
    meet, the counts of one are added to the other's, which changes no ids.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        up, down = rolling_powers(BATCH_BYTES)
        for batch in batches:
            group, held = [], 0
            for k, text in enumerate(batch["t"], 1):
                if text:
                    group.append(text)
                    held += len(text)
                if group and (held >= BATCH_BYTES or k == len(batch)):
                    if held >= len(up):
                        up, down = rolling_powers(held)
                    count(group, up, down, seen)
                    group, held = [], 0
                if len(seen) > 400_000:
                    yield table(seen)
                    seen.clear()
        yield table(seen)

    def count(texts: list[bytes], up: np.ndarray, down: np.ndarray, seen: Counter) -> None:
        data, size = b"".join(texts), np.fromiter(map(len, texts), np.int64, len(texts))
        buf = np.frombuffer(data, np.uint8)
        start = unit_starts(buf, np.cumsum(size) - size, size)
        end = np.append(start[1:], len(buf))
        short = end - start <= LONGEST_UNIT
        start, end = start[short], end[short]
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:len(buf)], out=sums[1:])
        _, at, n = np.unique((sums[end] - sums[start]) * down[start], return_index=True, return_counts=True)
        for a, b, k in zip(start[at].tolist(), end[at].tolist(), n.tolist()):
            seen[data[a:b]] += k

    def table(seen: Counter) -> pd.DataFrame:
        return pd.DataFrame({"unit": list(seen.keys()), "n": list(seen.values())}).astype({"n": "int64"})

    parts = docs.select(F.col(text_col).cast("binary").alias("t")).mapInPandas(run, "unit binary, n long")
    return parts.groupBy("unit").agg(F.sum("n").alias("n"))


class Lexicon:
    """What tasks need to encode: the vocabulary's tables, the ids of the
    compiled units, and the name of the automaton's file."""

    def __init__(self, vocabulary: dict, flat: np.ndarray, begin: np.ndarray, name: str):
        self.vocabulary, self.flat, self.begin, self.name = vocabulary, flat, begin, name

    def codec(self) -> Codec:
        table = np.memmap(SparkFiles.get(self.name), np.uint32, "r").reshape(3, -1)
        return Codec(self.vocabulary, (table, self.flat, self.begin))


def valid(unit: bytes) -> bool:
    try:
        unit.decode()
    except UnicodeDecodeError:
        return False
    return True


def build_lexicon(spark: SparkSession, vocabulary: dict, units: list[bytes]) -> Lexicon:
    """Compiles units and gives the automaton to the executors."""
    codec = Codec(vocabulary)
    words = sorted({u for u in units if 0 < len(u) <= LONGEST_UNIT and not any(s in u for s in codec.special) and valid(u)})
    ids = codec.encode_units(words)
    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    begin = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    path = f"{scratch_dir(spark, 'lexicon')}-{uuid.uuid4().hex[:8]}.bin"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop)
    stream.write(compile_lexicon(words).tobytes())
    stream.close()
    spark.sparkContext.addFile(path)
    return Lexicon(vocabulary, flat, begin, path.rsplit("/", 1)[1])


def learn_lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", min_share: float = MIN_SHARE) -> Lexicon:
    """Compiles the units that make up ``min_share`` of all units of ``docs`` or more."""
    counts = cut_lineage(unit_counts(docs, text_col), "bpe-units")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") >= max(1.0, total * min_share)).select("unit").collect() if total else []
    return build_lexicon(docs.sparkSession, load_vocabulary(tokenizer), [bytes(r.unit) for r in rows])


def ids_column(text: str, lexicon: Lexicon):
    """The ids of a text column, as array<int>."""

    @pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = lexicon.codec()
        for batch in batches:
            yield pd.Series(list(codec.encode([t or b"" for t in batch])), dtype=object)

    return run(F.col(text).cast("binary"))


def digest_column(text: str, lexicon: Lexicon):
    """struct(n_tokens, ids_sha256, decoded_sha256) of a text column encoded and decoded again."""

    @pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = lexicon.codec()
        for batch in batches:
            rows = [(len(ids), sha256(ids.astype("<u4").tobytes()).hexdigest(),
                     sha256(codec.decode(ids).encode()).hexdigest())
                    for ids in codec.encode([t or b"" for t in batch])]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(F.col(text).cast("binary"))


def decode_column(ids: str, lexicon: Lexicon):
    """The text of an array<int> column of ids; null stays null."""

    @pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = lexicon.codec()
        for batch in batches:
            yield pd.Series([None if x is None else codec.decode(np.asarray(x)) for x in batch], dtype=object)

    return run(F.col(ids))


def encode_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    lexicon = learn_lexicon(docs, tokenizer, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), digest_column(text_col, lexicon).alias("d")).select("doc_id", "d.*")
