"""SimHash near-duplicates: 64-bit fingerprints linked at a small Hamming distance.

Words are the runs of bytes other than ASCII white space, after lower-casing
A-Z. Every ``shingle`` consecutive words (joined by a space, repeats counted)
are hashed with XXH64, seed 42; a fingerprint bit is 1 if it is set in over
half of the hashes. A text with fewer words has one shingle, the whole
sequence; a text without words (empty, null) has fingerprint zero, which links
like any other.

Linking uses pigeonhole blocks. The 64 bits are split into ``2 * max_bits``
blocks; fingerprints at most ``max_bits`` bits apart agree on at least
``max_bits`` whole blocks, so every choice of ``max_bits`` blocks is one table
whose join key is the chosen bits. Fingerprints are made distinct first, so
copies cost nothing. In a key's bucket all distances are verified, but instead
of pairs only a spanning star of each linked set is emitted; buckets beyond
``CHUNK`` fingerprints are dealt into chunks and every pair of chunks becomes
one bounded unit of work. No bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.llm.common import connected_components, fresh
from shelfwise.session import cut_lineage

SEED = 42
SHINGLE = 3
MAX_BITS = 3
CHUNK = 1024
WORDS_AT_ONCE = 400_000


def _lane_table() -> np.ndarray:
    """For each byte value, its eight bits spread over the eight bytes of a uint64."""
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return np.ascontiguousarray(bits.astype(np.uint8)).view(np.uint64).ravel()


def shingle_hashes(data: bytes, width: int) -> list[int]:
    words = data.lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:len(words) - width].tolist()]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes; zero for an empty group.

    Bits are counted eight at a time: a table spreads a byte over the bytes of
    a uint64, and up to 255 of those are added before a byte could overflow.
    """
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    sizes = sizes[full]
    starts = np.cumsum(sizes) - sizes
    pieces = -(-sizes // 255)
    first = np.cumsum(pieces) - pieces
    cuts = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    lanes = _lane_table()
    prints = np.zeros(len(full), np.uint64)
    for byte in range(8):
        spread = lanes[(hashes >> np.uint64(8 * byte)) & np.uint64(255)]
        counts = np.add.reduceat(spread, cuts).view(np.uint8).reshape(-1, 8).astype(np.int64)
        over = 2 * np.add.reduceat(counts, first, axis=0) > sizes[:, None]
        for bit in range(8):
            prints |= over[:, bit].astype(np.uint64) << np.uint64(8 * byte + bit)
    out[full] = prints
    return out


def fingerprints(texts: list[bytes | None], width: int = SHINGLE) -> np.ndarray:
    """Unsigned fingerprints of UTF-8 texts."""
    parts, hashes, sizes = [], [], []
    for k, text in enumerate(texts, 1):
        own = shingle_hashes(text or b"", width)
        hashes += own
        sizes.append(len(own))
        if len(hashes) >= WORDS_AT_ONCE or k == len(texts):
            parts.append(majority_bits(np.array(hashes, np.uint64), np.array(sizes)))
            hashes, sizes = [], []
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def fingerprint_column(text: str, width: int = SHINGLE):
    """The fingerprint of a text column as a signed 64-bit column."""

    @pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(fingerprints(batch.tolist(), width).view(np.int64))

    return run(F.col(text).cast("binary"))


def block_masks(max_bits: int = MAX_BITS) -> list[int]:
    """One signed 64-bit mask for every choice of ``max_bits`` of ``2 * max_bits`` blocks."""
    if max_bits == 0:
        return [-1]
    parts = 2 * max_bits
    edges = [64 * i // parts for i in range(parts + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def spanning_stars(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(member, root) for each set of fingerprints linked within one bucket."""
    left, stars = np.unique(prints), []
    while len(left) > 1:
        root, reach, left = left[0], [left[0]], left[1:]
        while reach and len(left):
            near = np.bitwise_count(left ^ reach.pop()) <= max_bits
            if near.any():
                found = left[near]
                stars += [(int(x), int(root)) for x in found]
                reach += list(found)
                left = left[~near]
    return stars


def _bucket_edges(max_bits: int):
    """Streams rows sorted by (t, key, a, b) and links each run of equal keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, rest = ["t", "key", "a", "b"], None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            k = batch[keys].to_numpy()
            starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])
            rest = batch.iloc[starts[-1]:]
            yield linked(batch["fp"].to_numpy(), starts)
        if rest is not None:
            yield linked(rest["fp"].to_numpy(), np.array([0, len(rest)]))

    def linked(fp: np.ndarray, starts: np.ndarray) -> pd.DataFrame:
        """Edges within the runs that start at ``starts`` but for the last."""
        sizes, edges = np.diff(starts), []
        two = starts[:-1][sizes == 2]
        x, y = fp[two], fp[two + 1]
        ok = (np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits) & (x != y)
        u, v = [x[ok]], [y[ok]]
        for s, n in zip(starts[:-1][sizes > 2], sizes[sizes > 2]):
            edges += spanning_stars(fp[s:s + n].view(np.uint64), max_bits)
        if edges:
            more = np.array(edges, np.uint64).view(np.int64)
            u.append(more[:, 0])
            v.append(more[:, 1])
        return pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)})

    return run


def link(prints: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Components of distinct fingerprints (column ``fp``): (fp, root) for every
    fingerprint that links to another; the rest are alone."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for t, m in enumerate(block_masks(max_bits))])
    keyed = prints.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    sizes = cut_lineage(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets")
    shared = (keyed.join(sizes, ["t", "key"])
              .withColumn("s", F.ceil(F.col("n") / chunk).cast("int"))
              .withColumn("c", F.pmod(F.xxhash64("fp"), F.col("s")).cast("int"))
              .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
              .select("t", "key", F.least("c", "j").alias("a"), F.greatest("c", "j").alias("b"), "fp"))
    dealt = shared.repartition("t", "key", "a", "b").sortWithinPartitions("t", "key", "a", "b")
    edges = dealt.mapInPandas(_bucket_edges(max_bits), "u long, v long")
    return connected_components(edges).select(F.col("node").alias("fp"), "root")


def components(light: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """For rows (doc_id, fp): (fp, component_id), the smallest doc_id among all
    documents that fingerprint reaches. Null ids count only if nothing else is there."""
    classes = cut_lineage(light.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-classes")
    roots = cut_lineage(link(classes.select("fp"), max_bits), "simhash-roots")
    rooted = classes.join(roots, "fp", "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    least = cut_lineage(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "simhash-least")
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id.

    Every row is kept, repeated rows and null ids included; the id of a
    component is null only if all its ids are. Other input columns are ignored.
    """
    light = cut_lineage(docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(text_col, width).alias("fp")),
                        "simhash-light")
    groups = cut_lineage(components(light, max_bits), "simhash-groups")
    return light.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, with one row left of each component:
    that of the smallest id (null ids last; of rows with equal ids any one)."""
    fp, row = fresh(docs, "simhash_fp"), fresh(docs, "simhash_row")
    held = cut_lineage(docs.withColumn(fp, fingerprint_column(text_col, width))
                       .withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    light = held.select(F.col(id_col).alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    classes = cut_lineage(light.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")), "simhash-classes")
    roots = cut_lineage(link(classes.select("fp"), max_bits), "simhash-roots")
    kept = (classes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
            .agg(F.min("best").alias("best")).select(F.col("best.row").alias(row)))
    # merged at every size, so that what texts cost to move grows in proportion
    return held.join(cut_lineage(kept, "simhash-kept").hint("merge"), row, "left_semi").select(*docs.columns)
