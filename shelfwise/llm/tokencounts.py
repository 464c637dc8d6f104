"""Token counts of documents in flat token files, by scanning for separators.

A token file is a row of fixed-width ids without an index, in which every
document is followed by an end-of-document id. Files are held as rows of
blocks, (shard, block, ids), that don't respect documents. Each block is
searched for the end id by itself, with a vectorised comparison; a prefix scan
over the blocks of a shard then adds up the ends before each block and the
tokens that an unfinished document brings in from earlier ones, which stitches
documents that blocks cut.

Null and empty blocks hold nothing. Tokens after a shard's last end id belong to
a document that wasn't finished; it's reported with finished = false.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm import bpe
from shelfwise.session import cut_lineage

BLOCK_TOKENS = 65_536


def width_of(largest_id: int) -> str:
    return "<u2" if largest_id < 1 << 16 else "<u4"


def scan_blocks(blocks: DataFrame, end_id: int, dtype: str = "<u2") -> DataFrame:
    """Per block: its tokens before the first end (``lead``), after the last
    (``tail``), its ends, and the counts of the documents wholly within it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for shard, block, data in zip(batch["shard"], batch["block"], batch["ids"]):
                ids = np.frombuffer(data or b"", dtype)
                ends = np.flatnonzero(ids == end_id)
                if len(ends):
                    rows.append((shard, block, len(ends), int(ends[0]), int(len(ids) - ends[-1] - 1), (np.diff(ends) - 1).tolist()))
                else:
                    rows.append((shard, block, 0, len(ids), 0, []))
            yield pd.DataFrame(rows, columns=["shard", "block", "ends", "lead", "tail", "inner"])

    return blocks.select("shard", "block", "ids").mapInPandas(
        run, "shard string, block long, ends long, lead long, tail long, inner array<long>")


def count_documents(blocks: DataFrame, end_id: int, dtype: str = "<u2") -> DataFrame:
    """(shard, position, n_tokens, finished) of each document of the files."""
    found = scan_blocks(blocks, end_id, dtype)
    order = Window.partitionBy("shard").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("done", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    # blocks up to the next that has an end share an unfinished document
    run = found.withColumn("open", F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("lead"))).withColumn(
        "run", F.coalesce(F.sum((F.col("ends") > 0).cast("long")).over(before), F.lit(0)))
    same = Window.partitionBy("shard", "run2").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # what a block opens counts for the blocks after it, from the run that it begins
    opened = run.withColumn("run2", F.col("run") + (F.col("ends") > 0).cast("long"))
    carried = opened.withColumn("sum", F.coalesce(F.sum("open").over(same), F.lit(0)) + F.col("open"))
    carry = F.coalesce(F.lag("sum").over(order), F.lit(0))
    carried = carried.withColumn("carry", carry)
    counts = F.concat(F.array(F.col("carry") + F.col("lead")), F.col("inner"))
    whole = (carried.where("ends > 0").select("shard", "done", F.posexplode(counts).alias("i", "n_tokens"))
             .select("shard", (F.col("done") + F.col("i")).alias("position"), "n_tokens", F.lit(True).alias("finished")))
    last = carried.withColumn("next", F.lead("block").over(order)).where("next IS NULL AND sum > 0")
    return whole.unionByName(last.select("shard", (F.col("done") + F.col("ends")).alias("position"),
                                         F.col("sum").alias("n_tokens"), F.lit(False).alias("finished")))


def write_shards(docs: DataFrame, lexicon: bpe.Lexicon, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token files of ``docs``, one shard a partition, as a table in the shared
    folder: rows of blocks, and rows with the ids of the shard's documents in
    order (``docs``, from position ``block`` on)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec, shard = lexicon.codec(), f"{TaskContext.get().partitionId():06d}"
        dtype = width_of(end_id)
        held: list[np.ndarray] = []
        size = block = position = 0
        for batch in batches:
            blocks = []
            for ids in codec.encode([t or b"" for t in batch["text"]]):
                held += [ids.astype(dtype), np.array([end_id], dtype)]
                size += len(ids) + 1
                if size >= block_tokens:
                    flat = np.concatenate(held)
                    full = size // block_tokens * block_tokens
                    for a in range(0, full, block_tokens):
                        blocks.append((shard, block, flat[a:a + block_tokens].tobytes(), None))
                        block += 1
                    held, size = [flat[full:]], size - full
            blocks.append((shard, position, None, batch["id"].tolist()))
            position += len(batch)
            yield pd.DataFrame(blocks, columns=["shard", "block", "ids", "docs"])
        if size:
            yield pd.DataFrame([(shard, block, np.concatenate(held).tobytes(), None)], columns=["shard", "block", "ids", "docs"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return cut_lineage(rows.mapInPandas(run, "shard string, block long, ids binary, docs array<string>"), "token-shards")


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, shard, position, n_tokens; a null or empty text has none.

    The documents are written as token files and counted by scanning those.
    """
    lexicon = bpe.learn_lexicon(docs, tokenizer, text_col)
    end_id = len(lexicon.vocabulary["tokens"])     # a free id: no text encodes to it
    shards = write_shards(docs, lexicon, end_id, id_col, text_col)
    counts = count_documents(shards.where("ids IS NOT NULL"), end_id, width_of(end_id))
    names = (shards.where("docs IS NOT NULL").select("shard", "block", F.posexplode("docs").alias("i", "doc_id"))
             .select("shard", (F.col("block") + F.col("i")).alias("position"), F.col("doc_id").cast(docs.schema[id_col].dataType)))
    return names.join(counts, ["shard", "position"]).select("doc_id", "shard", "position", "n_tokens")
