"""Top-1-per-key selection (snapshot dedup, latest row per entity).

Expressed as ``row_number() OVER (PARTITION BY keys ORDER BY ...) = 1`` so
Catalyst plans a ``WindowGroupLimit`` *before* the shuffle: every map task
keeps only its best row per key, so a hot key holding a third of all rows
ships one row per map task, not a third of the table to one reducer.

The ordering always ends with a deterministic tie-break over the remaining
columns (ascending, NULLs first): the source models order by a column that
is constant inside the partition, which would leave the winner arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage
from shelfwise.sources.warehouse import clustered, with_partition

RN = "__rn"
#: So many hashes of repeated keys (8 bytes each) are sent to all tasks at most; with more, all rows are shuffled.
MOST_REPEATED = 4_000_000


def order_spec(primary: Sequence[Column] = (), tie_break: Sequence[str] = ()) -> list[Column]:
    return list(primary) + [F.col(c).asc_nulls_first() for c in tie_break]


def top1_per_key(df: DataFrame, keys: Sequence[str], primary: Sequence[Column] = (),
                 tie_break: Sequence[str] | None = None, cluster: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the first by ``primary`` then ``tie_break``.

    ``tie_break=None`` means every non-key column, in schema order, which
    makes the chosen row fully deterministic (rows equal on all columns are
    interchangeable).

    ``cluster`` names some of the keys, for input that has about one row per
    key: rows are shuffled by these once, without the sort that looks for
    duplicates before it, and a later selection by the same columns or more
    finds them in place.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys]
    if cluster is not None:
        df = df.repartition(*cluster)
    w = Window.partitionBy(*keys).orderBy(*order_spec(primary, tie_break))
    return df.withColumn(RN, F.row_number().over(w)).filter(F.col(RN) == 1).drop(RN)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes (``key_hash``) of the keys that more than one row may have: all keys that repeat, and those few whose hash
    is another key's. Only hashes are shuffled."""
    return df.groupBy(F.xxhash64(*keys).alias("key_hash")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key_hash")


def top1_in_place(df: DataFrame, keys: Sequence[str], primary: Sequence[Column] = (),
                  tie_break: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``top1_per_key``, for input in date folders in which few keys repeat (runs a job that finds these
    first). Rows whose key comes once stay in the task that reads them; only rows of
    repeated keys are shuffled and, of these, the chosen ones brought together by date. So the result can be
    written to date folders as it is, however wide the rows are. Input with more than ``MOST_REPEATED`` such keys is
    shuffled as a whole."""
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys]
    by_date = lambda rows: clustered(with_partition(rows)).select(*df.columns)
    repeated = cut_lineage(repeated_keys(df, keys), "repeated")
    if repeated.count() > MOST_REPEATED:
        return by_date(top1_per_key(df, keys, primary, tie_break))
    has_it = F.xxhash64(*keys) == F.col("key_hash")
    once, some = (df.join(F.broadcast(repeated), has_it, how) for how in ("left_anti", "left_semi"))
    return once.unionByName(by_date(top1_per_key(some, keys, primary, tie_break)))
