"""Helpers of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hashed_below(share: Column, *key: str) -> Column:
    """Whether a 64-bit hash of ``key`` lies in the lowest ``share`` of its range, however small a share."""
    return F.xxhash64(*key).cast("double") + F.lit(2.0 ** 63) <= share * F.lit(2.0 ** 64)


def bounded_sample(rows: DataFrame, bound: int, *key: str) -> DataFrame:
    """The first ``bound`` distinct rows of ``rows`` in the order of a hash of
    ``key``, then of all columns: the same rows however ``rows`` is partitioned
    and however often one of them is repeated."""
    order = [F.xxhash64(*key), *key, *(c for c in rows.columns if c not in key)]
    return rows.distinct().orderBy(*order).limit(bound)


def labelled_texts(docs: DataFrame, labels: DataFrame, bound: int, id_col: str, text_col: str, label_col: str, learnable: Column) -> DataFrame:
    """(id, label, text) of at most ``bound`` distinct labelled ids that
    ``learnable`` (a condition on ``id``) admits, with labels 0 and 1.

    Of several labels of an id each counts. Of several texts of an id the one
    of the smallest hash stands for it, so neither a repeated label nor a
    repeated document takes another's place or adds rows.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    chosen = bounded_sample(known.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & learnable), bound, "id")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most ``bound`` small rows are broadcast; texts are put together before they are moved
    return (texts.join(F.broadcast(chosen), "id").groupBy("id", "label")
            .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
