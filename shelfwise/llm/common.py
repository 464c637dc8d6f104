"""Helpers shared by the corpus operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{table}.parquet")
    return df.select(*columns) if columns else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; -1 for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus, F.lit(-1)).cast("int")


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse modulo 2^64: with
    sums of values times powers, a run of values hashes alike wherever it stands."""
    base = 0x9E3779B97F4A7C15
    out = [np.full(n + 1, x, np.uint64) for x in (base, pow(base, -1, 1 << 64))]
    for p in out:
        p[0] = 1
        np.multiply.accumulate(p, out=p)
    return out[0], out[1]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as edges (u, v) of comparable keys.

    Returns (node, root) for every node that has an edge to another node; root
    is the smallest node of its component. Alternates large-star and small-star
    steps until the edge set no longer changes. Each step's edges and minima
    are written to the shared folder, which cuts lineage and leaves both sides
    of the join as plain exchanges that adaptive execution can split when one
    node has very many neighbours. Null ends and self loops are ignored.
    """
    e = cut_lineage(edges.select("u", "v").where("u <> v").distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")), "cc-min").select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(large.where("u <> v").distinct(), "cc")
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = cut_lineage(down.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        small = (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        e = cut_lineage(small.where("u <> v").distinct(), "cc")
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (row.n, row.h) == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))\
                .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        state = (row.n, row.h)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
