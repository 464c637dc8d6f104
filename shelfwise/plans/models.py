"""The layer models as pure DataFrame functions.

    raw.products -> stg_products -> int_inventory_signals -> fct_inventory
                              \\-> dim_products, dim_suppliers, dim_dates

Each function is the full-refresh body of a model; ``plans.pipeline`` wraps
them with the incremental watermark and merge. Nothing here triggers a job,
unless a ``choose`` that does is given.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.dates import date_key_int, date_key_string, day_of_week_sunday_first
from shelfwise.functions.signals import add_signals
from shelfwise.operators.dedup import top1_per_key
from shelfwise.schemas import (DIM_DATES_COLUMNS, DIM_PRODUCTS_COLUMNS, DIM_SUPPLIERS_COLUMNS,
                               FCT_COLUMNS, FCT_KEY, INT_COLUMNS, INT_KEY, INT_SOURCE_COLUMNS,
                               RAW_COLUMNS, STG_RENAMES)

# Tie-break orders (after the model's own ORDER BY): every remaining output
# column, so the surviving row never depends on task scheduling.
# The signals follow from the source columns, so they decide no tie.
INT_TIE_BREAK = [c for c in INT_SOURCE_COLUMNS if c not in INT_KEY]
FCT_TIE_BREAK = [c for c in FCT_COLUMNS if c not in FCT_KEY and c != "date_key"]
DIM_PRODUCTS_TIE_BREAK = ["product_name", "product_category", "product_brand"]
DIM_SUPPLIERS_TIE_BREAK = ["supplier_contact", "lead_time_days"]


def stg_products(raw: DataFrame) -> DataFrame:
    """Rename projection, 29 columns; no dedup (in-batch duplicates survive
    and are reported by the uniqueness check)."""
    return raw.select(*[F.col(c).alias(STG_RENAMES.get(c, c)) for c in RAW_COLUMNS])


def inventory_signals(stg: DataFrame) -> DataFrame:
    """Signals on every staging row, before the snapshot dedup."""
    return add_signals(stg.select(*INT_SOURCE_COLUMNS)).select(*INT_COLUMNS)


def int_inventory_signals(stg: DataFrame, cluster: list[str] | None = FCT_KEY,
                          choose: Callable[..., DataFrame] | None = None) -> DataFrame:
    """One row per (product, warehouse region, ingestion time). Rows are chosen
    before the signals are added, so that these aren't shuffled, and brought together by the
    fact's key, so that its selection needs no shuffle of its own. ``cluster=None`` is for staging
    whose rows of a product are together already; ``choose`` selects in another way (``top1_in_place``)."""
    choose = choose or partial(top1_per_key, cluster=cluster)
    kept = choose(stg.select(*INT_SOURCE_COLUMNS), INT_KEY, primary=[F.col("ingestion_time").desc()], tie_break=INT_TIE_BREAK)
    return add_signals(kept).select(*INT_COLUMNS)


def fct_inventory(int_df: DataFrame, choose: Callable[..., DataFrame] = top1_per_key) -> DataFrame:
    """One row per (product, ingestion time); regions collapse to the first
    row by the tie-break order. ``choose`` selects in another way (``top1_in_place``), for signals read
    from their table; those of ``int_inventory_signals`` are together."""
    base = int_df.select(*[c for c in FCT_COLUMNS if c != "date_key"])
    deduped = choose(base, FCT_KEY, primary=[F.col("ingestion_time").desc()], tie_break=FCT_TIE_BREAK)
    return deduped.withColumn("date_key", date_key_int("ingestion_time")).select(*FCT_COLUMNS)


def dim_products(stg: DataFrame) -> DataFrame:
    """Latest snapshot per product (NULL ingestion times rank last)."""
    src = stg.select(*DIM_PRODUCTS_COLUMNS, "ingestion_time")
    latest = top1_per_key(src, ["product_id"], primary=[F.col("ingestion_time").desc_nulls_last()],
                          tie_break=DIM_PRODUCTS_TIE_BREAK)
    return latest.select(*DIM_PRODUCTS_COLUMNS)


def dim_suppliers(stg: DataFrame) -> DataFrame:
    src = stg.select(*DIM_SUPPLIERS_COLUMNS, "ingestion_time")
    latest = top1_per_key(src, ["supplier_name"], primary=[F.col("ingestion_time").desc_nulls_last()],
                          tie_break=DIM_SUPPLIERS_TIE_BREAK)
    return latest.select(*DIM_SUPPLIERS_COLUMNS)


def dim_dates(stg: DataFrame) -> DataFrame:
    """One row per distinct ingestion date (a NULL time gives a NULL row,
    which the not-null checks report)."""
    d = stg.select(F.to_date("ingestion_time").alias("full_date")).distinct()
    return d.select(
        date_key_string("full_date").alias("date_key"),
        F.col("full_date"),
        F.dayofmonth("full_date").alias("day"),
        F.month("full_date").alias("month"),
        F.year("full_date").alias("year"),
        day_of_week_sunday_first("full_date").alias("day_of_week"),
    ).select(*DIM_DATES_COLUMNS)


def dim_dates_extended(stg: DataFrame) -> DataFrame:
    """Date dimension plus the week and quarter the design text asks for."""
    return dim_dates(stg).withColumns({
        "week": F.weekofyear("full_date"),
        "quarter": F.quarter("full_date"),
    })


class Marts:
    """All models of one snapshot source, built lazily from a raw DataFrame.

    ``materialize=True`` is for consumers that read many layers at once (the
    check suite): raw and the signal layer are checkpointed to the shared
    folder once, so the source join and the dedup shuffle run once instead of
    once per consuming branch.

    ``together=True`` says that ``raw`` has the rows of a product in one partition."""

    def __init__(self, raw: DataFrame, materialize: bool = False, together: bool = False):
        if materialize:
            from shelfwise.session import cut_lineage
            raw = cut_lineage(raw, "raw")
        self.raw = raw
        self.stg = stg_products(raw)
        self.int = int_inventory_signals(self.stg, cluster=None if together and not materialize else FCT_KEY)
        if materialize:
            self.int = cut_lineage(self.int, "int")
        self.fct = fct_inventory(self.int)
        self.dim_products = dim_products(self.stg)
        self.dim_suppliers = dim_suppliers(self.stg)
        self.dim_dates = dim_dates(self.stg)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "raw.products": self.raw,
            "staging.stg_products": self.stg,
            "intermediate.int_inventory_signals": self.int,
            "marts.fct_inventory": self.fct,
            "marts.dim_products": self.dim_products,
            "marts.dim_suppliers": self.dim_suppliers,
            "marts.dim_dates": self.dim_dates,
        }
