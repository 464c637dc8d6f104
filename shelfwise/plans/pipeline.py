"""One load batch through all layers.

    raw append (keyed by load id)
      -> staging merge      (inclusive watermark)
      -> signals merge      (strict watermark, reads staging)
      -> fact merge         (strict watermark, reads signals)
      -> dimensions         (as of staging's watermark, see ``extend_dims``)
      -> optional checks

Each step reads the previous layer's *table*, so every step starts from
written data (lineage is cut at each layer and a failed step can be re-run
alone). Only partitions at or after each watermark are read and rewritten.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.dates import ntz_lit

from shelfwise.operators import quality
from shelfwise.operators.dedup import top1_in_place, top1_per_key
from shelfwise.operators.merge import DEFAULT_WATERMARK, MergeResult, incremental_merge, late_filter
from shelfwise.plans import checks as kept
from shelfwise.plans import models as m
from shelfwise.schemas import (DIM_DATES_COLUMNS, DIM_PRODUCTS_COLUMNS, DIM_SUPPLIERS_COLUMNS, FCT_COLUMNS,
                               FCT_KEY, INT_COLUMNS, INT_KEY, RAW_COLUMNS, STG_COLUMNS, STG_KEY)
from shelfwise.sources.warehouse import Warehouse

RAW = "raw.products"
STG = "staging.stg_products"
INT = "intermediate.int_inventory_signals"
FCT = "marts.fct_inventory"
DIM_P = "marts.dim_products"
DIM_S = "marts.dim_suppliers"
DIM_D = "marts.dim_dates"

LAYER_COLUMNS = {RAW: RAW_COLUMNS, STG: STG_COLUMNS, INT: INT_COLUMNS, FCT: FCT_COLUMNS,
                 DIM_P: DIM_PRODUCTS_COLUMNS, DIM_S: DIM_SUPPLIERS_COLUMNS, DIM_D: DIM_DATES_COLUMNS}


@dataclass
class BatchResult:
    load_id: str
    rows: int = 0
    merges: list[MergeResult] = field(default_factory=list)
    late_rows: int = 0
    null_time_rows: int = 0
    checks: list | None = None


def table(wh: Warehouse, name: str) -> DataFrame:
    """A layer table with the model's own columns (partition columns off)."""
    if name in DIM_STATE:
        return wh.read(name).filter("is_current").select(*LAYER_COLUMNS[name])
    return wh.read_model(name, LAYER_COLUMNS[name])


def run_batch(spark: SparkSession, wh: Warehouse, raw_batch: DataFrame, load_id: str | int,
              run_checks: bool = False, fail_on_violation: bool = False, keep_checks: bool = False) -> BatchResult:
    """One load through all layers. ``run_checks`` counts the violations of the whole tables; ``keep_checks`` counts
    the same from kept ones, of which it renews the dates of this load (see ``plans.checks``)."""
    res = BatchResult(str(load_id))
    closed = kept.begin(wh)
    raw_dates = wh.load_dates(RAW, load_id)
    raw_batch = raw_batch.select(*RAW_COLUMNS)

    # Late rows of this load, against the staging watermark before the merge
    # (they are stored in raw but never reach staging).
    # Counted while the load is written, in the same pass.
    wh.recover(STG)
    first = not wh.exists(STG)
    wm: dt.datetime = wh.watermark(STG) or DEFAULT_WATERMARK
    seen = Observation(f"load-{uuid.uuid4().hex}")
    res.rows = wh.write_load(RAW, raw_batch.observe(seen, F.count_if(F.col("ingestion_time") < ntz_lit(wm)).alias("late"),
                                                    F.count_if(F.col("ingestion_time").isNull()).alias("nulls")), load_id)
    if res.rows and not first:
        res.late_rows, res.null_time_rows = seen.get["late"], seen.get["nulls"]

    for target, source, model, keys, inclusive in ((STG, RAW, m.stg_products, STG_KEY, True),
                                                   (INT, STG, partial(m.int_inventory_signals, choose=top1_in_place), INT_KEY, False),
                                                   (FCT, INT, partial(m.fct_inventory, choose=top1_in_place), FCT_KEY, False)):
        res.merges.append(incremental_merge(spark, wh, target, source, model, keys, LAYER_COLUMNS[target], inclusive, in_place=True))
    if not wh.exists(STG):                     # no row so far
        return res
    if all(wh.exists(d) and (wh.record(d) or {}).get("as_of") for d in (DIM_P, DIM_S, DIM_D)):
        extend_dims(wh)
    else:
        refresh_dims(wh)
    if keep_checks:
        kept.extend(wh, tables(wh), _touched(wh, res, raw_dates | wh.load_dates(RAW, load_id)) if closed else None)
        res.checks = kept.summary(wh, tables(wh)).collect()
    elif run_checks or fail_on_violation:
        res.checks = quality.summary(tables(wh)).collect()
    if fail_on_violation and any(c["n_violations"] for c in res.checks):
        raise CheckViolation([c for c in res.checks if c["n_violations"]])
    return res


def _touched(wh: Warehouse, res: BatchResult, raw_dates: set[str]) -> dict[str, set[str]]:
    """Dates that a load wrote, by table; the fact's checks also look at those of staging."""
    dates = {r.table: set(wh.record(r.table)["dates"]) if r.publish is not None else set() for r in res.merges}
    return dates | {RAW: raw_dates, FCT: dates[FCT] | dates[STG]}


class CheckViolation(RuntimeError):
    """Checks that the layers violate after a load; its argument lists them."""


# Dimension tables physically keep, for each key, the latest row before the
# instant that they are as of (staging's watermark) and the latest row at that
# instant, with their ingestion times: rows at the instant may still be
# replaced, those before it can't. ``is_current`` marks the one that counts;
# consumers see only that (``table()``).
DIM_STATE = {DIM_P: ("product_id", m.DIM_PRODUCTS_TIE_BREAK),
             DIM_S: ("supplier_name", m.DIM_SUPPLIERS_TIE_BREAK)}


def _latest(src: DataFrame, name: str, as_of: dt.datetime | None) -> DataFrame:
    key, tie = DIM_STATE[name]
    at = F.lit(False) if as_of is None else F.coalesce(F.col("ingestion_time") == ntz_lit(as_of), F.lit(False))
    rows = top1_per_key(src.select(*LAYER_COLUMNS[name], "ingestion_time", at.alias("at_instant")), [key, "at_instant"],
                        primary=[F.col("ingestion_time").desc_nulls_last()], tie_break=tie)
    last = F.max("at_instant").over(Window.partitionBy(key))
    return rows.withColumn("is_current", F.col("at_instant") == last).drop("at_instant")


def _dim_state(wh: Warehouse) -> dict:
    as_of = wh.watermark(STG)
    return {"as_of": as_of.isoformat() if as_of else None, "staging": (wh.record(STG) or {}).get("publish")}


def refresh_dims(wh: Warehouse) -> None:
    """Full rebuild from all of staging (the model's definition): a
    top-1-per-key or a distinct each, partially aggregated before the
    shuffle, so the shuffle carries about one row per key and map task."""
    stg, state = table(wh, STG), _dim_state(wh)
    for name in DIM_STATE:
        wh.overwrite(name, _latest(stg, name, wh.watermark(STG)), **state)
    wh.overwrite(DIM_D, m.dim_dates(stg), **state)


def extend_dims(wh: Warehouse) -> None:
    """Same result as ``refresh_dims`` at O(dimension + batch) cost. What a
    dimension holds from before the instant it is as of stands; everything at
    or after it is taken from staging's folders of those dates. So rows at the
    instant that a merge replaced are read anew, a dimension that a stopped run left
    behind catches up, and no earlier staging is read in either case."""
    state = _dim_state(wh)
    for name in (DIM_P, DIM_S, DIM_D):
        old = wh.record(name)
        if old["staging"] == state["staging"]:
            continue                           # staging is as it was
        since = dt.datetime.fromisoformat(old["as_of"])
        new = wh.read_since(STG, since.date()).filter(F.col("ingestion_time") >= ntz_lit(since))
        if name == DIM_D:
            rows = wh.read(name).select(*LAYER_COLUMNS[name]).unionByName(m.dim_dates(new)).distinct()
        else:
            cols = [*LAYER_COLUMNS[name], "ingestion_time"]
            stands = wh.read(name).filter(F.col("ingestion_time").isNull() | (F.col("ingestion_time") < ntz_lit(since)))
            rows = _latest(stands.select(*cols).unionByName(new.select(*cols)), name, wh.watermark(STG))
        wh.overwrite(name, rows, **state)


def tables(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: table(wh, name) for name in LAYER_COLUMNS}


def late_rows(source: DataFrame, wm: dt.datetime, inclusive: bool = True) -> DataFrame:
    """Rows of a batch a merge would ignore (older than the watermark)."""
    return late_filter(source, wm, inclusive)
