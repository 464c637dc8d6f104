"""Quality checks kept from load to load.

The violations of the snapshot tables are kept by date in ``checks.violations``:
one row for each date and check that has any (for ``accepted_values`` and
``relationships`` one for each offending value). A load replaces the rows of the
dates that it touched and no other date is read, so a batch costs its own dates,
the kept violations and the dimensions, not the history. The counts equal
``quality.summary`` of the whole tables:

* ``unique_combination`` with ``ingestion_time`` among its columns can only be
  violated within a date.
* A fact row can lose its parent only if staging replaced the row at its instant,
  which touches that date in staging; so the fact is looked at on staging's dates
  too. Keys that had no parent are kept, and held against the dimensions whenever the
  checks are counted, as a parent may come later.
* Checks of dimensions, and any that can't be kept by date, are counted in whole.

A load marks the kept rows as open before it writes anything, and ``extend``
closes them. After a load that stopped, or one that kept no checks, they are
found open and made anew from the whole tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import quality
from shelfwise.operators.quality import Check
from shelfwise.schemas import PARTITION_COLUMN
from shelfwise.sources.warehouse import NO_DATE, Warehouse

KEPT = "checks.violations"
SNAPSHOTS = (quality.RAW, quality.STG, quality.INT, quality.FCT)
LABELS = ["table_name", "check_name", "column_name"]


def keepable(ch: Check) -> bool:
    if ch.table not in SNAPSHOTS:
        return False
    if ch.kind == "unique_combination":
        return "ingestion_time" in ch.columns
    return ch.kind in (*quality.ROW_LEVEL, "relationships")


def begin(wh: Warehouse) -> bool:
    """Marks the kept violations as open; whether they were closed, so that they hold for the tables as they are."""
    record = wh.record(KEPT)
    if record is None:
        return False
    if not record["open"]:
        wh.mark(KEPT, open=True)
    return not record["open"]


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.coalesce(F.col(PARTITION_COLUMN).cast("string"), F.lit(NO_DATE)))


def _rows(ch: Check, df: DataFrame, value: str | None) -> DataFrame:
    return df.select(F.lit(ch.table).alias("table_name"), F.lit(ch.kind).alias("check_name"), F.lit(ch.column_label).alias("column_name"),
                     "date", (F.col(value).cast("string") if value else F.lit(None).cast("string")).alias("value"), F.col("n").cast("long"))


def violations_by_date(df: DataFrame, checks: Sequence[Check], parents: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Kept rows of one snapshot table; ``df`` has its partition column."""
    df, out = _dated(df), []
    by_row = [ch for ch in checks if ch.kind in ("not_null", "accepted_range")]
    if by_row:
        counts = df.groupBy("date").agg(*[F.count_if(
            F.col(ch.columns[0]).isNull() if ch.kind == "not_null" else quality._range_violation(F.col(ch.columns[0]), ch.min_value, ch.max_value))
            .alias(f"v{i}") for i, ch in enumerate(by_row)])
        cells = F.array(*[F.struct(F.lit(ch.table).alias("table_name"), F.lit(ch.kind).alias("check_name"), F.lit(ch.column_label).alias("column_name"),
                                   F.col("date"), F.lit(None).cast("string").alias("value"), F.col(f"v{i}").cast("long").alias("n"))
                          for i, ch in enumerate(by_row)])
        out.append(counts.select(F.inline(cells)).filter("n > 0"))
    for ch in checks:
        c = F.col(ch.columns[0])
        if ch.kind == "accepted_values":
            out.append(_rows(ch, df.filter(~c.isin(list(ch.values))).groupBy("date", c.alias("value")).agg(F.count("*").alias("n")), "value"))
        elif ch.kind == "unique_combination":
            groups = df.groupBy("date", *ch.columns).agg(F.count("*").alias("size")).filter("size > 1")
            out.append(_rows(ch, groups.groupBy("date").agg(F.count("*").alias("n")), None))
        elif ch.kind == "relationships":
            keys = df.filter(c.isNotNull()).groupBy("date", c.alias("key")).agg(F.count("*").alias("n"))
            known = parents[ch.to_table].select(F.col(ch.to_field).alias("key")).filter("key IS NOT NULL").distinct()
            out.append(_rows(ch, keys.join(known, "key", "left_anti"), "key"))
    return out


def extend(wh: Warehouse, tables: Mapping[str, DataFrame], touched: Mapping[str, set[str]] | None,
           checks: Sequence[Check] = quality.SUITE) -> None:
    """Brings the kept violations up to the tables. ``touched`` has the dates of each snapshot table that the load
    wrote; None makes all of them anew."""
    labels = [[ch.table, ch.kind, ch.column_label] for ch in checks if keepable(ch)]
    record = wh.record(KEPT)
    if record is not None and record["checks"] != labels:
        touched = None                         # other checks than those kept
    parts: list[DataFrame] = []
    if touched is not None:
        stale = F.lit(False)
        for name, dates in touched.items():
            if dates:
                stale = stale | ((F.col("table_name") == name) & F.col("date").isin(sorted(dates)))
        parts.append(wh.read(KEPT).filter(~stale))
    for name in SNAPSHOTS:
        own = [ch for ch in checks if ch.table == name and keepable(ch)]
        if not own or not wh.exists(name):
            continue
        if touched is None:
            df = wh.read(name)
        else:
            df = wh.read_dates(name, touched.get(name, ()))
            if df is None:
                continue
        parts += violations_by_date(df, own, tables)
    if parts:
        wh.overwrite(KEPT, reduce(DataFrame.unionByName, parts).hint("rebalance"), open=False, checks=labels)


def summary(wh: Warehouse, tables: Mapping[str, DataFrame], checks: Sequence[Check] = quality.SUITE) -> DataFrame:
    """As ``quality.summary``, from the kept violations and the dimensions."""
    kept = wh.read(KEPT)
    counted = [kept.filter("check_name <> 'relationships'").groupBy(*LABELS).agg(
        F.when(F.col("check_name") == "accepted_values", F.count_distinct("value")).otherwise(F.sum("n")).alias("n_violations"))]
    for ch in checks:
        if keepable(ch) and ch.kind == "relationships":
            known = tables[ch.to_table].select(F.col(ch.to_field).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
            mine = kept.filter((F.col("table_name") == ch.table) & (F.col("check_name") == ch.kind) & (F.col("column_name") == ch.column_label))
            counted.append(mine.join(known, "value", "left_anti").groupBy(*LABELS).agg(F.sum("n").alias("n_violations")))
    held = [ch for ch in checks if keepable(ch)]
    every = wh.spark.createDataFrame([(ch.table, ch.kind, ch.column_label) for ch in held], ", ".join(f"{c} string" for c in LABELS))
    rows = every.join(reduce(DataFrame.unionByName, counted), LABELS, "left").select(
        *LABELS, F.coalesce("n_violations", F.lit(0)).cast("long").alias("n_violations"))
    whole = [ch for ch in checks if not keepable(ch)]
    return rows.unionByName(quality.summary(tables, whole)) if whole else rows
