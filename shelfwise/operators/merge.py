"""Incremental high-watermark merge on Parquet (no lakehouse format needed).

Semantics of an incremental model with ``unique_key``:

1. target missing -> full load of the source;
2. ``wm = COALESCE(MAX(target.ingestion_time), TIMESTAMP '2020-01-01')``;
3. ``delta = source WHERE ingestion_time >= wm`` (inclusive, staging) or
   ``> wm`` (strict, signals and fact); the model body runs on the delta only;
4. upsert by key: target rows whose key matches a delta row are replaced,
   the rest stay; NULL keys never match.

Because ``ingestion_time`` is part of every key and ``wm`` is the target's
maximum, a delta row can only match target rows with ``ingestion_time = wm``:

* strict watermark (``> wm``): nothing can match, the merge is an append;
* inclusive (``>= wm``): only rows at exactly ``wm`` can match. When no delta
  key matches one of them, or every matched key comes back with exactly the
  rows already stored (the re-selected rows of a replay), it is again an
  append of the new rows; otherwise the partition ``date(wm)`` is rewritten
  together with the new dates (dynamic partition overwrite). History is
  never read or rewritten.

So a batch costs O(batch) and, where rows at the watermark meet, its day; not O(table).

Failure safety: the rows that a merge adds are staged beside the table, and
published by a record that is written first (see ``sources.warehouse``): the
date folders move into place in ascending order, and a publish that stopped
half-way is finished before the next merge reads the watermark. The watermark
comes from the record of completed publishes; sources are read from the folders
of its date on, so neither target nor source is listed as a whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.dates import ntz_lit

from shelfwise.schemas import PARTITION_COLUMN
from shelfwise.sources.warehouse import Warehouse, with_partition

# Fixed value: watermark used when the target exists but is empty.
DEFAULT_WATERMARK = dt.datetime(2020, 1, 1, 0, 0, 0)
TS = "ingestion_time"


class DuplicateMatchError(RuntimeError):
    """Several source rows match one target row (a MERGE would abort)."""


@dataclass
class MergeResult:
    table: str
    full_load: bool
    watermark: dt.datetime | None
    delta_rows: int
    appended: bool = True          # False when matched keys forced a partition rewrite
    publish: int | None = None     # number of the publish; None when nothing was added


def high_watermark(target: DataFrame, default: dt.datetime = DEFAULT_WATERMARK, newest: dt.date | None = None) -> dt.datetime:
    """MAX(ingestion_time): the newest partition date, then the max inside
    that one partition. ``newest`` is that date where the caller knows it
    (``Warehouse.newest_date``); finding it here opens every file's footer."""
    if newest is None:
        newest = target.agg(F.max(PARTITION_COLUMN).alias("d")).first()["d"]
    if newest is None:
        return default
    wm = target.filter(F.col(PARTITION_COLUMN) == F.lit(newest)).agg(F.max(TS).alias("m")).first()["m"]
    return wm if wm is not None else default


def late_filter(df: DataFrame, wm: dt.datetime, inclusive: bool) -> DataFrame:
    """The complement of ``watermark_filter`` for non-NULL times: rows a
    merge ignores because they are older than the target."""
    lit = ntz_lit(wm)
    return df.filter((F.col(TS) < lit) if inclusive else (F.col(TS) <= lit))


def watermark_filter(df: DataFrame, wm: dt.datetime, inclusive: bool) -> DataFrame:
    """Rows past the watermark; the date bound lets a partitioned source
    prune whole partitions before the row filter."""
    lit = ntz_lit(wm)
    cond: Column = (F.col(TS) >= lit) if inclusive else (F.col(TS) > lit)
    if PARTITION_COLUMN in df.columns:
        df = df.filter(F.col(PARTITION_COLUMN) >= F.lit(wm.date()))
    return df.filter(cond)


def incremental_merge(spark: SparkSession, wh: Warehouse, table: str, source: DataFrame | str,
                      model: Callable[[DataFrame], DataFrame], keys: Sequence[str], columns: Sequence[str],
                      inclusive: bool, fail_on_duplicate_match: bool = False, in_place: bool = False) -> MergeResult:
    """Run ``model`` on the new part of ``source`` and upsert it into
    ``table``. ``source`` is a table of the warehouse, of which only the folders from the
    watermark's date on are opened, or a DataFrame (partition columns enable
    pruning); ``model`` must return exactly ``columns``. ``in_place`` says that it leaves rows in the tasks that read
    them, or brings them together by date: the rows of a table's date folders then go to their folders here without a shuffle.

    Matched keys use delete+insert: every target row with a delta key is
    replaced by all delta rows with that key. The inclusive watermark
    re-selects the source rows at exactly ``wm`` on every run, so a key
    duplicated at that instant meets itself again; a warehouse MERGE aborts
    there (and on every later run), delete+insert leaves the rows as they
    were. ``fail_on_duplicate_match=True`` restores the abort."""
    wh.recover(table)
    first = not wh.exists(table)
    wm = None if first else wh.watermark(table) or DEFAULT_WATERMARK
    dated = in_place and isinstance(source, str)
    if isinstance(source, str):
        if not wh.exists(source):
            return MergeResult(table, first, wm, 0)
        source = wh.read(source) if first else wh.read_since(source, wm.date())
    if first:
        staged = wh.stage(table, model(source).select(*columns), dated=dated)
        if not staged.rows:
            wh.discard(staged)
            return MergeResult(table, True, None, 0)
        return MergeResult(table, True, None, staged.rows, publish=wh.publish(table, staged))

    staged = wh.stage(table, model(watermark_filter(source, wm, inclusive)).select(*columns), dated=dated)
    if staged.rows == 0:
        wh.discard(staged)
        return MergeResult(table, False, wm, 0)
    day = wm.date().isoformat()
    if not inclusive or day not in staged.dates:
        return MergeResult(table, False, wm, staged.rows, publish=wh.publish(table, staged))

    # Only rows at exactly the watermark can match, so only its day is looked at.
    wm_lit = ntz_lit(wm)
    old_day = wh.read_since(table, wm.date()).filter(F.col(PARTITION_COLUMN) == F.lit(wm.date())).select(*columns)
    new_day = wh.read_staged(staged, day).select(*columns)
    at_wm, delta_wm = old_day.filter(F.col(TS) == wm_lit), new_day.filter(F.col(TS) == wm_lit)
    matched = delta_wm.select(*keys).distinct().join(at_wm.select(*keys).distinct(), list(keys))
    if fail_on_duplicate_match:
        dup = (new_day.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                      .join(matched, list(keys), "left_semi"))
        if not dup.isEmpty():
            wh.discard(staged)
            raise DuplicateMatchError(f"{table}: several source rows match one target row")
    if matched.isEmpty():
        return MergeResult(table, False, wm, staged.rows, publish=wh.publish(table, staged))
    # The inclusive watermark re-selects the source rows at exactly ``wm`` on
    # every run. When the re-selected rows of every matched key equal the
    # stored ones (same multiset, NULL-safe), replacing them changes nothing:
    # append only the unmatched rows. Only rows at one instant are compared.
    d_m = delta_wm.join(matched, list(keys), "left_semi")
    t_m = at_wm.join(matched, list(keys), "left_semi")
    same = d_m.exceptAll(t_m).isEmpty() and t_m.exceptAll(d_m).isEmpty()
    rows = new_day.join(matched, list(keys), "left_anti")
    if not same:
        rows = new_day.unionByName(old_day.join(new_day.select(*keys).distinct(), list(keys), "left_anti"))
    staged = wh.restage(staged, day, with_partition(rows.select(*columns)))
    if not staged.dates:
        wh.discard(staged)
        return MergeResult(table, False, wm, staged.rows)
    return MergeResult(table, False, wm, staged.rows, same, wh.publish(table, staged, () if same else (day,)))
