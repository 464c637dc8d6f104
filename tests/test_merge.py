"""Incremental sequences through ``run_batch`` (T-inc-1 .. T-inc-5)."""

import datetime as dt
import glob
import os

import pytest
from helpers import raw_rows

from shelfwise.operators import merge
from shelfwise.plans import pipeline as P
from shelfwise.sources.warehouse import Warehouse

D1 = dt.datetime(2024, 1, 1, 8, 0)
D2 = dt.datetime(2024, 1, 2, 8, 0)
D3 = dt.datetime(2024, 1, 3, 8, 0)


def rows_of(wh, table, *cols):
    return sorted(tuple(r[c] for c in cols) for r in P.table(wh, table).collect())


@pytest.fixture()
def wh(spark, scratch):
    return Warehouse(spark, scratch("wh"))


def first_load(spark, wh):
    P.run_batch(spark, wh, raw_rows(spark, [dict(sku="A", ingestion_time=D1), dict(sku="B", ingestion_time=D2)]),
                "l1")


def test_replay_same_load_changes_nothing(spark, wh):
    first_load(spark, wh)
    before = {t: rows_of(wh, t, *P.LAYER_COLUMNS[t][:3]) for t in (P.STG, P.INT, P.FCT, P.DIM_P)}
    first_load(spark, wh)                               # same load id: raw replaced, merges idempotent
    after = {t: rows_of(wh, t, *P.LAYER_COLUMNS[t][:3]) for t in (P.STG, P.INT, P.FCT, P.DIM_P)}
    assert before == after
    assert P.table(wh, P.RAW).count() == 2


def test_new_rows_touch_only_new_partitions(spark, wh):
    first_load(spark, wh)
    old = sorted(glob.glob(os.path.join(wh.path(P.FCT).replace("file:", ""), "ingestion_date=2024-01-0[12]", "*")))
    res = P.run_batch(spark, wh, raw_rows(spark, [dict(sku="A", ingestion_time=D3)]), "l2")
    # staging re-selects B@D2 (inclusive watermark) next to the new A@D3
    assert [m_.delta_rows for m_ in res.merges] == [2, 1, 1]
    assert rows_of(wh, P.FCT, "product_id", "ingestion_time") == [("A", D1), ("A", D3), ("B", D2)]
    now = sorted(glob.glob(os.path.join(wh.path(P.FCT).replace("file:", ""), "ingestion_date=2024-01-0[12]", "*")))
    assert old == now                                   # history files untouched (append path)


def test_same_timestamp_late_row_reaches_staging_not_signals(spark, wh):
    first_load(spark, wh)
    res = P.run_batch(spark, wh, raw_rows(spark, [dict(sku="C", name="late", ingestion_time=D2)]), "l2")
    assert ("C", D2) in rows_of(wh, P.STG, "product_id", "ingestion_time")          # inclusive >=
    assert "C" in [r.product_id for r in P.table(wh, P.DIM_P).collect()]            # dims from staging
    assert "C" not in [r.product_id for r in P.table(wh, P.INT).collect()]          # strict >
    assert "C" not in [r.product_id for r in P.table(wh, P.FCT).collect()]
    assert res.late_rows == 0


def test_same_key_at_watermark_is_replaced(spark, wh):
    first_load(spark, wh)
    P.run_batch(spark, wh, raw_rows(spark, [dict(sku="B", stock_quantity=99, ingestion_time=D2)]), "l2")
    stg = rows_of(wh, P.STG, "product_id", "ingestion_time", "stock_quantity")
    # raw now holds B@D2 twice (qty 10 and 99); both are >= wm, so both replace the old row
    assert stg == [("A", D1, 10), ("B", D2, 10), ("B", D2, 99)]


def test_duplicate_match_can_abort(spark, wh):
    first_load(spark, wh)
    P.run_batch(spark, wh, raw_rows(spark, [dict(sku="B", stock_quantity=99, ingestion_time=D2)]), "l2")
    stg_src = wh.read(P.RAW)
    from shelfwise.plans import models as m
    with pytest.raises(merge.DuplicateMatchError):
        merge.incremental_merge(spark, wh, P.STG, stg_src, m.stg_products, ["product_id", "ingestion_time"],
                                P.LAYER_COLUMNS[P.STG], inclusive=True, fail_on_duplicate_match=True)


def test_older_rows_are_ignored_and_counted(spark, wh):
    first_load(spark, wh)
    res = P.run_batch(spark, wh, raw_rows(spark, [dict(sku="Z", ingestion_time=D1)]), "l2")
    assert res.late_rows == 1
    assert "Z" not in [r.product_id for r in P.table(wh, P.STG).collect()]
    assert P.table(wh, P.RAW).count() == 3                                           # still landed in raw


def test_null_ingestion_time_first_run_only(spark, wh):
    P.run_batch(spark, wh, raw_rows(spark, [dict(sku="N", ingestion_time=None), dict(sku="A", ingestion_time=D1)]),
                "l1")
    assert ("N", None) in rows_of(wh, P.STG, "product_id", "ingestion_time")
    res = P.run_batch(spark, wh, raw_rows(spark, [dict(sku="M", ingestion_time=None)]), "l2")
    assert res.null_time_rows == 1
    assert "M" not in [r.product_id for r in P.table(wh, P.STG).collect()]


def test_empty_target_uses_default_watermark(spark, wh):
    first_load(spark, wh)
    assert merge.high_watermark(wh.read(P.STG).limit(0)) == merge.DEFAULT_WATERMARK
    assert merge.high_watermark(wh.read(P.STG)) == D2


def test_checks_after_batch(spark, wh):
    res = P.run_batch(spark, wh, raw_rows(spark, [dict(sku="A", ingestion_time=D1)]), "l1", run_checks=True)
    failing = {(r.table_name, r.check_name, r.column_name) for r in res.checks if r.n_violations}
    assert len(res.checks) == 51 and failing == set()


def test_replayed_rows_append_and_dims_extend_exactly(spark, wh):
    """A load whose rows at the watermark are unchanged replays is an append,
    and the incrementally extended dimensions equal a full rebuild."""
    from shelfwise.plans import models as m
    first_load(spark, wh)
    res = P.run_batch(spark, wh, raw_rows(spark, [dict(sku="A", name="renamed", ingestion_time=D3),
                                                  dict(sku="D", supplier_name="T", ingestion_time=D3)]), "l2")
    assert all(r.appended for r in res.merges)
    stg = P.table(wh, P.STG)
    assert stg.count() == 4
    for name, model in ((P.DIM_P, m.dim_products), (P.DIM_S, m.dim_suppliers), (P.DIM_D, m.dim_dates)):
        assert sorted(P.table(wh, name).collect()) == sorted(model(stg).collect())
    assert {r.product_id: r.product_name for r in P.table(wh, P.DIM_P).collect()}["A"] == "renamed"


def test_register_exposes_qualified_names(spark, wh):
    first_load(spark, wh)
    for name in (P.STG, P.FCT, P.DIM_P):
        wh.register(name)
    assert spark.table("staging.stg_products").count() == 2
    assert spark.sql("SELECT COUNT(*) AS n FROM marts.fct_inventory").first().n == 2
    assert spark.table("marts.dim_products").count() == 2
