"""Layer models on small hand-made snapshots: dedup grain, tie-breaks,
date keys, dimension choice."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.plans import models as m
from helpers import raw_rows

T1 = dt.datetime(2024, 5, 4, 10, 0)   # a Saturday
T2 = dt.datetime(2024, 5, 5, 10, 0)


def test_int_keeps_regions_fact_collapses(spark):
    raw = raw_rows(spark, [
        dict(sku="P1", stock_region="EU", stock_quantity=5, ingestion_time=T1),
        dict(sku="P1", stock_region="US", stock_quantity=7, ingestion_time=T1),
        dict(sku="P1", stock_region="US", stock_quantity=3, ingestion_time=T1),   # duplicate snapshot
        dict(sku="P1", stock_region="US", stock_quantity=9, ingestion_time=T2),
    ])
    mt = m.Marts(raw)
    assert mt.stg.count() == 4                                     # staging keeps in-batch duplicates
    ints = sorted((r.warehouse_region, r.ingestion_time, r.stock_quantity) for r in mt.int.collect())
    assert ints == [("EU", T1, 5), ("US", T1, 3), ("US", T2, 9)]  # tie-break: lowest remaining values
    fct = sorted((r.ingestion_time, r.warehouse_region, r.date_key) for r in mt.fct.collect())
    # regions collapse by the fact tie-break (supplier, then quantity): US@3 beats EU@5
    assert fct == [(T1, "US", 20240504), (T2, "US", 20240505)]


def test_dimensions_latest_row(spark):
    raw = raw_rows(spark, [
        dict(sku="P1", name="old", category="c", ingestion_time=T1, supplier_name="A", supplier_contact="a1"),
        dict(sku="P1", name="new", category="c", ingestion_time=T2, supplier_name="A", supplier_contact="a2"),
        dict(sku="P2", name="never", category="c", ingestion_time=None, supplier_name="B", supplier_contact="b"),
        dict(sku="P2", name="dated", category="c", ingestion_time=T1, supplier_name="B", supplier_contact="b0"),
    ])
    mt = m.Marts(raw)
    assert {r.product_id: r.product_name for r in mt.dim_products.collect()} == {"P1": "new", "P2": "dated"}
    assert {r.supplier_name: r.supplier_contact for r in mt.dim_suppliers.collect()} == {"A": "a2", "B": "b0"}
    dates = {r.date_key: r for r in mt.dim_dates.collect()}
    assert dates["20240504"].day_of_week == 7 and dates["20240505"].day_of_week == 1   # 1 = Sunday
    assert dates["20240504"].full_date == dt.date(2024, 5, 4)
    assert None in dates                                           # NULL time -> NULL date row
    ext = {r.date_key: r for r in m.dim_dates_extended(mt.stg).collect() if r.date_key}
    assert ext["20240505"].week == 18 and ext["20240505"].quarter == 2


def test_dedup_plan_limits_before_shuffle(spark):
    raw = raw_rows(spark, [dict(sku="P1", ingestion_time=T1)])
    plan = m.Marts(raw).int._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
