"""Dashboard semantics: NULL handling, ordering, top-k ties, filters."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.plans import insights as I

T = dt.datetime(2024, 1, 1)


def fixture(spark):
    fct = spark.createDataFrame([
        ("P1", "S1", 10, "HIGH_RISK", True, True, 5, "EU", "LOW_STOCK"),
        ("P2", "S1", 0, "HIGH_RISK", False, False, 20, "EU", "OUT_OF_STOCK"),
        ("P3", "S2", None, "LOW_RISK", False, True, None, "US", None),
        ("P4", None, 7, "HIGH_RISK", True, True, 3, "US", "LOW_STOCK"),     # no supplier: dropped
        ("P9", "S2", 4, "MEDIUM_RISK", True, False, 1, None, "IN_STOCK"),   # no dimension row: dropped
    ], "product_id string, supplier_name string, stock_quantity int, inventory_risk_flag string, "
       "alert_flag boolean, high_demand_flag boolean, lead_time_days int, warehouse_region string, "
       "normalized_stock_status string")
    dim = spark.createDataFrame([("P1", "Apple", "c", "b"), ("P2", "Bean", "c", "b"), ("P3", "Corn", "c", "b"),
                                 ("P4", "Date", "c", "b")],
                                "product_id string, product_name string, product_category string, "
                                "product_brand string")
    return fct, dim


def test_view_cleaning_and_kpis(spark):
    fct, dim = fixture(spark)
    v = I.retail_view(fct, dim)
    assert sorted(r.product_id for r in v.collect()) == ["P1", "P2", "P3"]
    k = I.kpi_overview(v).first()
    assert (k.total_products, k.low_stock_count, k.high_risk_count) == (3, 1, 2)
    o = I.overview_metrics(v).first()
    assert o.avg_lead_time == 12.5 and o.high_risk_suppliers == 1


def test_groupings(spark):
    fct, dim = fixture(spark)
    v = I.retail_view(fct, dim)
    assert {r.warehouse_region: r.total_stock for r in I.stock_by_region(v).collect()} == {"EU": 10, "US": 0}
    assert [(r.normalized_stock_status, r.row_count) for r in I.status_distribution(v).collect()] == [
        ("LOW_STOCK", 1), ("OUT_OF_STOCK", 1)]
    s = {r.supplier_name: (r.avg_lead_time, r.total_stock) for r in I.supplier_summary(v).collect()}
    assert s == {"S1": (12.5, 10), "S2": (None, 0)}
    assert [r.supplier_name for r in I.supplier_list(v).collect()] == ["S1", "S2"]
    assert [(r.product_name, r.total_stock) for r in I.top_high_risk_products(v, 1).collect()] == [("Bean", 0)]
    assert [r.product_name for r in I.critical_products(v).collect()] == ["Apple"]
    assert sorted(r.product_name for r in I.high_demand_products(v).collect()) == ["Apple", "Corn"]


def test_supplier_filter(spark):
    fct, dim = fixture(spark)
    assert I.retail_view(fct, dim, "All").count() == 3
    assert [r.product_id for r in I.retail_view(fct, dim, "S2").collect()] == ["P3"]


def test_string_numbers_are_coerced(spark):
    df = spark.createDataFrame([("12",), ("x",)], "lead_time_days string")
    assert [r.lead_time_days for r in I.coerce_numeric(df, ["lead_time_days"]).collect()] == [12.0, None]


def test_top_k_plan_has_no_global_sort(spark):
    fct, dim = fixture(spark)
    plan = I.top_high_risk_products(I.retail_view(fct, dim))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
