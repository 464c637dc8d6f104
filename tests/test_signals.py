"""Signal rules at their boundaries (one Spark job for the whole table)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import signals as S

T0 = dt.datetime(2024, 3, 10, 12, 0, 0)


def signal_rows(spark, rows):
    """rows: (case, status, qty, lead, rating, reviews, restocked, ingested)."""
    df = spark.createDataFrame(rows, "case string, stock_status string, stock_quantity int, lead_time_days int, "
                                     "rating double, review_count int, stock_last_restocked timestamp_ntz, "
                                     "ingestion_time timestamp_ntz")
    out = S.add_signals(df).collect()
    return {r.case: r for r in out}


def test_status_normalization_and_alert(spark):
    rows = [(s or "null", s, 1, 1, 1.0, 1, T0, T0) for s in
            ["Out of Stock", "Low Stock", "In Stock", "Backordered", "Discontinued", "weird", None]]
    got = signal_rows(spark, rows)
    assert {k: v.normalized_stock_status for k, v in got.items()} == {
        "Out of Stock": "OUT_OF_STOCK", "Low Stock": "LOW_STOCK", "In Stock": "IN_STOCK",
        "Backordered": "BACKORDER", "Discontinued": "DISCONTINUED", "weird": "DISCONTINUED",
        "null": "DISCONTINUED"}
    assert {k for k, v in got.items() if v.alert_flag} == {"Out of Stock", "Low Stock"}
    assert got["null"].alert_flag is False


@pytest.mark.parametrize("age,flag", [(-1, "FRESH"), (0, "FRESH"), (6, "FRESH"), (7, "NORMAL"), (30, "NORMAL"),
                                      (31, "AGING"), (90, "AGING"), (91, "STALE"), (None, "STALE")])
def test_staleness_bands(spark, age, flag):
    restocked = None if age is None else T0 - dt.timedelta(days=age)
    got = signal_rows(spark, [("x", "In Stock", 1, 1, 1.0, 1, restocked, T0)])["x"]
    assert got.days_since_last_restock == age and got.restock_staleness_flag == flag


def test_age_counts_whole_24h_units(spark):
    """23:00 -> 01:00 next day is 0 days; 47 h is 1 day; negative truncates
    toward zero."""
    a = dt.datetime(2024, 1, 1, 23, 0)
    rows = [("a", "In Stock", 1, 1, 1.0, 1, a, a + dt.timedelta(hours=2)),
            ("b", "In Stock", 1, 1, 1.0, 1, a, a + dt.timedelta(hours=47)),
            ("c", "In Stock", 1, 1, 1.0, 1, a + dt.timedelta(hours=30), a)]
    got = signal_rows(spark, rows)
    assert [got[k].days_since_last_restock for k in "abc"] == [0, 1, -1]


def test_thresholds(spark):
    rows = [("q99", "In Stock", 99, 11, 1.0, 1, T0, T0), ("q100", "In Stock", 100, 11, 1.0, 1, T0, T0),
            ("l10", "In Stock", 5, 10, 1.0, 1, T0, T0), ("bo11", "Backordered", 5, 11, 1.0, 1, T0, T0),
            ("bo10", "Backordered", 5, 10, 1.0, 1, T0, T0),
            ("r39", "In Stock", 500, 1, 3.9, 500, T0, T0), ("r4", "In Stock", 500, 1, 4.0, 500, T0, T0),
            ("n499", "In Stock", 500, 1, 4.0, 499, T0, T0), ("rnull", "In Stock", 500, 1, None, 900, T0, T0)]
    got = signal_rows(spark, rows)
    assert got["q99"].in_stock_risk_flag and not got["q100"].in_stock_risk_flag
    assert not got["l10"].in_stock_risk_flag
    assert got["bo11"].backorder_delay_flag and not got["bo10"].backorder_delay_flag
    assert [got[k].high_demand_flag for k in ("r39", "r4", "n499", "rnull")] == [False, True, False, False]


def test_risk_priority(spark):
    rows = [("oos", "Out of Stock", 1, 1, 1.0, 1, T0, T0),
            ("low_hot_slow", "Low Stock", 1, 11, 4.5, 900, T0, T0),
            ("low_hot_fast", "Low Stock", 1, 10, 4.5, 900, T0, T0),
            ("instock_risk", "In Stock", 1, 11, 1.0, 1, T0, T0),
            ("backorder", "Backordered", 1, 11, 1.0, 1, T0, T0),
            ("calm", "In Stock", 500, 1, 1.0, 1, T0, T0),
            ("nulls", None, None, None, None, None, None, None)]
    got = signal_rows(spark, rows)
    assert {k: v.inventory_risk_flag for k, v in got.items()} == {
        "oos": "HIGH_RISK", "low_hot_slow": "HIGH_RISK", "low_hot_fast": "LOW_RISK",
        "instock_risk": "MEDIUM_RISK", "backorder": "MEDIUM_RISK", "calm": "LOW_RISK", "nulls": "LOW_RISK"}


def test_design_text_metrics(spark):
    df = spark.createDataFrame([(5, 10, 9.0, 7.5, True, True), (10, 10, 1.0, 1.0, True, False)],
                               "stock_quantity int, reorder_point int, msrp double, sale_price double, "
                               "high_demand_flag boolean, alert_flag boolean")
    r = df.select(S.low_stock_flag().alias("a"), S.price_gap().alias("b"),
                  S.high_demand_low_stock_flag().alias("c")).collect()
    assert [(x.a, x.b, x.c) for x in r] == [(True, 1.5, True), (False, 0.0, False)]


def test_ntz_literal_ignores_os_time_zone(spark, monkeypatch):
    import time

    from shelfwise.functions.dates import ntz_lit
    monkeypatch.setenv("TZ", "America/Los_Angeles")
    time.tzset()
    try:
        got = spark.range(1).select(ntz_lit(dt.datetime(2024, 1, 2, 3, 4, 5)).alias("t")).first().t
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()
    assert got == dt.datetime(2024, 1, 2, 3, 4, 5)
