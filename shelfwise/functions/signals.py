"""Inventory risk signals as Column expressions (all JVM-side, codegen'd).

NULL handling follows SQL CASE semantics: a NULL comparison is not true, so it
falls through to the ELSE branch (NULL status -> DISCONTINUED, NULL age ->
STALE, NULL rating -> no demand).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status normalization (raw status -> normalized), and the
# signal thresholds.
STATUS_MAP = [
    ("Out of Stock", "OUT_OF_STOCK"),
    ("Low Stock", "LOW_STOCK"),
    ("In Stock", "IN_STOCK"),
    ("Backordered", "BACKORDER"),
]
STATUS_ELSE = "DISCONTINUED"
ALERT_STATUSES = ["Low Stock", "Out of Stock"]
LOW_QUANTITY_BELOW = 100        # in-stock risk: quantity < 100
LONG_LEAD_ABOVE = 10            # lead time > 10 days
FRESH_BELOW = 7                 # age < 7 -> FRESH
NORMAL_RANGE = (7, 30)          # BETWEEN 7 AND 30 -> NORMAL
AGING_RANGE = (31, 90)          # BETWEEN 31 AND 90 -> AGING
HIGH_DEMAND_MIN_RATING = 4
HIGH_DEMAND_MIN_REVIEWS = 500


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_since(later="ingestion_time", earlier="stock_last_restocked") -> Column:
    """Whole elapsed days (24 h units, truncated toward zero), not calendar
    days: 23:00 -> 01:00 next day is 0."""
    return F.timestamp_diff("DAY", _c(earlier), _c(later))


def normalized_stock_status(status="stock_status") -> Column:
    s = _c(status)
    expr = None
    for raw, norm in STATUS_MAP:
        expr = F.when(s == raw, F.lit(norm)) if expr is None else expr.when(s == raw, F.lit(norm))
    return expr.otherwise(F.lit(STATUS_ELSE))


def alert_flag(status="stock_status") -> Column:
    return F.when(_c(status).isin(ALERT_STATUSES), F.lit(True)).otherwise(F.lit(False))


def in_stock_risk_flag(status="stock_status", quantity="stock_quantity", lead="lead_time_days") -> Column:
    cond = (_c(status) == "In Stock") & (_c(quantity) < LOW_QUANTITY_BELOW) & (_c(lead) > LONG_LEAD_ABOVE)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def backorder_delay_flag(status="stock_status", lead="lead_time_days") -> Column:
    cond = (_c(status) == "Backordered") & (_c(lead) > LONG_LEAD_ABOVE)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def restock_staleness_flag(age="days_since_last_restock") -> Column:
    a = _c(age)
    return (F.when(a < FRESH_BELOW, F.lit("FRESH"))
            .when(a.between(*NORMAL_RANGE), F.lit("NORMAL"))
            .when(a.between(*AGING_RANGE), F.lit("AGING"))
            .otherwise(F.lit("STALE")))


def high_demand_flag(rating="rating", reviews="review_count") -> Column:
    cond = (_c(rating) >= HIGH_DEMAND_MIN_RATING) & (_c(reviews) >= HIGH_DEMAND_MIN_REVIEWS)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def inventory_risk_flag(norm="normalized_stock_status", demand="high_demand_flag",
                        lead="lead_time_days", in_stock_risk="in_stock_risk_flag",
                        backorder_delay="backorder_delay_flag") -> Column:
    """Priority order matters: the first matching rule wins."""
    n = _c(norm)
    return (F.when(n == "OUT_OF_STOCK", F.lit("HIGH_RISK"))
            .when((n == "LOW_STOCK") & _c(demand) & (_c(lead) > LONG_LEAD_ABOVE), F.lit("HIGH_RISK"))
            .when(_c(in_stock_risk), F.lit("MEDIUM_RISK"))
            .when(_c(backorder_delay), F.lit("MEDIUM_RISK"))
            .otherwise(F.lit("LOW_RISK")))


def add_signals(df: DataFrame) -> DataFrame:
    """``SELECT *, <signals>`` in three layers (each layer reads the one
    before it); Catalyst collapses them into one projection."""
    df = df.withColumn("days_since_last_restock", days_since())
    df = df.withColumns({
        "normalized_stock_status": normalized_stock_status(),
        "alert_flag": alert_flag(),
        "in_stock_risk_flag": in_stock_risk_flag(),
        "backorder_delay_flag": backorder_delay_flag(),
        "restock_staleness_flag": restock_staleness_flag(),
        "high_demand_flag": high_demand_flag(),
    })
    return df.withColumn("inventory_risk_flag", inventory_risk_flag())


# Design-text metrics the reference specifies but never built (optional set).

def low_stock_flag(quantity="stock_quantity", reorder="reorder_point") -> Column:
    """Quantity below the reorder point (NULL when either side is NULL)."""
    return _c(quantity) < _c(reorder)


def price_gap(msrp="msrp", sale="sale_price") -> Column:
    return _c(msrp) - _c(sale)


def high_demand_low_stock_flag(demand="high_demand_flag", alert="alert_flag") -> Column:
    return _c(demand) & _c(alert)
