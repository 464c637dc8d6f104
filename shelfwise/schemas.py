"""Column lists and types per layer.

Timestamps are ``TIMESTAMP_NTZ`` holding UTC wall-clock time: the values do
not move with the session time zone, and they compare 1:1 with the parquet
inputs and with DuckDB's ``TIMESTAMP``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The flattened landing columns, in the order the loader emits
# them (28 columns), plus the load stamp.
RAW_FIELDS = [
    ("sku", T.StringType()),
    ("name", T.StringType()),
    ("description", T.StringType()),
    ("category", T.StringType()),
    ("brand", T.StringType()),
    ("condition", T.StringType()),
    ("msrp", T.DoubleType()),
    ("sale", T.DoubleType()),
    ("discount", T.DoubleType()),
    ("currency", T.StringType()),
    ("stock_quantity", T.IntegerType()),
    ("stock_status", T.StringType()),
    ("stock_code", T.StringType()),
    ("stock_name", T.StringType()),
    ("stock_region", T.StringType()),
    ("stock_reorder_point", T.IntegerType()),
    ("stock_last_restocked", T.TimestampNTZType()),
    ("supplier_name", T.StringType()),
    ("supplier_contact", T.StringType()),
    ("supplier_lead_time_days", T.IntegerType()),
    ("reviews_created_at", T.TimestampNTZType()),
    ("reviews_updated_at", T.TimestampNTZType()),
    ("reviews_rating", T.DoubleType()),
    ("reviews_review_count", T.IntegerType()),
    ("reviews_tags", T.StringType()),
    ("shipping_free_shipping", T.BooleanType()),
    ("shipping_estimated_days", T.StringType()),
    ("shipping_weight", T.StringType()),
]
FLAT_COLUMNS = [n for n, _ in RAW_FIELDS]
RAW_COLUMNS = FLAT_COLUMNS + ["ingestion_time"]
FLAT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])
RAW_SCHEMA = T.StructType(FLAT_SCHEMA.fields + [T.StructField("ingestion_time", T.TimestampNTZType(), True)])

# Raw -> staging renames; all other raw columns pass through.
STG_RENAMES = {
    "sku": "product_id",
    "name": "product_name",
    "description": "product_description",
    "category": "product_category",
    "brand": "product_brand",
    "condition": "product_condition",
    "sale": "sale_price",
    "stock_code": "warehouse_code",
    "stock_name": "warehouse_name",
    "stock_region": "warehouse_region",
    "stock_reorder_point": "reorder_point",
    "supplier_lead_time_days": "lead_time_days",
    "reviews_rating": "rating",
    "reviews_review_count": "review_count",
}
STG_COLUMNS = [STG_RENAMES.get(c, c) for c in RAW_COLUMNS]
STG_KEY = ["product_id", "ingestion_time"]

# Columns the signal model reads from staging, in output order.
INT_SOURCE_COLUMNS = [
    "product_id", "product_name", "product_category", "product_brand",
    "stock_quantity", "stock_status", "reorder_point", "warehouse_code", "warehouse_region",
    "supplier_name", "lead_time_days",
    "msrp", "sale_price", "discount",
    "rating", "review_count",
    "ingestion_time", "stock_last_restocked",
]
INT_SIGNAL_COLUMNS = [
    "days_since_last_restock", "normalized_stock_status", "alert_flag", "in_stock_risk_flag",
    "backorder_delay_flag", "restock_staleness_flag", "high_demand_flag", "inventory_risk_flag",
]
INT_COLUMNS = INT_SOURCE_COLUMNS + INT_SIGNAL_COLUMNS
INT_KEY = ["product_id", "warehouse_region", "ingestion_time"]

FCT_COLUMNS = [
    "product_id", "supplier_name", "date_key", "stock_quantity", "reorder_point",
    "normalized_stock_status", "msrp", "sale_price", "discount",
    "alert_flag", "in_stock_risk_flag", "backorder_delay_flag", "high_demand_flag",
    "inventory_risk_flag", "ingestion_time", "days_since_last_restock",
    "lead_time_days", "warehouse_region",
]
FCT_KEY = ["product_id", "ingestion_time"]

DIM_PRODUCTS_COLUMNS = ["product_id", "product_name", "product_category", "product_brand"]
DIM_SUPPLIERS_COLUMNS = ["supplier_name", "supplier_contact", "lead_time_days"]
DIM_DATES_COLUMNS = ["date_key", "full_date", "day", "month", "year", "day_of_week"]

# Asserted value domains.
STOCK_STATUS_VALUES = ["In Stock", "Out of Stock", "Low Stock", "Backordered", "Discontinued"]
NORMALIZED_STATUS_VALUES = ["IN_STOCK", "OUT_OF_STOCK", "LOW_STOCK", "BACKORDER", "DISCONTINUED"]
RISK_VALUES = ["HIGH_RISK", "MEDIUM_RISK", "LOW_RISK"]

# Partition column of every layer table (derived from ingestion_time).
PARTITION_COLUMN = "ingestion_date"
