"""Dashboard questions as DataFrame queries over the star schema.

The dashboard reads fact LEFT JOIN dim_products, coerces two numeric columns,
drops rows without supplier or product name, optionally filters one supplier,
and then computes a dozen small aggregates. Here every metric is a Spark
aggregate; only the (small) results would ever be collected.

pandas rules kept: group keys that are NULL are dropped; a group whose values
are all NULL sums to 0; means skip NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HIGH_RISK = "HIGH_RISK"
DIM_ATTRS = ["product_name", "product_category", "product_brand"]


def _sum0(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """``pd.to_numeric(errors='coerce')``: numeric columns stay as they are;
    string columns become DOUBLE with unparseable values as NULL."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    casts = {c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in columns
             if isinstance(types.get(c), T.StringType)}
    return df.withColumns(casts) if casts else df


def star_left_join(fct: DataFrame, dim_products: DataFrame) -> DataFrame:
    """``SELECT f.*, d.product_name, d.product_category, d.product_brand
    FROM fct f LEFT JOIN dim_products d ON f.product_id = d.product_id``.

    The dimension has one row per product, so its size is bounded by the
    product count, not the fact; AQE broadcasts it when the runtime size is
    under the threshold and otherwise keeps a sort-merge join (splitting
    skewed fact partitions)."""
    d = dim_products.select("product_id", *DIM_ATTRS)
    return fct.join(d, on="product_id", how="left").select(*fct.columns, *DIM_ATTRS)


def star_join_using(fct: DataFrame, dim_products: DataFrame) -> DataFrame:
    """``SELECT * FROM fct LEFT JOIN dim_products USING (product_id)``: one
    merged key column first, then the remaining columns of both sides."""
    return fct.join(dim_products, on="product_id", how="left")


def retail_view(fct: DataFrame, dim_products: DataFrame, supplier: str | None = None) -> DataFrame:
    """The cleaned dashboard frame. ``supplier=None`` (or "All") keeps every
    supplier. Dropping NULL product names turns the LEFT join into an inner
    join (Catalyst's outer-join elimination)."""
    df = star_left_join(fct, dim_products)
    df = coerce_numeric(df, ["lead_time_days", "stock_quantity"])
    # ``dropna(subset=...)``; written as IS NOT NULL so Catalyst sees the
    # filter as null-rejecting: the LEFT join becomes an inner join and the
    # product-name filter moves to the dimension side.
    df = df.filter(F.col("supplier_name").isNotNull() & F.col("product_name").isNotNull())
    if supplier is not None and supplier != "All":
        df = df.filter(F.col("supplier_name") == F.lit(supplier))
    return df


# -- Inventory overview ------------------------------------------------------

def kpi_overview(view: DataFrame) -> DataFrame:
    """Distinct products, low-stock (alert) rows, high-risk rows: one pass."""
    return view.agg(
        F.count_distinct("product_name").alias("total_products"),
        F.count_if(F.col("alert_flag")).alias("low_stock_count"),
        F.count_if(F.col("inventory_risk_flag") == HIGH_RISK).alias("high_risk_count"),
    )


def overview_metrics(view: DataFrame) -> DataFrame:
    """Every scalar tile of the dashboard in a single aggregate."""
    return view.agg(
        F.count_distinct("product_name").alias("total_products"),
        F.count_if(F.col("alert_flag")).alias("low_stock_count"),
        F.count_if(F.col("inventory_risk_flag") == HIGH_RISK).alias("high_risk_count"),
        F.avg("lead_time_days").alias("avg_lead_time"),
        F.count_distinct(F.when(F.col("inventory_risk_flag") == HIGH_RISK, F.col("supplier_name")))
         .alias("high_risk_suppliers"),
    )


def status_distribution(view: DataFrame) -> DataFrame:
    """``value_counts()`` of the normalized status, most frequent first."""
    return (view.filter(F.col("normalized_stock_status").isNotNull())
                .groupBy("normalized_stock_status").agg(F.count(F.lit(1)).alias("row_count"))
                .orderBy(F.desc("row_count"), "normalized_stock_status"))


def stock_by_region(view: DataFrame) -> DataFrame:
    return (view.filter(F.col("warehouse_region").isNotNull())
                .groupBy("warehouse_region").agg(_sum0("stock_quantity").alias("total_stock")))


def top_high_risk_products(view: DataFrame, n: int = 10) -> DataFrame:
    """Bottom-n products by summed stock among HIGH_RISK rows (lowest stock =
    most critical first); ties broken by name. Planned as a partial
    aggregate plus ``TakeOrderedAndProject`` (no global sort)."""
    return (view.filter(F.col("inventory_risk_flag") == HIGH_RISK)
                .groupBy("product_name").agg(_sum0("stock_quantity").alias("total_stock"))
                .orderBy("total_stock", "product_name").limit(n))


# -- Supplier analysis ------------------------------------------------------

def avg_lead_time(view: DataFrame) -> DataFrame:
    return view.agg(F.avg("lead_time_days").alias("avg_lead_time"))


def high_risk_suppliers(view: DataFrame) -> DataFrame:
    return (view.filter(F.col("inventory_risk_flag") == HIGH_RISK)
                .agg(F.count_distinct("supplier_name").alias("high_risk_suppliers")))


def supplier_summary(view: DataFrame) -> DataFrame:
    return view.groupBy("supplier_name").agg(
        F.avg("lead_time_days").alias("avg_lead_time"),
        _sum0("stock_quantity").alias("total_stock"),
    )


def supplier_risk_rank(view: DataFrame) -> DataFrame:
    return (view.filter(F.col("inventory_risk_flag") == HIGH_RISK)
                .groupBy("supplier_name").agg(F.count(F.lit(1)).alias("high_risk_count"))
                .orderBy(F.desc("high_risk_count"), "supplier_name"))


def supplier_list(view: DataFrame) -> DataFrame:
    """Sorted distinct suppliers for the filter control ("All" is the UI's)."""
    return view.select("supplier_name").distinct().orderBy("supplier_name")


# -- Demand vs inventory -------------------------------------------------------

DEMAND_COLUMNS = ["product_name", "stock_quantity", "inventory_risk_flag"]


def high_demand_products(view: DataFrame) -> DataFrame:
    return view.filter(F.col("high_demand_flag")).select(*DEMAND_COLUMNS)


def stock_by_risk(view: DataFrame) -> DataFrame:
    return (view.filter(F.col("inventory_risk_flag").isNotNull())
                .groupBy("inventory_risk_flag").agg(_sum0("stock_quantity").alias("total_stock")))


def critical_products(view: DataFrame) -> DataFrame:
    """High demand AND low stock (alert)."""
    return view.filter(F.col("high_demand_flag") & F.col("alert_flag")).select(*DEMAND_COLUMNS)
