"""Adapter from the TPC-H-style driver tables to ``raw.products`` snapshots.

The driver tables hold no product snapshots, so each lineitem becomes one
snapshot of product ``l_partkey`` taken at ``l_shipdate``:

* product: part (name, type as category, brand, size as reorder point)
* stock: quantity, a status decoded from (returnflag, linestatus), the
  supplier's nation as warehouse and its region as warehouse region
* supplier: name, a contact derived from it, lead time from the supplier key
* reviews: rating and review count derived from the part
* ingestion_time = ship date, stock_last_restocked = order date

The same mapping is written as SQL in ``shelfwise.plans.oracle`` so DuckDB can
rebuild identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.schemas import RAW_COLUMNS
from shelfwise.sources.landing import TIMESTAMP_OUT_FORMAT

def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def stock_status_from_flags(returnflag: str = "l_returnflag", linestatus: str = "l_linestatus"):
    rf, ls = F.col(returnflag), F.col(linestatus)
    return (F.when((rf == "N") & (ls == "O"), F.lit("In Stock"))
            .when(rf == "N", F.lit("Low Stock"))
            .when((rf == "A") & (ls == "F"), F.lit("Out of Stock"))
            .when(rf == "A", F.lit("Backordered"))
            .when(ls == "O", F.lit("Discontinued"))
            .otherwise(F.lit(None).cast("string")))


def raw_products(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """All lineitems as raw product snapshots (29 raw columns). ``together`` is for models that choose rows by
    product: parts are merged by SKU, however few they are, so snapshots of a product come out in one
    partition and what groups or joins them by SKU shuffles no more."""
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])

    # Orders grow with the lineitems, so they are always merged: a plan that broadcasts them holds on small tables
    # only. For the rest Spark decides from sizes; it splits skewed keys. Suppliers are joined one table at a time, so
    # that it sees their own size, and before the parts, so that no later shuffle takes products apart again.
    sku_of = lambda key: F.concat(F.lit("SKU-"), F.col(key).cast("string"))
    j = (li.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
           .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
           .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
           .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
           .withColumn("sku", sku_of("l_partkey")))
    if together:
        j = j.join(part.withColumn("p_sku", sku_of("p_partkey")).hint("merge"), F.col("sku") == F.col("p_sku"))
    else:
        j = j.join(part, F.col("l_partkey") == F.col("p_partkey"))

    out = j.select(
        F.col("sku"),
        F.col("p_name").alias("name"),
        F.concat(F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(")")).alias("description"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("o_orderpriority").alias("condition"),
        F.col("l_extendedprice").alias("msrp"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("sale"),
        (F.col("l_discount") * F.lit(100.0)).alias("discount"),
        F.lit("USD").alias("currency"),
        F.col("l_quantity").cast("int").alias("stock_quantity"),
        stock_status_from_flags().alias("stock_status"),
        F.concat(F.lit("WH-"), F.col("n_name")).alias("stock_code"),
        F.concat(F.col("n_name"), F.lit(" Distribution Center")).alias("stock_name"),
        F.col("r_name").alias("stock_region"),
        F.col("p_size").alias("stock_reorder_point"),
        F.col("o_orderdate").alias("stock_last_restocked"),
        F.col("s_name").alias("supplier_name"),
        F.concat(F.lit("orders@"), F.lower(F.col("s_name"))).alias("supplier_contact"),
        (F.col("l_suppkey") % 30).cast("int").alias("supplier_lead_time_days"),
        F.col("o_orderdate").alias("reviews_created_at"),
        F.col("l_shipdate").alias("reviews_updated_at"),
        (F.lit(1.0) + (F.col("p_size") % 9) * F.lit(0.5)).alias("reviews_rating"),
        ((F.col("p_partkey") * 37) % 3000).cast("int").alias("reviews_review_count"),
        F.concat(F.lit("flag-"), F.lower(F.col("l_returnflag")), F.lit(", status-"),
                 F.lower(F.col("l_linestatus"))).alias("reviews_tags"),
        (F.col("l_tax") < F.lit(0.04)).alias("shipping_free_shipping"),
        F.concat((F.col("l_linenumber") + 1).cast("string"), F.lit("-"),
                 (F.col("l_linenumber") + 4).cast("string"), F.lit(" business days")).alias("shipping_estimated_days"),
        F.concat((F.col("p_size") * 10).cast("string"), F.lit("g")).alias("shipping_weight"),
        F.col("l_shipdate").alias("ingestion_time"),
    )
    return out.select(*RAW_COLUMNS)


# -- stand-in input with faults ------------------------------------------------------

def fault_number(modulus: int = 40) -> Column:
    """Which fault a snapshot gets, dealt by a hash of three of its numbers; those without one of that number get none."""
    return (F.col("stock_quantity") * 31 + F.col("stock_reorder_point") * 7 + F.col("supplier_lead_time_days")) % modulus


def _members(text: Column) -> Column:
    """The members of a JSON object given as text, without its braces; NULL if it has none. Cut as bytes: characters
    would be counted through the whole text, several times."""
    raw = text.cast("binary")
    return F.when(F.length(raw) > 2, F.substring(raw, F.lit(2), F.length(raw) - 2).cast("string"))


def faulty_envelopes(raw: DataFrame) -> DataFrame:
    """Envelopes as JSON text (``value``), one fault in each of some: wrong
    shapes, missing and null members, values of other types, broken text."""
    k, c = F.col("k"), F.col
    raw = raw.withColumn("k", fault_number())
    at = lambda name: F.date_format(name, TIMESTAMP_OUT_FORMAT)
    on = lambda n, text, other: F.when(k == n, F.lit(text)).otherwise(other)
    gone = lambda ns, col: F.when(~k.isin(*ns), col)
    json = lambda *columns: F.to_json(F.struct(*columns))

    sku = on(2, '{"sku":null}', gone([1], json(c("sku"))))
    plain = json(c("name"), c("description"), c("condition"))
    category = on(21, '{"category":""}', gone([19], json(c("category"))))
    brand = on(19, '{"brand":null}', json(c("brand")))
    price = F.when(k == 20, json(F.struct("msrp", "sale", F.lit("").alias("discount"), F.lit(0).alias("currency")).alias("price")))
    price = on(3, '{"price":null}', gone([4], price.otherwise(json(F.struct("msrp", "sale", "discount", "currency").alias("price")))))

    def stock_of(quantity: Column, last: Column, place: Column) -> Column:
        return json(F.struct(quantity.alias("quantity"), c("stock_status").alias("status"), place.alias("warehouse"),
                                 gone([19], c("stock_reorder_point")).alias("reorderPoint"), last.alias("lastRestocked")).alias("stock"))

    place = F.struct(c("stock_code").alias("code"), c("stock_name").alias("name"), gone([19], c("stock_region")).alias("region"))
    last = at("stock_last_restocked")
    stock = (F.when(k == 5, F.lit('{"stock":[1]}')).when(k == 6, stock_of(c("stock_quantity"), last, F.lit("x")))
             .when(k == 15, stock_of(F.lit(1.5), last, place)).when(k == 16, stock_of(c("stock_quantity"), F.lit("soon"), place))
             .when(k == 22, stock_of(c("stock_quantity").cast("string"), last, place)).when(k == 25, F.lit(None))
             .otherwise(stock_of(c("stock_quantity"), last, place)))
    supplier = json(F.struct(c("supplier_name").alias("name"), c("supplier_contact").alias("contact"),
                                 gone([19], c("supplier_lead_time_days")).alias("leadTimeDays")).alias("supplier"))
    supplier = on(7, '{"supplier":5}', gone([27], supplier))

    def reviews_of(tags: Column) -> Column:
        return json(F.struct(at("reviews_created_at").alias("createdAt"), at("reviews_updated_at").alias("updatedAt"),
                                 gone([19], c("reviews_rating")).alias("rating"), gone([19], c("reviews_review_count")).alias("reviewCount"),
                                 tags.alias("tags")).alias("reviews"))

    reviews = (F.when(k == 8, F.lit('{"reviews":null}')).when(k == 17, reviews_of(F.array(F.lit(1)))).when(k == 18, reviews_of(F.lit("plain text")))
               .when(k == 24, F.lit(None)).otherwise(reviews_of(F.split("reviews_tags", ", "))))
    shipping = F.when(k == 20, json(F.struct(F.lit("").alias("freeShipping")).alias("shipping")))
    shipping = on(9, '{"shipping":"none"}', shipping.otherwise(json(F.struct(
        c("shipping_free_shipping").alias("freeShipping"), c("shipping_estimated_days").alias("estimatedDays"),
        c("shipping_weight").alias("weight")).alias("shipping"))))

    # Texts first, as columns of their own: taking the braces off uses each one several times.
    texts = {"sku": sku, "plain": plain, "category": category, "brand": brand, "price": price, "stock": stock, "supplier": supplier,
             "reviews": reviews, "shipping": shipping, "meta": json(F.struct(at("ingestion_time").alias("generatedAt")).alias("meta"))}
    raw = raw.select("k", *(text.alias(f"json_{name}") for name, text in texts.items()))
    members = {name: _members(c(f"json_{name}")) for name in texts}
    meta = members.pop("meta")

    product = F.concat(F.lit("{"), F.concat_ws(",", *members.values()), F.lit("}"))
    item = F.when(k == 10, F.lit("{}")).when(k == 11, F.lit('"item"')).otherwise(product)
    data = F.when(k == 12, item).when(k == 14, F.lit("[]")).otherwise(F.concat(F.lit("["), item, F.lit("]")))
    text = F.concat(F.lit("{"), F.concat_ws(",", meta, gone([13], F.concat(F.lit('"data":'), data))), F.lit("}"))
    return raw.select(F.when(k == 23, F.lit('{"meta":')).otherwise(text).alias("value"))


def odd_numbers(raw: DataFrame) -> DataFrame:
    """Snapshots whose numbers are text, as foreign files bring them: some
    prices say ``n/a``, some review counts ``1e3``."""
    k = fault_number(20)
    return raw.select("sku", "ingestion_time", F.when(k == 0, F.lit("n/a")).otherwise(F.col("msrp").cast("string")).alias("msrp"),
                      F.col("stock_quantity").cast("string").alias("stock_quantity"),
                      F.when(k == 1, F.lit("1e3")).otherwise(F.col("reviews_review_count").cast("string")).alias("reviews_review_count"))
