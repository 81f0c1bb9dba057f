"""Gold marts over the silver facts and dimensions.

Plan choices (all declarative, Catalyst/AQE do the physical work):

* Aggregate *before* joining a dimension.  The dimensions are unique per key
  (checked by the quality suite), so grouping by key (x day) and then looking
  up the attributes gives the same rows as the join-then-group of the original
  models, while the join input shrinks from one row per order to one row per
  group and partial (map-side) aggregation absorbs hot keys.
* ``COUNT(DISTINCT order_id)`` over ``fact_orders`` is ``COUNT(order_id)``:
  the fact is unique per order by construction (latest-per-key), which saves
  the two extra shuffles of a distinct aggregate.  The same holds for
  ``COUNT(DISTINCT product_id)`` per order over ``fact_orderitems``.
* Dimension joins are plain equi-joins.  AQE turns them into broadcast joins
  once the dimension's *measured* size is under the threshold and otherwise
  keeps a sort-merge join with skew splitting, so nothing unbounded is ever
  broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.columns import day_start, money_sum

FCT_SALES_COLS = [
    "order_id", "order_status", "total_amount", "discount_amount", "shipping_cost",
    "payment_type", "order_created_at", "customer_id", "first_name", "last_name",
    "customer_country", "store_id", "store_name", "store_country",
    "total_line_amount", "total_line_discount", "distinct_products",
]


def order_item_rollup(fact_orderitems: DataFrame) -> DataFrame:
    """Per-order roll-up of the lines (partial + final hash aggregate)."""
    return fact_orderitems.groupBy("order_id").agg(
        money_sum(fact_orderitems, "line_total").alias("total_line_amount"),
        money_sum(fact_orderitems, "line_discount").alias("total_line_discount"),
        F.count("product_id").alias("distinct_products"),
    )


def _null_salt(key: str) -> Column:
    """0 for a key, a hash of the order for NULL: rows without a key match
    nothing, and a second join column deals them to all tasks instead of one."""
    return F.when(F.col(key).isNull(), F.xxhash64("order_id")).otherwise(F.lit(0).cast("long"))


def fct_sales(fact_orders: DataFrame, fact_orderitems: DataFrame,
              dim_customer: DataFrame, dim_store: DataFrame) -> DataFrame:
    items = order_item_rollup(fact_orderitems)
    cust = dim_customer.select(
        F.col("customer_id").alias("_c_id"), F.lit(0).cast("long").alias("_c_salt"), "first_name", "last_name",
        F.col("country").alias("customer_country"))
    store = dim_store.select(
        F.col("store_id").alias("_s_id"), F.lit(0).cast("long").alias("_s_salt"), "store_name",
        F.col("country").alias("store_country"))
    fo = fact_orders.select(
        "order_id", "order_status", "total_amount", "discount_amount", "shipping_cost",
        "payment_type", F.col("created_at").alias("order_created_at"), "customer_id", "store_id")
    out = (
        fo.join(items, "order_id", "left")
        .join(cust, (F.col("customer_id") == F.col("_c_id")) & (_null_salt("customer_id") == F.col("_c_salt")), "left")
        .join(store, (F.col("store_id") == F.col("_s_id")) & (_null_salt("store_id") == F.col("_s_salt")), "left")
    )
    return out.select(*FCT_SALES_COLS)


def sales_by_day(fact_orders: DataFrame) -> DataFrame:
    return (
        fact_orders.groupBy(day_start("created_at").alias("order_date"))
        .agg(F.count("order_id").alias("total_orders"),
             money_sum(fact_orders, "total_amount").alias("total_sales"),
             money_sum(fact_orders, "discount_amount").alias("total_discounts"),
             money_sum(fact_orders, "shipping_cost").alias("total_shipping"))
    )


def sales_by_store(fact_orders: DataFrame, dim_store: DataFrame) -> DataFrame:
    per_store_day = (
        fact_orders.groupBy("store_id", day_start("created_at").alias("order_date"))
        .agg(F.count("order_id").alias("total_orders"),
             money_sum(fact_orders, "total_amount").alias("total_sales"),
             money_sum(fact_orders, "discount_amount").alias("total_discounts"),
             money_sum(fact_orders, "shipping_cost").alias("total_shipping"))
    )
    store = dim_store.select(F.col("store_id").alias("_s_id"), "store_name", "store_type")
    return (
        per_store_day.join(store, F.col("store_id") == F.col("_s_id"), "left")
        .select("store_id", "store_name", "store_type", "order_date", "total_orders",
                "total_sales", "total_discounts", "total_shipping")
    )


def sales_by_product(fact_orderitems: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_product = fact_orderitems.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("total_items_sold"),
        money_sum(fact_orderitems, "line_total").alias("total_sales"),
        money_sum(fact_orderitems, "line_discount").alias("total_discounts"))
    prod = dim_product.select(F.col("product_id").alias("_p_id"), "product_name", "category",
                              "brand", "price")
    return (
        per_product.join(prod, F.col("product_id") == F.col("_p_id"), "left")
        .select("product_id", "product_name", "category", "brand", "price",
                "total_items_sold", "total_sales", "total_discounts")
    )


def customer_profile(dim_customer: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Every valid customer, with order count (0 if none), spend and first/last order.

    Orders of customers missing from the dimension drop out (left side is the
    dimension).  Orders are rolled up per customer before the 1:1 join, so a
    customer with a huge number of orders is absorbed by partial aggregation.
    """
    per_cust = fact_orders.groupBy(F.col("customer_id").alias("_c_id")).agg(
        F.count("order_id").alias("_n"),
        money_sum(fact_orders, "total_amount").alias("lifetime_spend"),
        F.min("created_at").alias("first_order_date"),
        F.max("created_at").alias("last_order_date"))
    dc = dim_customer.select("customer_id", "first_name", "last_name",
                             F.col("country").alias("customer_country"))
    return (
        dc.join(per_cust, F.col("customer_id") == F.col("_c_id"), "left")
        .select("customer_id", "first_name", "last_name", "customer_country",
                F.coalesce(F.col("_n"), F.lit(0).cast("long")).alias("total_orders"),
                "lifetime_spend", "first_order_date", "last_order_date")
    )
