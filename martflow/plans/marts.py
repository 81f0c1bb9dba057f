"""The aggregated marts as maintained states: which rows feed them, and how a state becomes the mart.

A state holds one row per group with the measures of the mart and nothing of a
dimension; attributes are joined when the mart is written, so a changed
dimension row costs a pass over the groups and none over the facts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.columns import day_start
from martflow.operators.maintain import ROWS, Measures

ORDER_SUMS = {"total_sales": "total_amount", "total_discounts": "discount_amount", "total_shipping": "shipping_cost"}


@dataclass(frozen=True)
class Mart:
    fact: str
    dimension: str | None
    measures: Measures
    prepare: Callable[[DataFrame], DataFrame]  # fact rows -> keys and inputs
    finish: Callable[[DataFrame, DataFrame | None], DataFrame]  # state, dimension -> mart


def _with_day(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_date", day_start("created_at"))


def _by_day(state: DataFrame, _) -> DataFrame:
    return state.select("order_date", F.col(ROWS).alias("total_orders"), *ORDER_SUMS)


def _by_store(state: DataFrame, stores: DataFrame) -> DataFrame:
    store = stores.select(F.col("store_id").alias("_id"), "store_name", "store_type")
    return state.join(store, F.col("store_id") == F.col("_id"), "left").select(
        "store_id", "store_name", "store_type", "order_date", F.col(ROWS).alias("total_orders"), *ORDER_SUMS)


def _by_product(state: DataFrame, products: DataFrame) -> DataFrame:
    product = products.select(F.col("product_id").alias("_id"), "product_name", "category", "brand", "price")
    return state.join(product, F.col("product_id") == F.col("_id"), "left").select(
        "product_id", "product_name", "category", "brand", "price", F.col(ROWS).alias("total_items_sold"),
        "total_sales", "total_discounts")


def _profile(state: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = state.withColumnRenamed("customer_id", "_id")
    return customers.join(per_customer, F.col("customer_id") == F.col("_id"), "left").select(
        "customer_id", "first_name", "last_name", F.col("country").alias("customer_country"),
        F.coalesce(ROWS, F.lit(0).cast("long")).alias("total_orders"), "lifetime_spend", "first_order_date", "last_order_date")


MARTS = {
    "sales_by_day": Mart("fact_orders", None, Measures(("order_date",), ORDER_SUMS), _with_day, _by_day),
    "sales_by_store": Mart("fact_orders", "dim_store", Measures(("store_id", "order_date"), ORDER_SUMS), _with_day, _by_store),
    "sales_by_product": Mart("fact_orderitems", "dim_product",
                             Measures(("product_id",), {"total_sales": "line_total", "total_discounts": "line_discount"}),
                             lambda items: items, _by_product),
    "customer_profile": Mart("fact_orders", "dim_customer",
                             Measures(("customer_id",), {"lifetime_spend": "total_amount"},
                                      {"first_order_date": "created_at"}, {"last_order_date": "created_at"}),
                             lambda orders: orders, _profile),
}
