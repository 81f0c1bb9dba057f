"""Report queries over the marts (what the dashboard reads).

Top-k reports are ``orderBy(..).limit(k)``, which Spark plans as
``TakeOrderedAndProject``: every task keeps its own k best rows and only those
reach the final merge, so the cost is one scan with no full sort or shuffle.
Ties are broken explicitly and NULL placement is always written, so every
engine returns the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.columns import agg_money

TOP_K = 10


def report_sales_trend(sales_by_day: DataFrame) -> DataFrame:
    return sales_by_day.select("order_date", "total_sales").orderBy(F.col("order_date").asc_nulls_last())


def report_top_products(sales_by_product: DataFrame, k: int = TOP_K) -> DataFrame:
    return (
        sales_by_product.select("product_id", "product_name", "total_sales")
        .orderBy(F.col("total_sales").desc_nulls_last(), F.col("product_id").asc_nulls_last())
        .limit(k)
    )


def report_top_store_days(sales_by_store: DataFrame, k: int = TOP_K) -> DataFrame:
    """The original "top stores" chart: rows of the store x day table, so one
    store may take several places."""
    return (
        sales_by_store.select("store_id", "store_name", "order_date", "total_orders", "total_sales")
        .orderBy(F.col("total_orders").desc_nulls_last(), F.col("total_sales").desc_nulls_last(),
                 F.col("store_id").asc_nulls_last(), F.col("order_date").asc_nulls_last())
        .limit(k)
    )


def report_top_stores(sales_by_store: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top stores by order count summed over all days (one place per store)."""
    per_store = sales_by_store.groupBy("store_id", "store_name").agg(
        F.sum("total_orders").alias("total_orders"),
        agg_money(F.sum("total_sales")).alias("total_sales"))
    return (
        per_store.orderBy(F.col("total_orders").desc_nulls_last(), F.col("total_sales").desc_nulls_last(),
                          F.col("store_id").asc_nulls_last())
        .limit(k)
    )


def report_top_customers(customer_profile: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top spenders (spend > 0, which also removes customers without orders),
    re-sorted ascending for display."""
    top = (
        customer_profile.where(F.col("lifetime_spend") > 0)
        .select("customer_id", "lifetime_spend")
        .orderBy(F.col("lifetime_spend").desc_nulls_last(), F.col("customer_id").asc_nulls_last())
        .limit(k)
    )
    return top.orderBy(F.col("lifetime_spend").asc_nulls_last(), F.col("customer_id").desc_nulls_last())


def report_order_status(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("count_status"))


def report_status_share(fact_orders: DataFrame) -> DataFrame:
    """Count and share of total per status.

    The total is a one-row aggregate of the counts (a scalar subquery), so no
    task holds all rows whatever the number of statuses.
    """
    counts = report_order_status(fact_orders)
    return counts.sparkSession.sql(
        "SELECT order_status, count_status, CAST(count_status AS DOUBLE) / "
        "CAST((SELECT SUM(count_status) FROM {counts}) AS DOUBLE) AS share FROM {counts}", counts=counts)
