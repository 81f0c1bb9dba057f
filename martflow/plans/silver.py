"""Silver models: dimensions (full rebuild) and facts (incremental upsert).

Each function takes the staged DataFrame and returns the model; no I/O.
Filters that drop invalid rows are applied *before* ranking, so an invalid
newest version falls back to the previous valid one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from martflow.functions.columns import composite_key
from martflow.operators.clean import clamp, newer_than, require, require_positive
from martflow.operators.dedupe import latest_per_key
from martflow.schemas import (
    DIM_CUSTOMER_COLS,
    DIM_PRODUCT_COLS,
    DIM_STORE_COLS,
    FACT_ORDERITEMS_COLS,
    FACT_ORDERS_COLS,
)

ORDER_AMOUNTS = ["total_amount", "discount_amount", "shipping_cost"]
ITEM_AMOUNTS = ["quantity", "unit_price", "line_total", "line_discount"]

# Columns that can tell apart two rows of one key, version time and load stamp.
# Only these stay live below the ranking window: columns that follow from the
# key (an order's store and line sums, a product's price) are not among them,
# so queries that don't return them prune their sources.
ORDER_TIES = ["customer_id", "order_status", "total_amount", "payment_type"]
ITEM_TIES = ["quantity", "line_total", "line_discount", "line_number"]



def derived_columns(fact: str) -> dict[str, Column]:
    """Columns of a fact that follow from others of the same row, and how."""
    return {"order_product_key": composite_key("order_id", "product_id")} if fact == "fact_orderitems" else {}


def _tiebreak(df: DataFrame, exclude) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def dim_customer(stg_customers: DataFrame) -> DataFrame:
    df = require(stg_customers, ["first_name", "last_name", "customer_id"])
    df = latest_per_key(df, ["customer_id"],
                        tiebreak=_tiebreak(df, {"customer_id", "created_at", "ingestion_ts"}))
    return df.select(*DIM_CUSTOMER_COLS)


def dim_product(stg_products: DataFrame) -> DataFrame:
    df = require_positive(require(stg_products, ["product_id"]), "price")
    df = latest_per_key(df, ["product_id"],
                        tiebreak=_tiebreak(df, {"product_id", "created_at", "ingestion_ts"}))
    return df.select(*DIM_PRODUCT_COLS)


def dim_store(stg_stores: DataFrame) -> DataFrame:
    df = require(stg_stores, ["store_id"])
    df = latest_per_key(df, ["store_id"],
                        tiebreak=_tiebreak(df, {"store_id", "created_at", "ingestion_ts"}))
    return df.select(*DIM_STORE_COLS)


def fact_orders(stg_orders: DataFrame, hwm=None, newest=latest_per_key) -> DataFrame:
    """Clean, keep the newest version per order, then (incremental runs) keep
    only orders newer than the target's high-water mark.

    The mark filter is applied *before* the window: for non-NULL created_at the
    newest row of a key passes iff any row of it passes, so the result is the
    same and the window only sees the new batch.  ``newest`` finds the newest
    version per order; ``latest_of_repeated`` is for stored tables.
    """
    df = require(stg_orders, ["order_id"])
    if hwm is not None:
        df = newer_than(df, hwm)
    df = clamp(df, ORDER_AMOUNTS)
    df = newest(df, ["order_id"], tiebreak=ORDER_TIES)
    return df.select(*FACT_ORDERS_COLS)


def fact_orderitems(stg_orderitems: DataFrame, hwm=None, newest=latest_per_key) -> DataFrame:
    df = require(stg_orderitems, ["order_id", "product_id"])
    if hwm is not None:
        df = newer_than(df, hwm)
    df = clamp(df, ITEM_AMOUNTS)
    df = newest(df, ["order_id", "product_id"], tiebreak=[c for c in ITEM_TIES if c in df.columns])
    df = df.withColumns(derived_columns("fact_orderitems"))
    return df.select(*FACT_ORDERITEMS_COLS)
