"""Entity schemas, layer names and the column contracts of every model.

Landing files are positional CSV: the header row is skipped and columns are
taken by ordinal, so the StructTypes below define both order and type.  The
decimal precision is a parameter: landing files use (6,2) like the original
staging DDL, adapters over the driver tables use (12,2) because order totals
reach about 500k.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LANDING_MONEY = (6, 2)
WIDE_MONEY = (12, 2)
# Aggregated money is reported at one fixed width on every engine.
AGG_MONEY = T.DecimalType(18, 2)


def _money(precision):
    return T.DecimalType(*precision)


def customers_schema(key_type=T.StringType()) -> T.StructType:
    s = T.StringType()
    return T.StructType([
        T.StructField("customer_id", key_type),
        T.StructField("first_name", s),
        T.StructField("last_name", s),
        T.StructField("email", s),
        T.StructField("phone_number", s),
        T.StructField("address", s),
        T.StructField("city", s),
        T.StructField("state_province", s),
        T.StructField("country", s),
        T.StructField("postal_code", s),
        T.StructField("created_at", T.TimestampNTZType()),
    ])


def products_schema(money=LANDING_MONEY, key_type=T.StringType()) -> T.StructType:
    s = T.StringType()
    return T.StructType([
        T.StructField("product_id", key_type),
        T.StructField("product_name", s),
        T.StructField("category", s),
        T.StructField("brand", s),
        T.StructField("price", _money(money)),
        T.StructField("created_at", T.TimestampNTZType()),
    ])


def stores_schema(key_type=T.StringType()) -> T.StructType:
    s = T.StringType()
    return T.StructType([
        T.StructField("store_id", key_type),
        T.StructField("store_name", s),
        T.StructField("store_type", s),
        T.StructField("city", s),
        T.StructField("state_province", s),
        T.StructField("country", s),
        T.StructField("postal_code", s),
        T.StructField("created_at", T.TimestampNTZType()),
    ])


def orders_schema(money=LANDING_MONEY, key_type=T.StringType()) -> T.StructType:
    s = T.StringType()
    m = _money(money)
    return T.StructType([
        T.StructField("order_id", key_type),
        T.StructField("customer_id", key_type),
        T.StructField("store_id", key_type),
        T.StructField("order_status", s),
        T.StructField("total_amount", m),
        T.StructField("discount_amount", m),
        T.StructField("shipping_cost", m),
        T.StructField("payment_type", s),
        T.StructField("created_at", T.TimestampNTZType()),
    ])


def orderitems_schema(money=LANDING_MONEY, key_type=T.StringType()) -> T.StructType:
    m = _money(money)
    return T.StructType([
        T.StructField("order_id", key_type),
        T.StructField("product_id", key_type),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", m),
        T.StructField("line_total", m),
        T.StructField("line_discount", m),
        T.StructField("created_at", T.TimestampNTZType()),
    ])


@dataclass(frozen=True)
class Entity:
    name: str
    keys: tuple[str, ...]
    version_col: str = "created_at"
    load_col: str = "ingestion_ts"


CUSTOMERS = Entity("customers", ("customer_id",))
PRODUCTS = Entity("products", ("product_id",))
STORES = Entity("stores", ("store_id",))
ORDERS = Entity("orders", ("order_id",))
ORDERITEMS = Entity("orderitems", ("order_id", "product_id"))

ENTITIES = {e.name: e for e in (CUSTOMERS, PRODUCTS, STORES, ORDERS, ORDERITEMS)}


@dataclass(frozen=True)
class Layers:
    """Layer -> schema (folder) names; an explicit name wins over the default."""
    staging: str = "staging"
    core: str = "core"
    marts: str = "marts"

    def resolve(self, layer: str, custom: str | None = None) -> str:
        return custom if custom is not None else getattr(self, layer)


# Output columns of the silver and gold models, in order.
DIM_CUSTOMER_COLS = [f.name for f in customers_schema().fields]
DIM_PRODUCT_COLS = [f.name for f in products_schema().fields]
DIM_STORE_COLS = [f.name for f in stores_schema().fields]
FACT_ORDERS_COLS = [f.name for f in orders_schema().fields]
FACT_ORDERITEMS_COLS = [f.name for f in orderitems_schema().fields] + ["order_product_key"]
