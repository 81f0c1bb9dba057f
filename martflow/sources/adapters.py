"""Driver tables -> the five landed entities, with deterministic dirt.

The warehouse lands customers, products, stores, orders and order items.  The
driver ships TPC-H-like tables instead, so these adapters map them onto the
entity schemas and inject the kinds of dirt the pipeline must survive (NULL
names, negative amounts, NULL quantities, repeated versions, missing
dimension rows).  The dirt is a pure function of the key, so every engine
that follows the same rules produces the same staged rows.

Keys stay ``long``; amounts are cast from double to decimal *before* any
arithmetic so sums are exact.  Extra versions of a row are produced with one
``explode`` over a version array instead of a self-union, so each source
table is scanned and joined once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.columns import SUM_DIGITS, money, sum_of_units, unscaled
from martflow.functions.partitions import by_key
from martflow.sources.driver import DriverTables

# Fixed values of the adapter contract (they define the test fixtures).
BASE_CREATED_AT = "1995-01-01 00:00:00"
NEGATE_ITEMS_MOD = 89        # order key % 89 == 0: quantity and line_total negated
NULL_QUANTITY_MOD = 97       # order key % 97 == 0 (and not % 89): quantity NULL
NEGATE_TOTAL_MOD = 83        # order key % 83 == 0: total_amount negated
NULL_TOTAL_MOD = 79          # order key % 79 == 0 (and not % 83): total_amount NULL
REVISED_ORDER_MOD = 50       # order key % 50 == 0: second version, status 'R', +1 day
REVISED_ORDER_STATUS = "R"
NULL_FIRST_NAME = (100, 1)   # customer key % 100 == 1: first_name NULL
NULL_LAST_NAME = (100, 2)    # customer key % 100 == 2: last_name NULL
CHANGED_CUSTOMER_MOD = 20    # customer key % 20 == 0: version 'CHANGED' at +30 days
CHANGED2_CUSTOMER_MOD = 40   # customer key % 40 == 0: also 'CHANGED2' at +60 days
CHANGED_LAST_NAMES = ("CHANGED", "CHANGED2")
CHANGE_STEP_DAYS = 30
INVALID_NEWEST_MOD = 80      # customer key % 80 == 0: first_name of version 'CHANGED2' NULL
COPIED_CUSTOMER = (50, 3)    # customer key % 50 == 3: exact copy loaded an hour later
NULL_KEY_MOD = 500           # order key % 500 == 0: one more order row without order_id
NEGATIVE_PRICE_MOD = 100     # product key % 100 == 0: price negated
CHANGED_PRODUCT_MOD = 30     # product key % 30 == 0: second version at +30 days, price + 1
CHANGED_STORE_MOD = 5        # supplier key % 5 == 0: second version at +30 days, name + ' V2'
CHANGED_STORE_SUFFIX = " V2"
ABSENT_STORE = (25, 7)       # supplier key % 25 == 7: store row absent
ONLINE, BRICK = "Online", "Brick and Mortar"


def _ts(literal: str) -> Column:
    return F.lit(literal).cast(T.TimestampNTZType())


def _null_str() -> Column:
    return F.lit(None).cast(T.StringType())


def _line_money(precision):
    """Per-line amounts shared by the item and order adapters."""
    ext = money("l_extendedprice", precision)
    negated = (F.col("l_orderkey") % NEGATE_ITEMS_MOD) == 0
    line_total = F.when(negated, -ext).otherwise(ext)
    line_discount = (ext * money("l_discount", precision)).cast(T.DecimalType(*precision))
    return negated, line_total, line_discount


def staged_orderitems(t: DriverTables, precision=(12, 2)) -> DataFrame:
    """lineitem (+ part price) -> order items; one row per driver line.

    ``line_number`` is kept as the final tie-break of the per-pair dedup.
    """
    # amounts as decimals take half of what doubles do in the exchange of a large join
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast(T.IntegerType()).alias("l_quantity"),
                           *[money(c, precision).alias(c) for c in ("l_extendedprice", "l_discount")], "l_shipdate")
    # one row per key, visibly so: a query that drops the price drops this join
    part = t.part.groupBy("p_partkey").agg(F.max("p_retailprice").alias("p_retailprice"))
    negated, line_total, line_discount = _line_money(precision)
    qty = F.col("l_quantity")
    null_qty = (F.col("l_orderkey") % NULL_QUANTITY_MOD) == 0
    return (
        li.join(part, li.l_partkey == part.p_partkey, "left")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.when(negated, -qty).when(null_qty, F.lit(None).cast(T.IntegerType()))
             .otherwise(qty).alias("quantity"),
            money("p_retailprice", precision).alias("unit_price"),
            line_total.alias("line_total"),
            line_discount.alias("line_discount"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("ingestion_ts"),
            F.col("l_linenumber").alias("line_number"),
        )
    )


def staged_orders(t: DriverTables, precision=(12, 2)) -> DataFrame:
    """orders (+ a roll-up of their lines) -> order headers, revised versions included.

    store_id = smallest supplier of the order's lines, discount = sum of line
    discounts, shipping = sum(line_total * tax); all NULL for orders without
    lines.  The line roll-up is a hash aggregate on the order key, joined 1:1 to
    the orders.  The lines of a large table are dealt by that key first: those of
    an order need not lie together, so a task that combined its split before the
    exchange could hold one entry for each of its lines.
    """
    dec = T.DecimalType(*precision)
    _, line_total, line_discount = _line_money(precision)
    shipping = line_total * money("l_tax", precision)
    discount_sum, shipping_sum = F.sum("_discount"), F.sum("_shipping")
    if precision[0] <= SUM_DIGITS:
        discount_sum, shipping_sum = sum_of_units("_discount", precision[1]), sum_of_units("_shipping", 2 * precision[1])
        line_discount, shipping = unscaled(line_discount, precision[1]), unscaled(shipping, 2 * precision[1])
    lines = (
        by_key(t.lineitem.select("l_orderkey", "l_suppkey", line_discount.alias("_discount"), shipping.alias("_shipping")), "l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("store_id"),
             discount_sum.alias("discount_sum"),
             shipping_sum.alias("shipping_sum"))
    )
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                        "o_orderdate", "o_orderpriority")
    key = F.col("o_orderkey")
    total = money("o_totalprice", precision)
    revised = (key % REVISED_ORDER_MOD) == 0
    # version 2 is the row without a key
    versions = F.concat(F.array(F.lit(0)), F.when(revised, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")),
                        F.when(key % NULL_KEY_MOD == 0, F.array(F.lit(2))).otherwise(F.array().cast("array<int>")))
    shift = F.make_dt_interval(days=F.when(F.col("_v") == 1, 1).otherwise(0))
    return (
        o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
        .withColumn("_v", F.explode(versions))
        .select(
            F.when(F.col("_v") != 2, key).alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("store_id"),
            F.when(F.col("_v") == 1, F.lit(REVISED_ORDER_STATUS))
             .otherwise(F.col("o_orderstatus")).alias("order_status"),
            F.when(key % NEGATE_TOTAL_MOD == 0, -total)
             .when(key % NULL_TOTAL_MOD == 0, F.lit(None).cast(dec))
             .otherwise(total).alias("total_amount"),
            F.col("discount_sum").cast(dec).alias("discount_amount"),
            F.col("shipping_sum").cast(dec).alias("shipping_cost"),
            F.col("o_orderpriority").alias("payment_type"),
            (F.col("o_orderdate") + shift).alias("created_at"),
            (F.col("o_orderdate") + shift).alias("ingestion_ts"),
        )
    )


def staged_customers(t: DriverTables) -> DataFrame:
    """customer (+ nation name) -> customers, with NULL names and changed versions."""
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    versions = (
        F.when(key % CHANGED2_CUSTOMER_MOD == 0, F.array(F.lit(0), F.lit(1), F.lit(2)))
        .when(key % CHANGED_CUSTOMER_MOD == 0, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))
    )
    # version 3 is the copy of version 0
    versions = F.concat(versions, F.when(key % COPIED_CUSTOMER[0] == COPIED_CUSTOMER[1], F.array(F.lit(3)))
                        .otherwise(F.array().cast("array<int>")))
    v = F.col("_v") % 3
    created = F.date_add(_ts(BASE_CREATED_AT).cast(T.DateType()), v * CHANGE_STEP_DAYS) \
        .cast(T.TimestampNTZType())
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .withColumn("_v", F.explode(versions))
        .select(
            key.alias("customer_id"),
            F.when((key % NULL_FIRST_NAME[0] == NULL_FIRST_NAME[1]) | ((v == 2) & (key % INVALID_NEWEST_MOD == 0)), _null_str())
             .otherwise(F.col("c_name")).alias("first_name"),
            F.when(v == 1, F.lit(CHANGED_LAST_NAMES[0]))
             .when(v == 2, F.lit(CHANGED_LAST_NAMES[1]))
             .when(key % NULL_LAST_NAME[0] == NULL_LAST_NAME[1], _null_str())
             .otherwise(F.col("c_mktsegment")).alias("last_name"),
            _null_str().alias("email"),
            _null_str().alias("phone_number"),
            _null_str().alias("address"),
            _null_str().alias("city"),
            _null_str().alias("state_province"),
            F.col("n_name").alias("country"),
            _null_str().alias("postal_code"),
            created.alias("created_at"),
            (created + F.make_dt_interval(hours=F.when(F.col("_v") == 3, 1).otherwise(0))).alias("ingestion_ts"),
        )
    )


def price_type(precision) -> T.DecimalType:
    return T.DecimalType(*precision)


def staged_products(t: DriverTables, precision=(12, 2)) -> DataFrame:
    p = t.part.select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    key = F.col("p_partkey")
    price = money("p_retailprice", precision)
    changed = F.when(key % CHANGED_PRODUCT_MOD == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    created = (_ts(BASE_CREATED_AT) + F.make_dt_interval(days=F.col("_v") * CHANGE_STEP_DAYS))
    return p.withColumn("_v", F.explode(changed)).select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        (F.when(key % NEGATIVE_PRICE_MOD == 0, -price).otherwise(price) + F.col("_v")).cast(price_type(precision)).alias("price"),
        created.alias("created_at"),
        created.alias("ingestion_ts"),
    )


def staged_stores(t: DriverTables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    key = F.col("s_suppkey")
    return (
        s.where(key % ABSENT_STORE[0] != ABSENT_STORE[1])
        .join(n, s.s_nationkey == n.n_nationkey, "left")
        .withColumn("_v", F.explode(F.when(key % CHANGED_STORE_MOD == 0, F.array(F.lit(0), F.lit(1)))
                                    .otherwise(F.array(F.lit(0)))))
        .withColumn("_at", _ts(BASE_CREATED_AT) + F.make_dt_interval(days=F.col("_v") * CHANGE_STEP_DAYS))
        .select(
            key.alias("store_id"),
            F.when(F.col("_v") == 1, F.concat("s_name", F.lit(CHANGED_STORE_SUFFIX))).otherwise(F.col("s_name"))
             .alias("store_name"),
            F.when(key % 2 == 0, F.lit(ONLINE)).otherwise(F.lit(BRICK)).alias("store_type"),
            _null_str().alias("city"),
            _null_str().alias("state_province"),
            F.col("n_name").alias("country"),
            _null_str().alias("postal_code"),
            F.col("_at").alias("created_at"),
            F.col("_at").alias("ingestion_ts"),
        )
    )


STAGED = {
    "orders": staged_orders,
    "orderitems": staged_orderitems,
    "customers": staged_customers,
    "products": staged_products,
    "stores": staged_stores,
}
