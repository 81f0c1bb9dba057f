"""Operator-level queries: each one exercises one operator on the whole staged data.

Incremental scenarios split the staged rows into two *loads* by a data
attribute, never by sampling: load 1 is what an earlier build had seen (orders
up to mid-1996 but those of low priority); load 2 brings newer orders and the
late low-priority ones, or re-scans everything where an operator must find the
new rows itself.  Both loads are processed in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.operators import history, merge, quality
from martflow.operators.clean import clamp, high_water_mark, ts_literal
from martflow.operators.dedupe import latest_per_key, versions_per_key
from martflow.plans import gold, silver
from martflow.plans.warehouse import Warehouse
from martflow.session import cut_lineage
from martflow.sources.bucketed import write_bucketed

# Fixed values of the scenarios.
LATE_PAYMENT_TYPE = "5-LOW"
LOAD1_UNTIL = "1996-06-30 00:00:00"
HIGH_WATER_TEST = "1999-01-01 00:00:00"
SCD2_BATCH_CUTS = ("1995-01-01 00:00:00", "1995-01-31 00:00:00")
HARD_DELETE_NOW = "1995-03-15 00:00:00"


def load1(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.where(in_load1())


def in_load1():
    return (F.col("payment_type") != LATE_PAYMENT_TYPE) & (F.col("created_at") <= ts_literal(LOAD1_UNTIL))


def _tb(df, exclude):
    return [c for c in df.columns if c not in exclude]


# --- single operators ------------------------------------------------------

def dedupe_latest_orders(w: Warehouse) -> DataFrame:
    s = w.stg_orders
    return latest_per_key(s, ["order_id"], tiebreak=_tb(s, {"order_id", "created_at", "ingestion_ts"}))


def dedupe_item_pairs(w: Warehouse) -> DataFrame:
    s = w.stg_orderitems
    return latest_per_key(s, ["order_id", "product_id"],
                          tiebreak=_tb(s, {"order_id", "product_id", "created_at", "ingestion_ts"}))


def versions_customers(w: Warehouse) -> DataFrame:
    s = w.stg_customers
    return versions_per_key(s, ["customer_id"], tiebreak=_tb(s, {"customer_id", "created_at", "ingestion_ts"}))


def clamp_orders(w: Warehouse) -> DataFrame:
    return clamp(w.stg_orders, silver.ORDER_AMOUNTS)


def clamp_items(w: Warehouse) -> DataFrame:
    return clamp(w.stg_orderitems, silver.ITEM_AMOUNTS)


def orders_newer_than(w: Warehouse) -> DataFrame:
    """fact_orders of an incremental run whose target mark is 1999-01-01 (filter before rank)."""
    return silver.fact_orders(w.stg_orders, hwm=HIGH_WATER_TEST)


def stage_append_newer(w: Warehouse) -> DataFrame:
    return merge.append_newer(load1(w.stg_orders), w.stg_orders)


def upsert_orders(w: Warehouse) -> DataFrame:
    existing = silver.fact_orders(load1(w.stg_orders))
    incoming = silver.fact_orders(w.stg_orders)
    return merge.merge_upsert(existing, incoming, ["order_id"], late_policy="merge", dedupe=False)


def upsert_orders_drop_late(w: Warehouse) -> DataFrame:
    existing = silver.fact_orders(load1(w.stg_orders))
    hwm = high_water_mark(existing)
    incoming = silver.fact_orders(w.stg_orders, hwm=hwm)
    return merge.merge_upsert(existing, incoming, ["order_id"], late_policy="drop", hwm=hwm, dedupe=False)


def evolve_append_columns(w: Warehouse) -> DataFrame:
    existing = silver.fact_orders(load1(w.stg_orders)).drop("payment_type")
    incoming = silver.fact_orders(w.stg_orders)
    return merge.merge_upsert(existing, incoming, ["order_id"], late_policy="merge", dedupe=False)


def evolve_widen_types(w: Warehouse) -> DataFrame:
    """The first load was stored with narrower types: store as int, totals of ten digits, days instead of times."""
    existing = silver.fact_orders(load1(w.stg_orders))
    existing = (existing.withColumn("store_id", F.col("store_id").cast("int"))
                .withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))
                .withColumn("created_at", F.col("created_at").cast("date")))
    incoming = silver.fact_orders(w.stg_orders)
    return merge.merge_upsert(existing, incoming, ["order_id"], late_policy="merge", dedupe=False)


# --- co-partitioned facts -----------------------------------------------------

def copartitioned_fct_sales(w: Warehouse) -> DataFrame:
    """The order mart over both facts stored in buckets of order_id: no exchange between their scans and the join."""
    orders = write_bucketed(w.fact_orders, ["order_id"], "fact_orders")
    items = write_bucketed(w.fact_orderitems, ["order_id"], "fact_orderitems")
    return gold.fct_sales(orders, items, w.dim_customer, w.dim_store)


# --- history ---------------------------------------------------------------

def scd2_customers(w: Warehouse) -> DataFrame:
    return history.rebuild_scd2(w.stg_customers, ["customer_id"])


def scd2_products(w: Warehouse) -> DataFrame:
    return history.rebuild_scd2(w.stg_products, ["product_id"])


def scd2_stores(w: Warehouse) -> DataFrame:
    return history.rebuild_scd2(w.stg_stores, ["store_id"])


def scd2_customers_incremental(w: Warehouse) -> DataFrame:
    """Three batches applied in order; must equal the rebuild."""
    s = w.stg_customers
    c1, c2 = (ts_literal(c) for c in SCD2_BATCH_CUTS)
    batches = [s.where(F.col("created_at") <= c1),
               s.where((F.col("created_at") > c1) & (F.col("created_at") <= c2)),
               s.where(F.col("created_at") > c2)]
    h = None
    for b in batches:
        # Each batch's history is a stored version in a real run; checkpointing
        # into the shared checkpoint folder cuts the lineage the same way.
        h = cut_lineage(history.apply_scd2(h, b, ["customer_id"]))
    return h


def scd2_shuffled(entity: str, key: str):
    """Three batches dealt by a hash of the row, so versions arrive in any order; must equal the rebuild."""
    def run(w: Warehouse) -> DataFrame:
        staged = getattr(w, f"stg_{entity}")
        number = F.pmod(F.xxhash64(key, "created_at", "ingestion_ts"), F.lit(3))
        h = None
        for b in range(3):
            h = cut_lineage(history.apply_scd2(h, staged.where(number == b), [key], late="split"))
        return h
    return run


def scd2_hard_delete(w: Warehouse) -> DataFrame:
    """Base versions, then a full extract holding only the changed customers:
    every customer missing from it is closed at the run time."""
    s = w.stg_customers
    cut = ts_literal(SCD2_BATCH_CUTS[0])
    h = cut_lineage(history.apply_scd2(None, s.where(F.col("created_at") <= cut), ["customer_id"]))
    return history.apply_scd2(h, s.where(F.col("created_at") > cut), ["customer_id"],
                              close_missing=True, now=HARD_DELETE_NOW)


# --- quality ---------------------------------------------------------------

def silver_tables(w: Warehouse) -> dict[str, DataFrame]:
    return {"dim_product": w.dim_product, "dim_customer": w.dim_customer, "dim_store": w.dim_store,
            "fact_orders": w.fact_orders, "fact_orderitems": w.fact_orderitems}


def staged_tables(w: Warehouse) -> dict[str, DataFrame]:
    """The suite's models mapped to their *staged* inputs (where checks do fail)."""
    return {"dim_product": w.stg_products, "dim_customer": w.stg_customers, "dim_store": w.stg_stores,
            "fact_orders": w.stg_orders, "fact_orderitems": w.stg_orderitems}


def suite_of(kind: str):
    return tuple(c for c in quality.SILVER_SUITE if c.kind == kind)


SCENARIOS = {
    "dedupe_latest_orders": dedupe_latest_orders,
    "dedupe_item_pairs": dedupe_item_pairs,
    "versions_customers": versions_customers,
    "clamp_orders": clamp_orders,
    "clamp_items": clamp_items,
    "orders_newer_than": orders_newer_than,
    "stage_append_newer": stage_append_newer,
    "upsert_orders": upsert_orders,
    "upsert_orders_drop_late": upsert_orders_drop_late,
    "evolve_append_columns": evolve_append_columns,
    "evolve_widen_types": evolve_widen_types,
    "copartitioned_fct_sales": copartitioned_fct_sales,
    "scd2_customers": scd2_customers,
    "scd2_products": scd2_products,
    "scd2_stores": scd2_stores,
    "scd2_customers_incremental": scd2_customers_incremental,
    "scd2_hard_delete": scd2_hard_delete,
    "scd2_customers_late": scd2_shuffled("customers", "customer_id"),
    "scd2_products_late": scd2_shuffled("products", "product_id"),
    "scd2_stores_late": scd2_shuffled("stores", "store_id"),
    "dq_summary": lambda w: quality.summary(silver_tables(w)),
    "dq_failures": lambda w: quality.failures(silver_tables(w)),
    "dq_summary_staged": lambda w: quality.summary(staged_tables(w)),
    "dq_failures_staged": lambda w: quality.failures(staged_tables(w)),
    "dq_unique": lambda w: quality.failures(staged_tables(w), suite_of("unique")),
    "dq_not_null": lambda w: quality.failures(staged_tables(w), suite_of("not_null")),
    "dq_non_negative": lambda w: quality.failures(staged_tables(w), suite_of("non_negative")),
    "dq_unique_bitmap": lambda w: quality.failures(staged_tables(w), suite_of("unique") + suite_of("unique_combination"), bitmaps=True),
    "dq_unique_pair": lambda w: quality.failures(staged_tables(w), suite_of("unique_combination")),
}


# --- sources, sinks and streams (write to a fresh folder below the checkpoint root) ----

from pyspark.sql import types as T  # noqa: E402

from martflow import schemas  # noqa: E402
from martflow.session import scratch_dir  # noqa: E402
from martflow.sources.landing import read_landing, write_landing  # noqa: E402
from martflow.sources.tables import TableStore  # noqa: E402
from martflow.streaming.ingest import read_landed, stream_landing, stream_upsert  # noqa: E402

# Fact partition grain for the driver tables (a few MB per year of orders);
# a deployment at terabytes per day uses "day".
FACT_GRAIN = "year"
L = T.LongType()
ENTITY_SCHEMAS = {
    "customers": schemas.customers_schema(key_type=L),
    "products": schemas.products_schema(money=schemas.WIDE_MONEY, key_type=L),
    "stores": schemas.stores_schema(key_type=L),
    "orders": schemas.orders_schema(money=schemas.WIDE_MONEY, key_type=L),
    "orderitems": schemas.orderitems_schema(money=schemas.WIDE_MONEY, key_type=L),
}


def _land(w: Warehouse, entity: str) -> str:
    """Write the staged entity as landing CSV files; returns the prefix."""
    path = scratch_dir(w.spark, f"landing-{entity}")
    write_landing(getattr(w, f"stg_{entity}"), path, ENTITY_SCHEMAS[entity])
    return path


def landing_batch(entity: str):
    """S1-S3 (and the older batch scans of orders / items): CSV prefix -> typed rows."""
    def run(w: Warehouse) -> DataFrame:
        good, _ = read_landing(w.spark, _land(w, entity), ENTITY_SCHEMAS[entity])
        return good.drop("ingestion_ts")
    return run


def stream_ingest(entity: str):
    """S4/S5, X1/X2: each landed file loaded once by a file stream."""
    def run(w: Warehouse) -> DataFrame:
        src = _land(w, entity)
        out = scratch_dir(w.spark, f"staging-{entity}")
        q = stream_landing(w.spark, src, ENTITY_SCHEMAS[entity], out, checkpoint=out + "-ckpt")
        q.awaitTermination()
        return read_landed(w.spark, out).drop("ingestion_ts", "load_batch")
    return run


def stream_upsert_orders(w: Warehouse) -> DataFrame:
    """X3/X4: micro-batches -> fact_orders rules -> upsert into the stored silver table."""
    src = _land(w, "orders")
    store = TableStore(w.spark, scratch_dir(w.spark, "store"))
    q = stream_upsert(w.spark, src, ENTITY_SCHEMAS["orders"], store, "core", "fact_orders",
                      ["order_id"], silver.fact_orders, checkpoint=store.root + "-ckpt",
                      late_policy="merge",
                      cluster_by=["created_at", "order_id"], grain=FACT_GRAIN)
    q.awaitTermination()
    return store.read("core", "fact_orders")


def stream_upsert_redelivered(w: Warehouse) -> DataFrame:
    """Orders delivered three times, the last one after a restart of the stream: the rows that reached the upsert
    (each landed row once), and the table they make."""
    src = scratch_dir(w.spark, "landing-orders")
    store = TableStore(w.spark, scratch_dir(w.spark, "store"))
    passed: list[int] = []

    def counted(rows: DataFrame) -> DataFrame:
        passed.append(rows.count())
        return silver.fact_orders(rows)

    for upload in (("a", "b"), ("c",)):
        for name in upload:
            write_landing(w.stg_orders, f"{src}/{name}", ENTITY_SCHEMAS["orders"])
        stream_upsert(w.spark, src, ENTITY_SCHEMAS["orders"], store, "core", "fact_orders", ["order_id"], counted,
                      checkpoint=store.root + "-ckpt", cluster_by=["created_at", "order_id"], grain=FACT_GRAIN,
                      max_files_per_trigger=1, redelivery="2 days").awaitTermination()
    return store.read("core", "fact_orders").withColumn("rows_upserted", F.lit(sum(passed)).cast("long"))


def pipeline_fct_sales(w: Warehouse) -> DataFrame:
    """The whole build (staging -> silver -> quality gate -> gold -> history) into a
    fresh table store; returns the stored flagship mart."""
    from martflow.plans.pipeline import run_pipeline
    store = TableStore(w.spark, scratch_dir(w.spark, "warehouse"))
    run_pipeline(w, store, grain=FACT_GRAIN)
    return store.read("marts", "fct_sales")


def landing_orders_quarantine(w: Warehouse) -> DataFrame:
    """Order files read under the original landing contract (amounts NUMBER(6,2)):
    every order with an amount beyond 9999.99 is quarantined with its reason."""
    narrow = schemas.orders_schema(money=schemas.LANDING_MONEY, key_type=L)
    _, bad = read_landing(w.spark, _land(w, "orders"), narrow)
    return bad.select("reason", "order_id", "created_at")


def late_orders_dropped(w: Warehouse) -> DataFrame:
    """Rows the parity (drop) policy discards on the second load: staged orders
    not newer than the high-water mark of the first load's fact table."""
    existing = silver.fact_orders(load1(w.stg_orders))
    return merge.late_rows(existing, w.stg_orders).select("order_id", "created_at", "order_status")


def pipeline_landing_fct_sales(w: Warehouse) -> DataFrame:
    """The original's flow end to end: the five entities are landed as CSV files,
    dimensions are batch-loaded, orders and items streamed file by file into
    staging, then silver, quality gate, gold and history; returns the mart."""
    from martflow.plans.pipeline import run_pipeline_from_landing
    root = scratch_dir(w.spark, "landing-all")
    for e in ENTITY_SCHEMAS:
        write_landing(getattr(w, f"stg_{e}"), f"{root}/{e}", ENTITY_SCHEMAS[e])
    store = TableStore(w.spark, scratch_dir(w.spark, "warehouse"))
    run_pipeline_from_landing(w.spark, root, store, ENTITY_SCHEMAS, checkpoint_root=store.root + "-ckpt",
                              grain=FACT_GRAIN)
    return store.read("marts", "fct_sales")


# --- a second run over stored tables --------------------------------------------

class Load:
    """The staged rows of one of two loads, with the attributes of a warehouse."""

    def __init__(self, w: Warehouse, number: int):
        self.spark, self.sf_dir, self.load_id = w.spark, w.sf_dir, f"{w.sf_dir}#{number}"
        first, items_first = in_load1(), F.col("created_at") <= ts_literal(LOAD1_UNTIL)
        self.stg_orders = w.stg_orders.where(first if number == 1 else ~first)
        self.stg_orderitems = w.stg_orderitems.where(items_first if number == 1 else ~items_first)
        # dimension prefixes are re-scanned whole; the second scan sees the later versions too
        early = F.col("created_at") <= ts_literal(SCD2_BATCH_CUTS[0])
        for name in ("stg_customers", "stg_products", "stg_stores"):
            rows = getattr(w, name)
            setattr(self, name, rows.where(early) if number == 1 else rows)


def built_twice(w: Warehouse, late_policy: str) -> TableStore:
    """A store of its own after two builds."""
    from martflow.plans.pipeline import run_pipeline
    store = TableStore(w.spark, scratch_dir(w.spark, "warehouse"))
    for number in (1, 2):
        run_pipeline(Load(w, number), store, late_policy=late_policy, grain=FACT_GRAIN)
    return store


def maintained_mart(name: str):
    """One aggregated mart after two loads of its fact, maintained from the partitions that the second rewrote.

    The second load brings late orders and newer versions, so groups lose rows
    and extremes; must equal the mart built from all rows at once.
    """
    def run(w: Warehouse) -> DataFrame:
        from martflow.plans.marts import MARTS
        from martflow.plans.pipeline import DIMENSIONS, FACTS, build_mart
        store, mart = TableStore(w.spark, scratch_dir(w.spark, "warehouse")), MARTS[name]
        if mart.dimension:
            entity, model = DIMENSIONS[mart.dimension]
            store.replace("core", mart.dimension, model(getattr(w, f"stg_{entity}")))
        entity, model, keys, cluster = FACTS[mart.fact]
        for number in (1, 2):
            batch = cut_lineage(model(getattr(Load(w, number), f"stg_{entity}")))
            store.upsert("core", mart.fact, batch, keys, lambda old, new: merge.merge_upsert(old, new, keys, dedupe=False),
                         grain=FACT_GRAIN, cluster_by=cluster)
            build_mart(store, name)
        return store.read("marts", name)
    return run


def pipeline_late_drop_counts(w: Warehouse) -> DataFrame:
    """Rows that the second build left out as late under the parity policy, from its commit records."""
    store = built_twice(w, "drop")
    counts = ", ".join(f"('{t}', {store.commit_info('core', t)['late_dropped']})" for t in ("fact_orders", "fact_orderitems"))
    return w.spark.sql(f"SELECT table_name, CAST(n AS BIGINT) AS late_dropped FROM VALUES {counts} AS t(table_name, n)")


def pipeline_rerun_customers_snapshot(w: Warehouse) -> DataFrame:
    from martflow.plans.pipeline import read_history
    return read_history(built_twice(w, "merge"), "customers_snapshot")


def _land_dirty_items(w: Warehouse, path: str) -> None:
    """Item files whose whole quantities are written as decimals, and too long ones for some orders."""
    items = w.stg_orderitems
    quantity = (F.when(F.col("order_id") % 13 == 0, F.lit("12345678")).otherwise(F.concat(F.col("quantity").cast("string"), F.lit(".0"))))
    schema = ENTITY_SCHEMAS["orderitems"]
    write_landing(items.withColumn("quantity", quantity), path, schema)


def landing_dirty_orderitems(w: Warehouse) -> DataFrame:
    """Whole numbers of at most six digits: "3.0" is three, 12345678 is quarantined."""
    path = scratch_dir(w.spark, "landing-dirty")
    _land_dirty_items(w, path)
    good, bad = read_landing(w.spark, path, ENTITY_SCHEMAS["orderitems"])
    keys = [F.col(c).cast("string").alias(c) for c in ("order_id", "product_id")]
    return good.select(*keys, F.lit("good").alias("outcome"), "quantity").union(
        bad.select(*keys, F.col("reason").alias("outcome"), "quantity"))


def pipeline_quarantine(w: Warehouse) -> DataFrame:
    """Quarantine of the item stream after two runs over one prefix: each malformed row once."""
    from martflow.plans.pipeline import load_staging_from_landing
    root = scratch_dir(w.spark, "landing-twice")
    _land_dirty_items(w, f"{root}/orderitems")
    store = TableStore(w.spark, scratch_dir(w.spark, "warehouse"))
    for _ in range(2):
        load_staging_from_landing(w.spark, root, store, ENTITY_SCHEMAS, checkpoint_root=store.root + "-ckpt")
    bad = store.read("staging", "stg_orderitems_quarantine")
    return bad.select("reason", F.col("order_id").cast("string").alias("order_id"), F.col("product_id").cast("string").alias("product_id"))


def stage_file_ledger(w: Warehouse) -> DataFrame:
    """S9 by files: two loads of a growing customer prefix; the second opens the new files only.

    The first load lacks a third of the customers, so some rows of the second
    are not newer than the mark and stay out, as the original rule has it.
    """
    from martflow.plans.pipeline import load_staging_from_landing
    root, schema = scratch_dir(w.spark, "landing-grows"), ENTITY_SCHEMAS["customers"]
    store = TableStore(w.spark, scratch_dir(w.spark, "warehouse"))
    first = (F.col("created_at") <= ts_literal(SCD2_BATCH_CUTS[0])) & (F.col("customer_id") % 3 != 0)
    for rows in (w.stg_customers.where(first), w.stg_customers.where(~F.coalesce(first, F.lit(False)))):
        write_landing(rows, f"{root}/customers", schema, mode="append")
        load_staging_from_landing(w.spark, root, store, ENTITY_SCHEMAS, checkpoint_root=store.root + "-ckpt")
    return store.read("staging", "stg_customers").drop("ingestion_ts")


SCENARIOS.update({
    "stage_file_ledger": stage_file_ledger,
    "pipeline_landing_fct_sales": pipeline_landing_fct_sales,
    "landing_orders_quarantine": landing_orders_quarantine,
    "late_orders_dropped": late_orders_dropped,
    "landing_customers": landing_batch("customers"),
    "landing_products": landing_batch("products"),
    "landing_stores": landing_batch("stores"),
    "landing_orders_batch": landing_batch("orders"),
    "landing_orderitems_batch": landing_batch("orderitems"),
    "stream_ingest_orders": stream_ingest("orders"),
    "stream_ingest_orderitems": stream_ingest("orderitems"),
    "stream_upsert_orders": stream_upsert_orders,
    "stream_upsert_redelivered": stream_upsert_redelivered,
    "pipeline_fct_sales": pipeline_fct_sales,
    "pipeline_late_merge_fact_orders": lambda w: built_twice(w, "merge").read("core", "fact_orders"),
    "pipeline_rerun_fct_sales": lambda w: built_twice(w, "merge").read("marts", "fct_sales"),
    "pipeline_rerun_sales_by_store": lambda w: built_twice(w, "merge").read("marts", "sales_by_store"),
    "pipeline_rerun_customers_snapshot": pipeline_rerun_customers_snapshot,
    **{f"maintained_{name}": maintained_mart(name)
       for name in ("sales_by_day", "sales_by_store", "sales_by_product", "customer_profile")},
    "pipeline_late_drop_counts": pipeline_late_drop_counts,
    "landing_dirty_orderitems": landing_dirty_orderitems,
    "pipeline_quarantine": pipeline_quarantine,
})
