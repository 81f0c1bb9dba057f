"""All models of one warehouse build, wired over the driver tables.

``Warehouse(spark, sf_dir)`` exposes every staged, silver and gold relation as
a lazily built DataFrame.  Nothing is executed until a caller acts, and every
relation is the full plan down to the parquet scans, so Catalyst prunes
columns and pushes filters through the whole chain.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from martflow.plans import gold, reports, silver
from martflow.sources import adapters
from martflow.sources.driver import DriverTables


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables = DriverTables(spark, sf_dir)

    _shared: dict[tuple[str, str], "Warehouse"] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        """The warehouse of a session and data folder, built once.

        Only logical plans are shared (analysed DataFrames, no cached data), so
        later queries skip re-analysing the common staging/silver plans.  The
        entries of ended applications are dropped.
        """
        app = spark.sparkContext.applicationId
        for old in [k for k in cls._shared if k[0] != app]:
            del cls._shared[old]
        w = cls._shared.get((app, sf_dir))
        if w is None or w.spark is not spark:
            w = cls._shared[app, sf_dir] = cls(spark, sf_dir)
        return w

    # staging ---------------------------------------------------------------
    @cached_property
    def stg_orders(self) -> DataFrame:
        return adapters.staged_orders(self.tables)

    @cached_property
    def stg_orderitems(self) -> DataFrame:
        return adapters.staged_orderitems(self.tables)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return adapters.staged_customers(self.tables)

    @cached_property
    def stg_products(self) -> DataFrame:
        return adapters.staged_products(self.tables)

    @cached_property
    def stg_stores(self) -> DataFrame:
        return adapters.staged_stores(self.tables)

    # silver ----------------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return silver.dim_customer(self.stg_customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return silver.dim_product(self.stg_products)

    @cached_property
    def dim_store(self) -> DataFrame:
        return silver.dim_store(self.stg_stores)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return silver.fact_orders(self.stg_orders)

    @cached_property
    def fact_orderitems(self) -> DataFrame:
        return silver.fact_orderitems(self.stg_orderitems)

    # gold ------------------------------------------------------------------
    @cached_property
    def fct_sales(self) -> DataFrame:
        return gold.fct_sales(self.fact_orders, self.fact_orderitems, self.dim_customer, self.dim_store)

    @cached_property
    def sales_by_day(self) -> DataFrame:
        return gold.sales_by_day(self.fact_orders)

    @cached_property
    def sales_by_store(self) -> DataFrame:
        return gold.sales_by_store(self.fact_orders, self.dim_store)

    @cached_property
    def sales_by_product(self) -> DataFrame:
        return gold.sales_by_product(self.fact_orderitems, self.dim_product)

    @cached_property
    def customer_profile(self) -> DataFrame:
        return gold.customer_profile(self.dim_customer, self.fact_orders)

    # reports ---------------------------------------------------------------
    def report(self, name: str) -> DataFrame:
        fns = {
            "report_sales_trend": lambda: reports.report_sales_trend(self.sales_by_day),
            "report_top_products": lambda: reports.report_top_products(self.sales_by_product),
            "report_top_store_days": lambda: reports.report_top_store_days(self.sales_by_store),
            "report_top_stores": lambda: reports.report_top_stores(self.sales_by_store),
            "report_top_customers": lambda: reports.report_top_customers(self.customer_profile),
            "report_order_status": lambda: reports.report_order_status(self.fact_orders),
            "report_status_share": lambda: reports.report_status_share(self.fact_orders),
        }
        return fns[name]()
