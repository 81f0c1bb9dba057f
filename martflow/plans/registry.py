"""Registry of named queries: Spark callables and their SQL oracles.

Every query reads the driver tables of ``sf_dir`` (or data Spark derives from
them) in full and returns a DataFrame; the caller collects.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martflow.plans.oracle import with_models
from martflow.plans.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _model(name: str) -> Query:
    return lambda spark, sf_dir: getattr(Warehouse.of(spark, sf_dir), name)


# Model-level queries: staging, silver and gold relations, whole.
for _name in ("stg_orders", "stg_orderitems", "stg_customers", "stg_products", "stg_stores",
              "dim_customer", "dim_product", "dim_store", "fact_orders", "fact_orderitems",
              "fct_sales", "sales_by_day", "sales_by_store", "sales_by_product", "customer_profile"):
    register(_name, with_models(f"SELECT * FROM {_name}"))(_model(_name))


def _report(name: str) -> Query:
    return lambda spark, sf_dir: Warehouse.of(spark, sf_dir).report(name)


REPORT_SQL = {
    "report_sales_trend": "SELECT order_date, total_sales FROM sales_by_day ORDER BY order_date",
    "report_top_products": """
        SELECT product_id, product_name, total_sales FROM sales_by_product
        ORDER BY total_sales DESC NULLS LAST, product_id ASC NULLS LAST LIMIT 10""",
    "report_top_store_days": """
        SELECT store_id, store_name, order_date, total_orders, total_sales FROM sales_by_store
        ORDER BY total_orders DESC NULLS LAST, total_sales DESC NULLS LAST,
                 store_id ASC NULLS LAST, order_date ASC NULLS LAST
        LIMIT 10""",
    "report_top_stores": """
        SELECT store_id, store_name, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
               CAST(SUM(total_sales) AS DECIMAL(18,2)) AS total_sales
        FROM sales_by_store GROUP BY store_id, store_name
        ORDER BY total_orders DESC NULLS LAST, total_sales DESC NULLS LAST, store_id ASC NULLS LAST
        LIMIT 10""",
    "report_top_customers": """
        SELECT * FROM (
            SELECT customer_id, lifetime_spend FROM customer_profile
            WHERE lifetime_spend > 0
            ORDER BY lifetime_spend DESC NULLS LAST, customer_id ASC NULLS LAST LIMIT 10
        ) t ORDER BY lifetime_spend ASC, customer_id DESC""",
    "report_order_status": """
        SELECT order_status, COUNT(*) AS count_status FROM fact_orders GROUP BY order_status""",
    "report_status_share": """
        SELECT order_status, count_status,
               CAST(count_status AS DOUBLE) / CAST(SUM(count_status) OVER () AS DOUBLE) AS share
        FROM (SELECT order_status, COUNT(*) AS count_status FROM fact_orders GROUP BY order_status) s""",
}

for _name, _sql in REPORT_SQL.items():
    register(_name, with_models(_sql))(_report(_name))


# Operator scenarios.
from martflow.operators import quality as _q  # noqa: E402
from martflow.plans import oracle as _o  # noqa: E402
from martflow.plans import scenarios as _s  # noqa: E402

_SCEN_SQL = _o.scenario_sql()
_SUITE = _q.SILVER_SUITE
_SCEN_SQL.update({
    "dq_summary": _o.dq_summary_sql(_SUITE),
    "dq_failures": _o.dq_failures_sql(_SUITE),
    "dq_summary_staged": _o.dq_summary_sql(_SUITE, staged=True),
    "dq_failures_staged": _o.dq_failures_sql(_SUITE, staged=True),
    "dq_unique": _o.dq_failures_sql(_s.suite_of("unique"), staged=True),
    "dq_unique_bitmap": _o.dq_failures_sql(_s.suite_of("unique") + _s.suite_of("unique_combination"), staged=True),
    "dq_not_null": _o.dq_failures_sql(_s.suite_of("not_null"), staged=True),
    "dq_non_negative": _o.dq_failures_sql(_s.suite_of("non_negative"), staged=True),
    "dq_unique_pair": _o.dq_failures_sql(_s.suite_of("unique_combination"), staged=True),
})


def _scenario(fn) -> Query:
    return lambda spark, sf_dir: fn(Warehouse.of(spark, sf_dir))


for _name, _fn in _s.SCENARIOS.items():
    register(_name, _SCEN_SQL.get(_name))(_scenario(_fn))
