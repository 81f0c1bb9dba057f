"""Facts in buckets of the order: no exchange between their scans and the join, one file per bucket."""

import glob

from pyspark.sql import functions as F

from martflow.plans import gold
from martflow.sources.bucketed import write_bucketed

KEY = "spark.sql.autoBroadcastJoinThreshold"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_of_bucketed_facts_has_no_exchange(spark, wh):
    orders = write_bucketed(wh.fact_orders, ["order_id"], "orders", 4)
    items = write_bucketed(wh.fact_orderitems, ["order_id"], "items", 4)
    limit = spark.conf.get(KEY)
    spark.conf.set(KEY, "-1")
    try:
        rolled = orders.join(gold.order_item_rollup(items), "order_id", "left")
        assert "Exchange" not in plan_of(rolled) and "SortMergeJoin" in plan_of(rolled)
        plain = wh.fact_orders.join(gold.order_item_rollup(wh.fact_orderitems), "order_id", "left")
        assert "Exchange" in plan_of(plain)
        assert sorted(map(str, rolled.collect())) == sorted(map(str, plain.select(*rolled.columns).collect()))
    finally:
        spark.conf.set(KEY, limit)


def test_one_file_per_bucket_and_empty_tables(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = write_bucketed(df, ["k"], "files", 4, str(tmp_path / "files"))
    assert len(glob.glob(str(tmp_path / "files" / "*.parquet"))) == 4 and got.agg(F.sum("v")).first()[0] == df.agg(F.sum("v")).first()[0]
    assert write_bucketed(df.where("false"), ["k"], "none", 4, str(tmp_path / "none")).count() == 0
