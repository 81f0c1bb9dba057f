"""Keyed steps of large tables get tasks by the size of their input."""

import re

import pytest
from pyspark.sql import functions as F

from martflow.functions import partitions
from martflow.operators import quality
from martflow.operators.quality import Check

CHECKS = {"unique": [Check("t", "unique", ("a",)), Check("t", "not_null", ("a",)), Check("t", "non_negative", ("v",))],
          "unique_combination": [Check("t", "unique_combination", ("a", "b")), Check("t", "non_negative", ("v",))]}


@pytest.fixture()
def table(spark, scratch):
    """Keys 0 to 59,999, each twice where divisible by 1,000; 500 NULLs, of which 250 with a negative value."""
    path = scratch("keyed table")
    ids = spark.range(60_000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.lit(1).alias("v"))
    nulls = spark.range(500).select(F.lit(None).cast("long").alias("a"), F.col("id").alias("b"), F.when(F.col("id") % 2 == 0, -1).alias("v"))
    ids.unionByName(ids.where("a % 1000 = 0")).unionByName(nulls).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def counts(df):
    return sorted(map(tuple, df.collect()))


def dealt(df):
    """Partitions of the exchanges that a query asks for by number."""
    return [int(n) for n in re.findall(r"hashpartitioning\([^\n]*, (\d+)\), REPARTITION_BY_NUM", df._jdf.queryExecution().executedPlan().toString())]


def test_tasks_follow_the_input_files(spark, table, monkeypatch):
    size = partitions.input_bytes(table)
    assert size > 0 and partitions.input_bytes(table.union(table)) == size
    assert partitions.input_bytes(spark.range(9)) == 0
    for tasks in (9, 18):
        monkeypatch.setattr(partitions, "TASK_BYTES", size // tasks)
        assert partitions.by_key(table, "a").rdd.getNumPartitions() == tasks
    monkeypatch.setattr(partitions, "TASK_BYTES", size)
    assert partitions.by_key(table, "a") is table


@pytest.mark.parametrize("kind", CHECKS)
def test_summary_of_a_large_table(table, monkeypatch, kind):
    want = counts(quality.summary({"t": table}, CHECKS[kind]))
    assert ("t", kind, CHECKS[kind][0].column_label, 60) in want and ("t", "non_negative", "v", 250) in want
    assert dealt(quality.summary({"t": table}, CHECKS[kind])) == []
    monkeypatch.setattr(partitions, "TASK_BYTES", partitions.input_bytes(table) // 11)
    large = quality.summary({"t": table}, CHECKS[kind])
    assert dealt(large) == [11] and counts(large) == want


@pytest.mark.parametrize("bitmaps", [False, True])
def test_repeated_keys_of_a_large_table(table, monkeypatch, bitmaps):
    monkeypatch.setattr(quality, "bitmap_pays", lambda keyed: False)
    suite = [checks[0] for checks in CHECKS.values()]
    want = counts(quality.failures({"t": table}, suite, bitmaps))
    assert len(want) == 120 and ("t", "unique", "a", "1000", 2) in want
    monkeypatch.setattr(partitions, "TASK_BYTES", partitions.input_bytes(table) // 11)
    large = quality.failures({"t": table}, suite, bitmaps)
    assert dealt(large) == [11, 11] and counts(large) == want


def test_summary_of_silver_deals_the_facts(wh, monkeypatch):
    from martflow.plans.scenarios import silver_tables
    want = counts(quality.summary(silver_tables(wh)))
    monkeypatch.setattr(partitions, "TASK_BYTES", partitions.input_bytes(wh.fact_orderitems) // 11)
    large = quality.summary(silver_tables(wh))
    assert 11 in dealt(large) and counts(large) == want


@pytest.mark.parametrize("digits", [12, 14])
def test_lines_are_dealt_by_order_before_they_are_rolled_up(wh, monkeypatch, digits):
    from martflow.sources.adapters import staged_orders
    suite = [c for c in quality.SILVER_SUITE if c.model == "fact_orders" and c.kind != "unique"]
    small = staged_orders(wh.tables, (digits, 2))
    want, failed = sorted(map(str, small.collect())), counts(quality.failures({"fact_orders": small}, suite))
    assert failed and dealt(small) == []
    monkeypatch.setattr(partitions, "TASK_BYTES", partitions.input_bytes(wh.tables.lineitem) // 11)
    large = staged_orders(wh.tables, (digits, 2))
    checked = quality.failures({"fact_orders": large}, suite)
    assert dealt(large) == dealt(checked) == [11]
    # below the exchange of the lines nothing is aggregated: what a map task holds does not grow with its split
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Aggregate" not in plan.split("REPARTITION_BY_NUM")[1]
    assert sorted(map(str, large.collect())) == want and counts(checked) == failed
