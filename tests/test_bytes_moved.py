"""What a build shuffles and writes: narrow buffers, unranked single rows, compressed files."""

import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.columns import agg_money, money_sum
from martflow.operators import dedupe
from martflow.plans.scenarios import ENTITY_SCHEMAS
from martflow.sources import landing
from martflow.sources.tables import TableStore


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landed_files_are_compressed_and_bounded(spark, wh, scratch, monkeypatch):
    monkeypatch.setattr(landing, "FILE_ROWS", 500)
    path, schema = scratch("landing"), ENTITY_SCHEMAS["orders"]
    landing.write_landing(wh.stg_orders, path, schema)
    assert len(glob.glob(path + "/part-*.csv.gz")) >= wh.stg_orders.count() / 500 and not glob.glob(path + "/*.csv")
    good, bad = landing.read_landing(spark, path, schema)
    assert bad.isEmpty() and rows(good.drop("ingestion_ts")) == rows(wh.stg_orders.select(*schema.names))


def test_appended_and_partitioned_files_are_zstd(spark, scratch):
    store = TableStore(spark, scratch("store"))
    df = spark.range(9).select("id", F.timestamp_seconds("id").cast(T.TimestampNTZType()).alias("created_at"))
    store.append("staging", "t", df)
    store.upsert("core", "t", df, ["id"], lambda old, new: new, grain="year")
    for layer, deep in (("staging", ""), ("core", "*/")):
        assert glob.glob(f"{store.table_path(layer, 't')}/data-*/{deep}*.zstd.parquet")
        assert rows(store.read(layer, "t")) == rows(df)


@pytest.mark.parametrize("digits, scale", [(12, 2), (12, 4), (9, 0), (13, 2)])
def test_money_sums_are_those_of_decimals(spark, digits, scale):
    top = Decimal(10 ** digits - 1).scaleb(-scale)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DecimalType(digits, scale))])
    df = spark.createDataFrame([(1, top)] * 50 + [(1, -top)] * 20 + [(1, Decimal("-3").scaleb(-scale)), (1, None), (2, None)], schema)
    got, want = (df.groupBy("k").agg(s.alias("s")) for s in (money_sum(df, "v"), agg_money(F.sum("v"))))
    assert got.schema == want.schema and rows(got) == rows(want)
    assert ("isEmpty" in plan(got)) == (digits > 12)  # the flag of a decimal's buffer


@pytest.mark.parametrize("most", [100, 0])
def test_only_repeated_keys_are_ranked(spark, scratch, monkeypatch, most):
    monkeypatch.setattr(dedupe, "REPEATED_KEYS", most)
    path = scratch("rows")
    t = F.timestamp_seconds(F.col("id")).cast(T.TimestampNTZType())
    spark.range(300).select(F.when(F.col("id") % 50 != 7, F.col("id") % 290).alias("a"), (F.col("id") % 3 % 2).alias("b"),
                            t.alias("created_at"), F.col("id").alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    got = dedupe.latest_of_repeated(df, ["a", "b"], tiebreak=["v"])
    want = dedupe.latest_per_key(df, ["a", "b"], tiebreak=["v"])
    assert 0 < want.count() < 300 and rows(got) == rows(want)
    assert ("Union" in plan(got)) == bool(most)


def test_lines_meet_prices_without_doubles(wh):
    wide = wh.stg_orderitems._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert wide.size() == 2
    below = wh.stg_orderitems._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[1]
    assert "as decimal(12,2)) AS l_extendedprice" in below and "as decimal(12,2)) AS l_discount" in below


def test_dealt_rows_carry_one_number_for_all_row_checks(spark, scratch, monkeypatch):
    from martflow.functions import partitions
    from martflow.operators import quality
    from martflow.operators.quality import Check
    path = scratch("checked")
    spark.sql("select id % 900 as k, if(id % 10 = 0, null, id % 4 - 1) as v, if(id % 7 = 0, -1, 1) as w from range(1000)").write.parquet(path)
    df = spark.read.parquet(path)
    monkeypatch.setattr(partitions, "TASK_BYTES", partitions.input_bytes(df) // 9)
    suite = [Check("t", "unique", ("k",)), Check("t", "not_null", ("v",)), Check("t", "non_negative", ("v",)), Check("t", "non_negative", ("w",))]
    got = quality.summary({"t": df}, suite)
    want = {("not_null", "v"): df.where("v is null").count(), ("non_negative", "v"): df.where("v < 0").count(),
            ("non_negative", "w"): df.where("w < 0").count(), ("unique", "k"): 100}
    assert {(r["test"], r["columns"]): r["failures"] for r in got.collect()} == want and min(want.values()) > 0
    dealt = got._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert dealt.count("AS _f") == 1 and "AS _fails" in dealt


def test_line_sums_of_staged_orders_have_narrow_buffers(wh):
    from martflow.operators import quality
    from martflow.plans.scenarios import staged_tables
    suite = [c for c in quality.SILVER_SUITE if c.model == "fact_orders"]
    text = plan(quality.failures(staged_tables(wh), suite))
    assert "partial_sum" in text and "isEmpty" not in text
