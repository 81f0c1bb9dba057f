"""Properties of the row operators, dedup, merge and history on driver-derived data."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.columns import clamp_non_negative, composite_key, day_start
from martflow.operators import history, merge
from martflow.operators.clean import newer_than
from martflow.operators.dedupe import latest_per_key
from martflow.plans import silver


def rows(df):
    """Order-insensitive content; NULLs sort first."""
    cols = sorted(df.columns)
    return sorted((tuple((v is not None, v) for v in r) for r in df.select(*cols).collect()))


# --- columns -----------------------------------------------------------------

def test_clamp_keeps_types_and_zeroes_null_and_negative(wh):
    df = wh.stg_orderitems.select(
        clamp_non_negative("quantity").alias("q"), clamp_non_negative("line_total").alias("t"),
        "quantity", "line_total")
    assert dict(df.dtypes)["q"] == "int"
    assert dict(df.dtypes)["t"] == "decimal(12,2)"
    bad = df.where((F.col("q") < 0) | F.col("q").isNull() | (F.col("t") < 0) | F.col("t").isNull())
    assert bad.count() == 0
    # negatives and NULLs existed before
    assert wh.stg_orderitems.where((F.col("quantity") < 0) | F.col("quantity").isNull()).count() > 0
    # positive values untouched
    assert df.where((F.col("quantity") > 0) & (F.col("q") != F.col("quantity"))).count() == 0


def test_composite_key_propagates_null(spark):
    df = spark.range(3).select(
        F.when(F.col("id") == 1, F.lit(None)).otherwise(F.col("id")).alias("a"),
        (F.col("id") * 10).alias("b"))
    got = sorted((r[0] is None, r[0]) for r in df.select(composite_key("a", "b")).collect())
    assert [g[1] for g in got if not g[0]] == ["0_0", "2_20"]
    assert sum(1 for g in got if g[0]) == 1


def test_day_start_is_time_zone_free(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1998-03-29 01:30:00' AS ts")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = set()
        for tz in ("UTC", "Europe/Berlin", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out.add(df.select(day_start("ts")).first()[0])
        assert out == {dt.datetime(1998, 3, 29)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# --- dedup -------------------------------------------------------------------

def test_latest_per_key_idempotent_and_partitioning_independent(wh):
    s = wh.stg_orders
    tb = [c for c in s.columns if c not in ("order_id", "created_at", "ingestion_ts")]
    a = latest_per_key(s, ["order_id"], tiebreak=tb)
    b = latest_per_key(s.repartition(7, "customer_id"), ["order_id"], tiebreak=tb)
    c = latest_per_key(a, ["order_id"], tiebreak=tb)
    assert rows(a) == rows(b) == rows(c)
    assert a.count() == a.select("order_id").distinct().count()
    # the revised version (status R, one day later) wins
    revised = a.where(F.col("order_id") % 50 == 0)
    assert revised.where(F.col("order_status") != "R").count() == 0


def test_latest_per_key_tie_break_is_total(spark):
    ts = dt.datetime(2000, 1, 1)
    df = spark.createDataFrame(
        [(1, ts, ts, "b"), (1, ts, ts, "a"), (2, ts, None, "z"), (2, ts, ts, "y")],
        "k long, created_at timestamp_ntz, ingestion_ts timestamp_ntz, v string")
    got = {r.k: r.v for r in latest_per_key(df, ["k"], tiebreak=["v"]).collect()}
    assert got == {1: "a", 2: "y"}  # remaining columns ascending; NULL load stamp last


def test_plan_uses_partial_window_group_limit(wh):
    plan = wh.fact_orders._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# --- high water & merge ------------------------------------------------------

def test_newer_than_is_strict_and_drops_null(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2000-01-01'), (2, TIMESTAMP_NTZ'2000-01-02'),
                      (3, CAST(NULL AS TIMESTAMP_NTZ)) AS t(id, created_at)""")
    assert [r.id for r in newer_than(df, "2000-01-01 00:00:00").collect()] == [2]
    assert sorted(r.id for r in newer_than(df, None).collect()) == [1, 2]


def test_filter_before_rank_equals_filter_after(wh):
    hwm = "1996-01-01 00:00:00"
    early = silver.fact_orders(wh.stg_orders, hwm=hwm)
    late = silver.fact_orders(wh.stg_orders).where(F.col("created_at") > F.lit(hwm).cast("timestamp_ntz"))
    assert rows(early) == rows(late)


def test_upsert_with_itself_is_identity(wh):
    fo = wh.fact_orders
    for policy in ("merge", "drop"):
        out = merge.merge_upsert(fo, fo, ["order_id"], late_policy=policy, dedupe=False)
        assert rows(out) == rows(fo)


def test_upsert_merge_policy_replaces_only_newer(spark):
    t0, t1, t2 = (dt.datetime(2000, 1, d) for d in (1, 2, 3))
    existing = spark.createDataFrame([(1, "old", t1), (2, "keep", t2)],
                                     "order_id long, v string, created_at timestamp_ntz")
    incoming = spark.createDataFrame([(1, "new", t2), (2, "stale", t0), (3, "ins", t0)],
                                     "order_id long, v string, created_at timestamp_ntz")
    got = {r.order_id: r.v for r in merge.merge_upsert(existing, incoming, ["order_id"],
                                                       late_policy="merge", dedupe=False).collect()}
    assert got == {1: "new", 2: "keep", 3: "ins"}
    # parity policy: only rows newer than the target's global max (t2) count
    got = {r.order_id: r.v for r in merge.merge_upsert(existing, incoming, ["order_id"],
                                                       late_policy="drop", dedupe=False).collect()}
    assert got == {1: "old", 2: "keep"}


def test_align_columns_appends_and_nulls(spark):
    a = spark.createDataFrame([(1, "x")], "k long, a string")
    b = spark.createDataFrame([(2, 5)], "k long, n int")
    out = merge.union_evolving(a, b)
    assert out.columns == ["k", "a", "n"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", None), (2, None, 5)]


def test_append_newer_uses_existing_mark(wh):
    s = wh.stg_orders
    first = s.where(F.col("created_at") <= F.lit("1996-01-01").cast("timestamp_ntz"))
    out = merge.append_newer(first, s)
    assert out.count() == s.count()  # nothing lost, nothing doubled (time-ordered loads)


# --- history -----------------------------------------------------------------

def _hot_versions(spark):
    """Versions derived from lineitem: one hot key (-1) holding a version for every
    first line (about a quarter of all rows, spread over many days and seconds),
    plus one small key per order."""
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    hot = li.select(F.lit(-1).cast("long").alias("k"),
                    (F.col("l_shipdate") + F.make_dt_interval(secs=F.col("l_orderkey") % 86400))
                    .alias("ts")).where(F.col("l_linenumber") == 1)
    small = li.select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("ts"))
    return hot.unionByName(small).distinct()


@pytest.mark.parametrize("levels", [(), ("day", "year"), ("hour", "day", "month", "year")])
def test_next_in_key_equals_plain_lead(spark, levels):
    v = _hot_versions(spark)
    ref = v.withColumn("n", F.lead("ts").over(Window.partitionBy("k").orderBy("ts")))
    got = history.next_in_key(v, ["k"], "ts", "n", levels)
    assert rows(got) == rows(ref)


def test_scd2_intervals_contiguous_one_open(wh):
    h = history.rebuild_scd2(wh.stg_customers, ["customer_id"])
    assert h.groupBy("customer_id").agg(F.sum(F.col("valid_to").isNull().cast("int")).alias("o")) \
            .where("o != 1").count() == 0
    w = Window.partitionBy("customer_id").orderBy("valid_from")
    gaps = h.withColumn("prev_to", F.lag("valid_to").over(w)) \
            .where(F.col("prev_to").isNotNull() & (F.col("prev_to") != F.col("valid_from")))
    assert gaps.count() == 0
    assert h.where(F.col("valid_to") <= F.col("valid_from")).count() == 0


def test_scd2_batches_in_order_equal_rebuild_and_replay_is_noop(wh):
    s = wh.stg_customers
    cut = F.lit("1995-01-15").cast("timestamp_ntz")
    h1 = history.apply_scd2(None, s.where(F.col("created_at") <= cut), ["customer_id"]).checkpoint()
    h2 = history.apply_scd2(h1, s.where(F.col("created_at") > cut), ["customer_id"]).checkpoint()
    assert rows(h2) == rows(history.rebuild_scd2(s, ["customer_id"]))
    # re-delivering everything changes nothing (contract d)
    h3 = history.apply_scd2(h2, s, ["customer_id"])
    assert rows(h3) == rows(h2)


def test_scd2_hard_delete_and_reappear(spark):
    d = lambda n: dt.datetime(2000, 1, n)
    schema = "k long, v string, created_at timestamp_ntz, ingestion_ts timestamp_ntz"
    b1 = spark.createDataFrame([(1, "a", d(1), d(1)), (2, "b", d(1), d(1))], schema)
    h = history.apply_scd2(None, b1, ["k"]).checkpoint()
    h = history.apply_scd2(h, b1.where("k = 1"), ["k"], close_missing=True, now="2000-01-05 00:00:00").checkpoint()
    closed = {r.k: r.valid_to for r in h.collect()}
    assert closed == {1: None, 2: d(5)}
    # key 2 reappears with its old version: a new open row from the close time
    h = history.apply_scd2(h, b1, ["k"], close_missing=True, now="2000-01-09 00:00:00")
    got = sorted((r.k, r.valid_from, r.valid_to) for r in h.collect())
    assert got == [(1, d(1), None), (2, d(1), d(5)), (2, d(5), None)]


def test_decimal_sums_are_exact(wh):
    # money sums stay decimal end to end (no float drift)
    out = wh.sales_by_day.agg(F.sum("total_sales")).first()[0]
    assert isinstance(out, decimal.Decimal)
