"""Late versions: a history to which batches are applied in any order equals the rebuild."""

import datetime as dt
import random

from pyspark.sql import functions as F

from martflow.operators import history

SCHEMA = "k string, v string, created_at timestamp_ntz, ingestion_ts timestamp_ntz"
DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, START + t * DAY, START + load * DAY) for k, v, t, load in rows], SCHEMA)


def stored(spark, rows):
    return history.rebuild_scd2(frame(spark, rows), ["k"]).checkpoint()


def intervals(df):
    return sorted((r.k, r.v, (r.valid_from - START).days, r.valid_to and (r.valid_to - START).days) for r in df.collect())


def test_late_version_cuts_the_interval_that_holds_it(spark):
    h = stored(spark, [("a", "a0", 0, 0), ("a", "a9", 9, 9), ("b", "b0", 0, 0), ("b", "b9", 9, 9)])
    batch = frame(spark, [("a", "a4", 4, 20), ("a", "a6", 6, 20), ("a", "a-", -3, 20), ("a", "a0", 0, 0)])
    opened, closed = h.where("valid_to IS NULL"), h.where("valid_to IS NOT NULL")
    retired, replacing = history.late_changes(opened, closed, batch, ["k"])
    assert intervals(retired) == [("a", "a0", 0, 9)]
    assert intervals(replacing) == [("a", "a-", -3, 0), ("a", "a0", 0, 4), ("a", "a4", 4, 6), ("a", "a6", 6, 9)]
    whole = history.apply_scd2(h, batch, ["k"], late="split").checkpoint()
    assert intervals(whole) == intervals(replacing) + [("a", "a9", 9, None), ("b", "b0", 0, 9), ("b", "b9", 9, None)]
    again = history.late_changes(whole.where("valid_to IS NULL"), whole.where("valid_to IS NOT NULL"), batch, ["k"])
    assert all(df.isEmpty() for df in again)  # idempotent
    assert intervals(history.apply_scd2(h, batch, ["k"])) == intervals(h)  # by default late versions change nothing


def test_late_version_beside_a_hard_delete(spark):
    h = stored(spark, [("a", "a0", 0, 0), ("b", "b0", 0, 0)])
    gone = history.apply_scd2(h, frame(spark, [("b", "b0", 0, 0)]), ["k"], close_missing=True, now=str(START + 10 * DAY)).checkpoint()
    back = history.apply_scd2(gone, frame(spark, [("a", "a20", 20, 20)]), ["k"]).checkpoint()
    assert intervals(back) == [("a", "a0", 0, 10), ("a", "a20", 20, None), ("b", "b0", 0, None)]
    late = history.apply_scd2(back, frame(spark, [("a", "a5", 5, 30), ("a", "a15", 15, 30)]), ["k"], late="split")
    assert intervals(late) == [("a", "a0", 0, 5), ("a", "a15", 15, 20), ("a", "a20", 20, None), ("a", "a5", 5, 10),
                               ("b", "b0", 0, None)]


def test_newer_copy_replaces_attributes_and_keeps_the_interval(spark):
    h = stored(spark, [("a", "old", 0, 0), ("a", "a9", 9, 9)])
    batch = frame(spark, [("a", "new", 0, 1), ("a", "a3", 3, 3), ("a", "older", 9, 8)])
    out = history.apply_scd2(h, batch, ["k"], late="split")
    assert intervals(out) == [("a", "a3", 3, 9), ("a", "a9", 9, None), ("a", "new", 0, 3)]


def test_any_order_equals_the_rebuild(spark):
    rnd = random.Random(3)
    # one key has a third of all versions; repeated versions differ in load stamp and attributes
    rows = [(rnd.choice(["hot", "hot", *"abcd"]), f"v{i}", rnd.randrange(40), i) for i in range(60)]
    h = None
    for low in range(0, 60, 20):
        part = [r for j, r in enumerate(rows) if low <= (j * 37) % 60 < low + 20]
        h = history.apply_scd2(h, frame(spark, part), ["k"], late="split", levels=("year",)).checkpoint()
    want = history.rebuild_scd2(frame(spark, rows), ["k"], levels=())
    assert sorted(map(tuple, h.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert h.where(F.col("valid_to").isNull()).groupBy("k").count().where("count > 1").isEmpty()
