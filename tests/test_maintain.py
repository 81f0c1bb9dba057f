"""Maintained aggregates equal the aggregate over all rows; only what changed is read."""

import datetime as dt
import decimal
import random

from pyspark.sql import functions as F

from martflow.operators import maintain
from martflow.operators.maintain import Measures, aggregate, apply_delta, maintained

SCHEMA = "part int, g string, x decimal(12,2), t timestamp_ntz"
M = Measures(("g",), {"total": "x"}, {"first": "t"}, {"last": "t"})
NOTHING = "part int, g string, x decimal(12,2), t timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame([(p, g, None if x is None else decimal.Decimal(x), None if t is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=t))
                                  for p, g, x, t in rows], SCHEMA)


def state_rows(df):
    return sorted(map(tuple, df.select(*M.columns).collect()), key=str)


def step(spark, old, new, parts):
    """State after the rows of ``parts`` turned from ``old`` to ``new``, and the changed groups."""
    state = aggregate(frame(spark, old), M).checkpoint()
    before, after = (frame(spark, [r for r in rows if r[0] in parts]) for rows in (old, new))
    touched, rows = apply_delta(state, before, after, frame(spark, new), M)
    return state_rows(maintained(state, touched, rows, M)), sorted(str(r.g) for r in touched.collect())


def test_retracted_extreme_is_recomputed_and_empty_group_goes(spark):
    old = [(1, "a", 5, 1), (2, "a", 7, 9), (2, "b", 1, 4), (1, None, 3, 2), (1, "c", None, 3), (2, "c", 2, 3)]
    new = [(1, "a", 5, 1), (2, "a", 8, 4), (1, None, 3, 2), (1, "c", None, 3)]  # a loses its last day, b its row, c its sum
    got, touched = step(spark, old, new, {2})
    assert got == state_rows(aggregate(frame(spark, new), M)) and touched == ["a", "b", "c"]
    assert next(r for r in got if r[0] == "c")[2] is None


def test_unchanged_rows_touch_no_group_and_read_no_source(spark):
    old = [(1, "a", 5, 1), (2, "a", 7, 9), (2, None, 1, 4)]
    broken = frame(spark, old).withColumn("t", F.raise_error(F.lit("the source is not read")).cast("timestamp_ntz"))
    state = aggregate(frame(spark, old), M).checkpoint()
    part = frame(spark, [r for r in old if r[0] == 2])
    touched, rows = apply_delta(state, part, part, broken, M)
    assert touched.isEmpty() and rows.isEmpty()
    more = part.unionByName(frame(spark, [(2, "a", 1, 20)]))  # a later day replaces the extreme: still no read
    touched, rows = apply_delta(state, part, more, broken, M)
    assert [(r._rows, str(r.total), r.last.day) for r in rows.collect()] == [(3, "13.00", 21)]


def test_random_changes_equal_the_whole_aggregate(spark):
    rnd = random.Random(5)
    row = lambda p: (p, rnd.choice(["hot", "hot", "a", "b", None]), rnd.choice([None, -2, 3, 4]), rnd.choice([None, *range(9)]))
    old = [row(rnd.randrange(4)) for _ in range(60)]
    for _ in range(3):
        parts = {rnd.randrange(4), rnd.randrange(4)}
        new = [r for r in old if r[0] not in parts or rnd.random() < 0.6] + [row(p) for p in parts for _ in range(rnd.randrange(4))]
        assert step(spark, old, new, parts)[0] == state_rows(aggregate(frame(spark, new), M))
        old = new


def test_empty_change_and_empty_state(spark):
    none = spark.createDataFrame([], NOTHING)
    state = aggregate(none, M).checkpoint()
    some = frame(spark, [(1, "a", 5, 1), (1, None, 2, 2)])
    touched, rows = apply_delta(state, none, some, some, M)
    assert state_rows(maintained(state, touched, rows, M)) == state_rows(aggregate(some, M))
    assert apply_delta(state, none, none, none, M)[0].isEmpty()
    assert [c for c in maintain.delta(none, some, M).columns if c.startswith("_d")] == ["_d_rows", "_d_total", "_dn_total"]


def test_second_build_reads_the_rewritten_partitions_only(spark, wh):
    from martflow.plans.marts import MARTS
    from martflow.plans.pipeline import FACTS, build_mart
    from martflow.operators.merge import merge_upsert
    from martflow.session import scratch_dir
    from martflow.sources.tables import TableStore
    store, (_, model, keys, _) = TableStore(spark, scratch_dir(spark, "store")), FACTS["fact_orders"]
    orders = model(wh.stg_orders).checkpoint()
    merge = lambda old, new: merge_upsert(old, new, keys, dedupe=False)
    store.upsert("core", "fact_orders", orders, keys, merge, grain="year")
    build_mart(store, "sales_by_day")
    assert "partitions_read" not in store.commit_info("marts", "sales_by_day_state")
    changed = orders.where("order_id % 7 = 0 and year(created_at) = 1995").withColumn(
        "created_at", F.expr("created_at + interval 1 minute")).withColumn("total_amount", F.lit(1).cast("decimal(12,2)"))
    store.upsert("core", "fact_orders", changed, keys, merge, grain="year")
    build_mart(store, "sales_by_day")
    assert store.commit_info("marts", "sales_by_day_state")["partitions_read"] == ["1995"]
    mart = MARTS["sales_by_day"]
    whole = mart.finish(aggregate(mart.prepare(store.read("core", "fact_orders")), mart.measures), None)
    got = store.read("marts", "sales_by_day")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.select(*got.columns).collect()))
    version = store.versions("marts", "sales_by_day_state")
    build_mart(store, "sales_by_day")  # nothing new: the state stays as it is
    assert store.versions("marts", "sales_by_day_state") == version
