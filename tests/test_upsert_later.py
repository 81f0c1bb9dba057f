"""Many small upserts: a batch is stored as it is, readers merge it, partitions are rewritten seldom."""

import os

import pytest

from martflow.operators.merge import merge_upsert
from martflow.plans import silver
from martflow.plans.scenarios import ENTITY_SCHEMAS
from martflow.sources import tables
from martflow.sources.landing import write_landing
from martflow.sources.tables import TableStore
from martflow.streaming.ingest import stream_upsert


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def _batch(spark, *values):
    if not values:  # the first load: large beside the batches
        return spark.range(10, 5000).selectExpr("id AS k", "sha2(string(id), 256) AS v", "make_timestamp_ntz(2010 + id % 4, 1, 1, 0, 0, 0) AS created_at")
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({k}L, '{v}', TIMESTAMP_NTZ '{at}')" for k, v, at in values) + " AS t(k, v, created_at)")


def _merge(old, new):
    return merge_upsert(old, new, ["k"], dedupe=False)


BATCHES = [
    [],
    [(11, "moved", "2013-05-01"), (12, "older", "2001-01-01"), (300, "new year", "2020-01-01")],
    [(11, "same time, later", "2013-05-01"), (300, "again", "2020-01-02"), (301, "late", "1999-01-01")],
    [(13, "back", "2013-01-02"), (301, "on", "2010-06-01")],
]


def test_later_is_what_upserts_in_turn_make(spark, scratch):
    now, later = TableStore(spark, scratch("now")), TableStore(spark, scratch("later"))
    for n, values in enumerate(BATCHES):
        now.upsert("core", "t", _batch(spark, *values), ["k"], _merge, grain="year")
        later.upsert_later("core", "t", _batch(spark, *values), ["k"], grain="year", cluster_by=["created_at"], meta={"stream_batch": n})
        assert _rows(later.read("core", "t")) == _rows(now.read("core", "t"))
        assert later.high_water_mark("core", "t") == now.high_water_mark("core", "t")
    first, last = later.commit_info("core", "t", 0), later.commit_info("core", "t")
    assert last["partitions"] == first["partitions"] and len(last["pending"]["folders"]) == 3  # nothing was rewritten
    assert _rows(later.read("core", "t", 1)) == _rows(now.read("core", "t", 1))
    for parts in (["2010"], ["2013", "2020"], ["1999"]):
        assert _rows(later.read_partitions("core", "t", parts)) == _rows(now.read_partitions("core", "t", parts))
    later.upsert_later("core", "t", _batch(spark, *BATCHES[1]).limit(0), ["k"], grain="year", meta={"stream_batch": 9}, empty=True)
    assert later.commit_info("core", "t")["pending"] == last["pending"] and later.commit_info("core", "t")["stream_batch"] == 9
    later.merge_pending("core", "t")
    merged = later.commit_info("core", "t")
    assert "pending" not in merged and merged["stream_batch"] == 9 and {"1999", "2010", "2013", "2020"} <= set(merged["touched"])
    assert _rows(later.read("core", "t")) == _rows(now.read("core", "t"))
    assert later.merge_pending("core", "t") == merged["version"]


@pytest.mark.parametrize("write", ["upsert", "append", "wider"])
def test_other_writes_keep_what_is_pending(spark, scratch, write):
    store, expected = TableStore(spark, scratch("store")), TableStore(spark, scratch("expected"))
    for values in BATCHES[:3]:
        store.upsert_later("core", "t", _batch(spark, *values), ["k"], grain="year")
        expected.upsert("core", "t", _batch(spark, *values), ["k"], _merge, grain="year")
    more = _batch(spark, (11, "newest", "2015-01-01"), (9000, "more", "2015-01-01"))
    if write == "append":
        more = more.where("k = 9000")
        store.append("core", "t", more)
        expected.append("core", "t", more)
    elif write == "upsert":
        store.upsert("core", "t", more, ["k"], _merge, grain="year")
        expected.upsert("core", "t", more, ["k"], _merge, grain="year")
    else:  # a batch with a further column is upserted at once
        more = more.selectExpr("*", "1 AS extra")
        store.upsert_later("core", "t", more, ["k"], grain="year")
        expected.upsert("core", "t", more, ["k"], _merge, grain="year")
    assert "pending" not in store.commit_info("core", "t")
    assert _rows(store.read("core", "t")) == _rows(expected.read("core", "t"))


def test_partitions_are_rewritten_when_the_pending_rows_have_grown(spark, scratch, monkeypatch):
    """Twelve batches over the same years: a few rewrites, not twelve."""
    store, rewrites = TableStore(spark, scratch("store")), []
    plain = store._write_partitioned
    monkeypatch.setattr(store, "_write_partitioned", lambda *a: rewrites.append(1) or plain(*a))
    for b in range(12):
        rows = [(b * 1000 + k, f"{b} {k * 7919 % 1000}", f"20{10 + k % 3}-01-{1 + k % 28:02d}") for k in range(300)]
        store.upsert_later("core", "t", _batch(spark, *rows), ["k"], grain="year")
    assert store.read("core", "t").count() == 3600 and len(rewrites) <= 6
    monkeypatch.setattr(tables, "PENDING_FOLDERS", 1)
    store.upsert_later("core", "t", _batch(spark, (1, "x", "2030-01-01")), ["k"], grain="year")
    assert "pending" not in store.commit_info("core", "t") and store.read("core", "t").count() == 3600


def test_redelivered_files_cost_no_rewrite_and_few_parts_of_state(spark, wh, scratch):
    """Each file three times: a rewrite for few of the batches, state in as many parts as tasks run at once and off the heap."""
    schema, src, store = ENTITY_SCHEMAS["orders"], scratch("landing"), TableStore(spark, scratch("store"))
    for upload in "abc":
        write_landing(wh.stg_orders, os.path.join(src, upload), schema, files=3)
    q = stream_upsert(spark, src, schema, store, "core", "fo", ["order_id"], silver.fact_orders, store.root + "-ckpt",
                      max_files_per_trigger=1, grain="year", redelivery="2 days")
    q.awaitTermination()
    state = [p["stateOperators"][0] for p in q.recentProgress]
    assert {s["numShufflePartitions"] for s in state} == {spark.sparkContext.defaultParallelism} == {4}
    assert "rocksdbGetCount" in state[0]["customMetrics"]
    records = [store.commit_info("core", "fo", v) for v in store.versions("core", "fo")]
    assert len(records) >= 9 and [r["mode"] for r in records].count("partitions") <= 3
    assert [r["stream_batch"] for r in records] == list(range(len(records)))
    assert _rows(store.read("core", "fo")) == _rows(wh.fact_orders)


def test_rows_told_apart_by_any_column(spark, scratch):
    """The entry of a row covers where its values begin, and which are missing."""
    schema, src, store, seen = ENTITY_SCHEMAS["orders"], scratch("landing"), TableStore(spark, scratch("store")), []
    header = ",".join(f.name for f in schema.fields)
    os.makedirs(src)
    lines = ["1,2,3,a,1,1,1,bc,2024-05-01T00:00:00", "1,2,3,ab,1,1,1,c,2024-05-01T00:00:00", "1,2,3,,1,1,1,abc,2024-05-01T00:00:00",
             "1,2,3,abc,1,1,1,,2024-05-01T00:00:00", "1,2,3,-,1,1,1,abc,2024-05-01T00:00:00", "12,,3,a,1,1,1,bc,2024-05-01T00:00:00"]
    with open(os.path.join(src, "f.csv"), "w") as f:
        f.write("\n".join([header, *lines, lines[0]]) + "\n")

    def model(rows):
        seen.append(rows.count())
        return silver.fact_orders(rows)
    stream_upsert(spark, src, schema, store, "core", "fo", ["order_id"], model, store.root + "-ckpt", redelivery="2 days").awaitTermination()
    assert sum(seen) == len(lines)
