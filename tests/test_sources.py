"""Landing CSV (with dirt), the versioned table store, file streams and the pipeline."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow import schemas
from martflow.plans import pipeline
from martflow.plans.scenarios import ENTITY_SCHEMAS
from martflow.plans.warehouse import Warehouse
from martflow.sources.landing import read_landing, write_landing
from martflow.sources.tables import TableStore
from martflow.streaming.ingest import read_landed, stream_landing

PRODUCTS_LANDING = schemas.products_schema()  # decimal(6,2), string keys: the landing contract


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple((v is not None, v) for v in r) for r in df.select(*cols).collect())


def _dirty_file(path, good_row):
    """Dirt from FIXTURES.md, built around a real product row."""
    pid, name, cat, brand, price, ts = good_row
    lines = [
        "product_id,product_name,category,brand,price,created_at",
        f"{pid},{name},{cat}",                                   # short row
        f"{pid},{name},{cat},{brand},{price},{ts},extra",        # extra field
        f"{pid},{name},{cat},{brand},abc,{ts}",                  # non-numeric amount
        f"{pid},{name},{cat},{brand},12345.67,{ts}",             # over 9999.99
        f'{pid},"{name}, deluxe",{cat},{brand},{price},{ts}',    # quoted comma (good)
        f'{pid},"",{cat},{brand},{price},{ts}',                  # empty quoted field (good, NULL)
        f"{pid},{name},{cat},{brand},{price},",                  # no version time
    ]
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "dirty.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_landing_quarantines_bad_rows(spark, wh, scratch):
    root = scratch("landing-products")
    clean = wh.stg_products.where("price > 0")
    write_landing(clean, os.path.join(root, "batch1"), PRODUCTS_LANDING, files=2)
    r = clean.orderBy("product_id").first()
    _dirty_file(os.path.join(root, "batch2"), (r.product_id, r.product_name, r.category, r.brand,
                                               r.price, r.created_at.isoformat()))
    good, bad = read_landing(spark, os.path.join(root, "*"), PRODUCTS_LANDING)
    reasons = sorted(x.reason for x in bad.collect())
    assert reasons == ["bad price", "bad price", "malformed row", "malformed row", "missing created_at"]
    assert good.count() == clean.count() + 2
    names = {x.product_name for x in good.where(F.col("product_id") == str(r.product_id)).collect()}
    assert f"{r.product_name}, deluxe" in names and None in names
    assert dict(good.dtypes)["price"] == "decimal(6,2)"


def test_table_store_versions_and_commit_conflict(spark, wh, scratch):
    store = TableStore(spark, scratch("store"))
    v0 = store.replace("core", "dim_store", wh.dim_store, hwm_col="created_at")
    v1 = store.replace("core", "dim_store", wh.dim_store.where("store_id < 50"))
    assert (v0, v1) == (0, 1)
    assert store.read("core", "dim_store").count() == wh.dim_store.where("store_id < 50").count()
    assert store.read("core", "dim_store", version=0).count() == wh.dim_store.count()
    assert store.commit_info("core", "dim_store", 0)["hwm"] == "1995-01-31 00:00:00"
    with pytest.raises(Exception):
        store._commit("core", "dim_store", {"version": 1, "data": []})  # version taken
    a0 = store.append("staging", "stg_stores", wh.stg_stores, hwm_col="created_at")
    a1 = store.append("staging", "stg_stores", wh.stg_stores)
    assert (a0, a1) == (0, 1)
    assert store.read("staging", "stg_stores").count() == 2 * wh.stg_stores.count()
    assert store.table_path("marts", "x").endswith("/marts/x")


def test_stream_equals_batch_and_replay_is_noop(spark, wh, scratch):
    schema = ENTITY_SCHEMAS["orders"]
    src, out = scratch("landing-orders"), scratch("staging-orders")
    write_landing(wh.stg_orders, os.path.join(src, "part1"), schema, files=3)
    ckpt = out + "-ckpt"
    stream_landing(spark, src + "/*", schema, out, ckpt, max_files_per_trigger=1).awaitTermination()
    landed = read_landed(spark, out)
    assert landed.select("load_batch").distinct().count() == 3  # one file per micro-batch
    batch, _ = read_landing(spark, src + "/*", schema)
    cols = [f.name for f in schema.fields]
    assert _rows(landed.select(*cols)) == _rows(batch.select(*cols))
    # same checkpoint, nothing new: no new batch, no duplicates
    stream_landing(spark, src + "/*", schema, out, ckpt).awaitTermination()
    assert read_landed(spark, out).count() == landed.count()
    # a new file is picked up alone
    write_landing(wh.stg_orders.where("order_id < 100"), os.path.join(src, "part2"), schema, files=1)
    stream_landing(spark, src + "/*", schema, out, ckpt).awaitTermination()
    assert read_landed(spark, out).count() == landed.count() + wh.stg_orders.where("order_id < 100").count()


def test_pipeline_is_idempotent_and_gated(spark, scratch):
    w = Warehouse(spark, "/root/testdata/sf0.001")
    store = TableStore(spark, scratch("warehouse"))
    pipeline.run_pipeline(w, store, grain="year")
    def counts():
        return (store.read("core", "fact_orders").count(), store.read("marts", "fct_sales").count(),
                pipeline.read_history(store, "customers_snapshot").count())
    first = counts()
    pipeline.run_pipeline(w, store, grain="year")  # same landing data again: nothing new
    assert counts() == first
    from martflow.operators.history import rebuild_scd2
    assert pipeline.read_history(store, "customers_snapshot").count() == \
        rebuild_scd2(w.stg_customers, ["customer_id"]).count()
    assert store.read("staging", "stg_orders").count() == w.stg_orders.count()
    # a broken silver table stops the build before gold
    bad = store.read("core", "fact_orders")
    store.replace("core", "fact_orders", bad.unionByName(bad.limit(1)))
    assert pipeline.check_silver(store)


def test_a_grown_folder_is_staged_whole(spark, scratch):
    folder, store = scratch("grown"), TableStore(spark, scratch("warehouse"))
    source = "/root/testdata/sf0.001"
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    for t in ("region", "nation", "customer", "supplier", "part", "events", *keys):
        rows = spark.read.parquet(f"{source}/{t}.parquet")
        (rows.where(f"{keys[t]} % 3 != 0") if t in keys else rows).write.parquet(f"{folder}/{t}.parquet")
    pipeline.load_staging(Warehouse(spark, folder), store)
    first = store.read("staging", "stg_orders").count()
    for t, key in keys.items():  # later and late rows, some of them twice, under the same path
        rows = spark.read.parquet(f"{source}/{t}.parquet").where(f"{key} % 3 = 0")
        rows.union(rows.where(f"{key} % 2 = 0")).write.mode("append").parquet(f"{folder}/{t}.parquet")
    w = Warehouse(spark, folder)
    for _ in range(2):  # the second time brings nothing new
        pipeline.load_staging(w, store)
        for name in ("stg_orders", "stg_orderitems"):
            staged, landed = store.read("staging", name), getattr(w, name)
            assert staged.count() == landed.count() and staged.exceptAll(landed).isEmpty()
    assert store.read("staging", "stg_orders").count() > first


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, wh, scratch):
    from martflow.operators.merge import merge_upsert
    from martflow.plans import silver
    store = TableStore(spark, scratch("store"))
    keys = ["order_id"]
    fn = lambda ex, inc: merge_upsert(ex, inc, keys, late_policy="merge", dedupe=False)
    first = silver.fact_orders(wh.stg_orders.where("created_at < TIMESTAMP_NTZ'1998-01-01'"))
    store.upsert("core", "fo", first, keys, fn, grain="year")
    before = store.commit_info("core", "fo")["partitions"]
    # revisions of 1997 orders arriving in 1998 plus new 1998 orders
    second = silver.fact_orders(wh.stg_orders.where("created_at >= TIMESTAMP_NTZ'1997-12-20'"))
    store.upsert("core", "fo", second, keys, fn, grain="year")
    after = store.commit_info("core", "fo")["partitions"]
    untouched = [p for p in before if p < "1997"]
    assert untouched and all(after[p] == before[p] for p in untouched)   # carried by reference
    assert after["1997"] != before["1997"]                                 # old versions replaced
    assert _rows(store.read("core", "fo")) == _rows(silver.fact_orders(
        wh.stg_orders.where("created_at < TIMESTAMP_NTZ'1998-01-01' OR created_at >= TIMESTAMP_NTZ'1997-12-20'")))


def test_ensure_creates_empty_table_once_and_layers_resolve(spark, scratch):
    from martflow.schemas import Layers
    store = TableStore(spark, scratch("store"), Layers(staging="STAGING", core="CORE", marts="MARTS"))
    schema = ENTITY_SCHEMAS["orders"]
    assert store.ensure("staging", "orders", schema) == 0
    df = store.read("staging", "orders")
    assert df.count() == 0 and df.columns == [f.name for f in schema.fields] + ["ingestion_ts"]
    assert store.ensure("staging", "orders", schema) == 0        # already there: no new version
    assert "/STAGING/orders" in store.table_path("staging", "orders")
    assert Layers().resolve("marts", "CUSTOM") == "CUSTOM"        # explicit name wins


def test_stream_upsert_survives_failure_and_replay(spark, wh, scratch):
    """A batch that fails mid-way is applied exactly once after restart; a batch
    delivered again after its commit is a no-op."""
    from martflow.plans import silver
    from martflow.sources.landing import csv_options, raw_schema, with_source_file
    from martflow.streaming.ingest import stream_upsert, upsert_batch_fn
    schema = ENTITY_SCHEMAS["orders"]
    src = scratch("landing-orders")
    write_landing(wh.stg_orders, os.path.join(src, "p"), schema, files=3)
    store = TableStore(spark, scratch("store"))
    ckpt = store.root + "-ckpt"
    calls = {"n": 0}

    def flaky(df):
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("executor lost")
        return silver.fact_orders(df)

    q = stream_upsert(spark, src + "/*", schema, store, "core", "fo", ["order_id"], flaky, ckpt,
                      max_files_per_trigger=1, grain="year")
    with pytest.raises(Exception):
        q.awaitTermination()
    assert store.commit_info("core", "fo")["stream_batch"] == 0
    q = stream_upsert(spark, src + "/*", schema, store, "core", "fo", ["order_id"], silver.fact_orders,
                      ckpt, max_files_per_trigger=1, grain="year")
    q.awaitTermination()
    expected = _rows(wh.fact_orders)
    assert _rows(store.read("core", "fo")) == expected
    # re-deliver the last batch by hand: already committed, nothing changes
    last = store.commit_info("core", "fo")
    fn = upsert_batch_fn(schema, store, "core", "fo", ["order_id"], silver.fact_orders, grain="year")
    raw = with_source_file(spark.read.schema(raw_schema(schema)).options(**csv_options()).csv(src + "/*"))
    fn(raw, last["stream_batch"])
    assert store.commit_info("core", "fo")["version"] == last["version"]
    assert _rows(store.read("core", "fo")) == expected


def test_landing_pipeline_second_run_loads_only_new_file(spark, wh, scratch):
    from martflow.plans.pipeline import run_pipeline_from_landing
    root, store = scratch("landing-all"), TableStore(spark, scratch("warehouse"))
    for e, sch in ENTITY_SCHEMAS.items():
        write_landing(getattr(wh, f"stg_{e}"), f"{root}/{e}/batch1", sch, files=2)
    ckpt = store.root + "-ckpt"
    run_pipeline_from_landing(spark, root, store, ENTITY_SCHEMAS, ckpt, grain="year")
    n_orders = store.read("core", "fact_orders").count()
    staged = store.read("staging", "stg_orders").count()
    # a later file: a revision of every 'F' order, ten years later
    rev = (wh.stg_orders.where("order_status = 'F'")
           .withColumn("order_status", F.lit("F2"))
           .withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 3650 DAYS")))
    write_landing(rev, f"{root}/orders/batch2", ENTITY_SCHEMAS["orders"], files=1)
    run_pipeline_from_landing(spark, root, store, ENTITY_SCHEMAS, ckpt, grain="year")
    assert store.read("staging", "stg_orders").count() == staged + rev.count()   # only the new file
    fo = store.read("core", "fact_orders")
    assert fo.count() == n_orders                                                 # upsert, no duplicates
    assert fo.where("order_status = 'F2'").count() == rev.where("order_id IS NOT NULL").select("order_id").distinct().count()
    assert store.read("marts", "fct_sales").where("order_status = 'F2'").count() == \
        rev.where("order_id IS NOT NULL").select("order_id").distinct().count()
    # the partition-wise rebuilt mart equals a full rebuild from the stored silver tables
    from martflow.plans import gold
    full = gold.fct_sales(store.read("core", "fact_orders"), store.read("core", "fact_orderitems"),
                          store.read("core", "dim_customer"), store.read("core", "dim_store"))
    assert _rows(store.read("marts", "fct_sales")) == _rows(full)
    # nothing new landed: no partition of the mart is recomputed
    run_pipeline_from_landing(spark, root, store, ENTITY_SCHEMAS, ckpt, grain="year")
    assert store.commit_info("marts", "fct_sales")["touched"] == []
    assert _rows(store.read("marts", "fct_sales")) == _rows(full)
    # a later customers file renames some customers: only their orders' partitions change
    renamed = (wh.stg_customers.where("customer_id % 7 = 3 AND last_name IS NOT NULL AND first_name IS NOT NULL")
               .withColumn("last_name", F.lit("RENAMED"))
               .withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 400 DAYS")))
    write_landing(renamed, f"{root}/customers/batch2", ENTITY_SCHEMAS["customers"], files=1)
    run_pipeline_from_landing(spark, root, store, ENTITY_SCHEMAS, ckpt, grain="year")
    mart = store.read("marts", "fct_sales")
    full = gold.fct_sales(store.read("core", "fact_orders"), store.read("core", "fact_orderitems"),
                          store.read("core", "dim_customer"), store.read("core", "dim_store"))
    assert _rows(mart) == _rows(full)
    assert mart.where("last_name = 'RENAMED'").count() > 0


def test_landing_pipeline_merge_policy_applies_late_revisions(spark, wh, scratch):
    """Late revisions (older than the target's mark, newer than their own stored
    row) are dropped by the parity policy but applied by late_policy='merge',
    which reads only the staging folders added since the last build."""
    from martflow.plans import silver
    from martflow.plans.pipeline import run_pipeline_from_landing
    root, store = scratch("landing-all"), TableStore(spark, scratch("warehouse"))
    for e, sch in ENTITY_SCHEMAS.items():
        write_landing(getattr(wh, f"stg_{e}"), f"{root}/{e}/batch1", sch, files=2)
    ckpt = store.root + "-ckpt"
    run = lambda: run_pipeline_from_landing(spark, root, store, ENTITY_SCHEMAS, ckpt,
                                            late_policy="merge", grain="year")
    run()
    late = (wh.stg_orders.where("order_status = 'O'")
            .withColumn("order_status", F.lit("O2"))
            .withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 2 HOURS")))
    write_landing(late, f"{root}/orders/batch2", ENTITY_SCHEMAS["orders"], files=1)
    run()
    fo = store.read("core", "fact_orders")
    staged = store.read("staging", "stg_orders").drop("ingestion_ts").withColumn(
        "ingestion_ts", F.col("created_at"))
    assert _rows(fo) == _rows(silver.fact_orders(staged))
    # every late revision wins, except where the order also has a later 'R' version
    winners = late.join(wh.stg_orders.where("order_status = 'R'"), "order_id", "left_anti")
    assert fo.where("order_status = 'O2'").count() == winners.where("order_id IS NOT NULL").select("order_id").distinct().count() > 0


# safety of the store --------------------------------------------------------------

def _keep_new(existing, incoming):
    from martflow.operators.merge import merge_upsert
    return merge_upsert(existing, incoming, ["order_id"], late_policy="merge", dedupe=False)


def test_a_commit_in_between_is_not_lost(spark, wh, scratch):
    """A writer that read version n fails if version n + 1 appeared meanwhile."""
    from martflow.plans import silver
    store = TableStore(spark, scratch("store"))
    orders = silver.fact_orders(wh.stg_orders)
    store.upsert("core", "fo", orders.where("order_id < 100"), ["order_id"], _keep_new, grain="year")

    def slow(existing, incoming):  # another writer commits while this one merges
        store.upsert("core", "fo", orders.where("order_id BETWEEN 100 AND 199"), ["order_id"], _keep_new, grain="year")
        return _keep_new(existing, incoming)
    with pytest.raises(Exception, match="(?i)exist"):
        store.upsert("core", "fo", orders.where("order_id BETWEEN 200 AND 299"), ["order_id"], slow, grain="year")
    assert _rows(store.read("core", "fo")) == _rows(orders.where("order_id < 200"))


def test_a_torn_record_is_no_version(spark, wh, scratch):
    store = TableStore(spark, scratch("store"))
    v = store.replace("core", "ds", wh.dim_store)
    open(os.path.join(store.table_path("core", "ds"), "_commits", f"{v + 1:020d}.json"), "w").close()
    open(os.path.join(store.table_path("core", "ds"), "_commits", f".{v + 1:020d}-ab.tmp"), "w").write("{")
    assert store.versions("core", "ds") == [v]
    assert store.read("core", "ds").count() == wh.dim_store.count()


def test_partition_grain_belongs_to_the_table(spark, wh, scratch):
    from martflow.plans import silver
    store = TableStore(spark, scratch("store"))
    orders = silver.fact_orders(wh.stg_orders)
    store.upsert("core", "fo", orders, ["order_id"], _keep_new, grain="year")
    with pytest.raises(ValueError, match="partitioned"):
        store.upsert("core", "fo", orders, ["order_id"], _keep_new, grain="day")


def test_empty_and_evolving_tables_are_read_with_their_schema(spark, wh, scratch):
    from martflow.plans import silver
    store = TableStore(spark, scratch("store"))
    orders = silver.fact_orders(wh.stg_orders)
    store.upsert("core", "fo", orders.where("false"), ["order_id"], _keep_new, grain="year")
    df = store.read("core", "fo")
    assert df.count() == 0 and df.columns == orders.columns
    store.append("core", "log", wh.stg_stores.drop("country"))
    for _ in range(22):  # past a whole record
        store.append("core", "log", wh.stg_stores.where("store_id = 1"))
    df = store.read("core", "log")
    assert df.columns[-1] == "country" and df.count() == wh.stg_stores.count() + 22 * wh.stg_stores.where("store_id = 1").count()
    assert df.where("country IS NOT NULL").count() == 22 * wh.stg_stores.where("store_id = 1 AND country IS NOT NULL").count()
    assert store.read_new("core", "log", 20).count() == 2 * wh.stg_stores.where("store_id = 1").count()


def test_stream_upsert_quarantines_malformed_rows_once(spark, wh, scratch):
    from martflow.plans import silver
    from martflow.streaming.ingest import stream_upsert
    schema = schemas.orders_schema(money=schemas.LANDING_MONEY, key_type=T.LongType())
    src = scratch("landing-orders")
    write_landing(wh.stg_orders, os.path.join(src, "p"), ENTITY_SCHEMAS["orders"])
    store = TableStore(spark, scratch("store"))
    for _ in range(2):
        stream_upsert(spark, src + "/*", schema, store, "core", "fo", ["order_id"], silver.fact_orders, store.root + "-ckpt",
                      grain="year").awaitTermination()
    _, bad = read_landing(spark, src + "/*", schema)
    assert store.read("core", "fo_quarantine").count() == bad.count() > 0


def test_nothing_landed_yet_leaves_empty_tables(spark, scratch):
    store = TableStore(spark, scratch("warehouse"))
    out = pipeline.load_staging_from_landing(spark, scratch("landing-none"), store, ENTITY_SCHEMAS, store.root + "-ckpt")
    assert set(out.values()) == {0} and store.read("staging", "stg_orders").count() == 0


def test_quoted_line_breaks_need_multiline(spark, scratch):
    path = scratch("landing-break")
    os.makedirs(path)
    with open(os.path.join(path, "f.csv"), "w") as f:
        f.write('a,b,c,d,e,f\np1,"two\nlines",c,b,1.50,1995-01-01T00:00:00\n')
    good, bad = read_landing(spark, path, PRODUCTS_LANDING, multiline=True)
    assert [r.product_name for r in good.collect()] == ["two\nlines"] and bad.count() == 0
    good, bad = read_landing(spark, path, PRODUCTS_LANDING)
    assert good.count() == 0 and bad.count() == 2


def test_the_session_keeps_its_csv_settings(spark, wh, scratch):
    before = spark.conf.get("spark.sql.csv.parser.columnPruning.enabled")
    path = scratch("landing-stores")
    write_landing(wh.stg_stores, path, ENTITY_SCHEMAS["stores"])
    assert read_landing(spark, path, ENTITY_SCHEMAS["stores"])[0].count() == wh.stg_stores.count()
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == before


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as N
    from martflow.session import checkpoint_root
    none = N(isDefined=lambda: False)
    context = N(master="spark://host:7077", _jsc=N(sc=lambda: N(getCheckpointDir=lambda: none)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(N(conf=N(get=lambda *_: None), sparkContext=context))


def test_second_load_scenarios_have_work_to_do(spark, wh):
    from martflow.plans import scenarios
    from martflow.plans.registry import QUERIES
    first = scenarios.load1(wh.stg_orders)
    run = lambda name: QUERIES[name](spark, "/root/testdata/sf0.001")
    assert run("stage_append_newer").count() > first.count()
    late = run("late_orders_dropped").count()
    assert 0 < late < wh.stg_orders.count()
    assert run("versions_customers").count() < wh.stg_customers.count()
    assert run("scd2_products").where("valid_to IS NOT NULL").count() > 0
    assert run("scd2_stores").where("valid_to IS NOT NULL").count() > 0
    assert {r.table_name: r.late_dropped for r in run("pipeline_late_drop_counts").collect()}["fact_orders"] > 0
    fallen_back = wh.stg_customers.where("last_name = 'CHANGED2' AND first_name IS NULL").select("customer_id")
    assert wh.dim_customer.join(fallen_back, "customer_id").where("last_name = 'CHANGED'").count() > 0


def test_upsert_searches_only_partitions_without_incoming_rows(spark, scratch, monkeypatch):
    """Partitions that receive rows are rewritten anyway; of the others only those with a stored row of an incoming key are."""
    from martflow.operators.merge import merge_upsert
    store = TableStore(spark, scratch("store"))

    def rows(*values):
        return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({k}L, '{v}', TIMESTAMP_NTZ '{at}')" for k, v, at in values)
                         + " AS t(k, v, created_at)")

    def upsert(batch):
        store.upsert("core", "t", batch, ["k"], lambda old, new: merge_upsert(old, new, ["k"], dedupe=False), grain="year")

    upsert(rows((1, "a", "2019-01-01"), (2, "b", "2020-01-01"), (3, "c", "2021-01-01"), (4, "d", "2022-01-01")))
    searched, plain = [], store.read_partitions
    monkeypatch.setattr(store, "read_partitions", lambda layer, name, parts, *a: searched.append(set(parts)) or plain(layer, name, parts, *a))
    with monkeypatch.context() as m:
        m.setattr(store, "read", lambda *a: pytest.fail("the whole table is read"))
        upsert(rows((2, "moved", "2021-06-01"), (5, "new", "2021-07-01")))
        assert searched == [{"2019", "2020", "2022"}, {"2020", "2021"}]
    assert store.commit_info("core", "t")["touched"] == ["2020", "2021"]
    assert sorted((r.k, r.v) for r in store.read("core", "t").collect()) == [(1, "a"), (2, "moved"), (3, "c"), (4, "d"), (5, "new")]


def test_merge_shuffles_a_key_once(spark):
    from martflow.operators.merge import merge_upsert
    old = spark.sql("SELECT 1L AS k, TIMESTAMP_NTZ '2020-01-01' AS created_at, 'old' AS v")
    new = spark.sql("SELECT 'new' AS v, TIMESTAMP_NTZ '2021-01-01' AS created_at, 1L AS k UNION ALL SELECT 'n', NULL, 2L UNION ALL SELECT 'm', NULL, NULL")
    out = merge_upsert(old, new, ["k"], dedupe=False)
    assert out.columns == old.columns
    assert sorted(((r.k, r.v) for r in out.collect()), key=str) == [(1, "new"), (2, "n"), (None, "m")]
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "struct(created_at" in plan and "struct(k" not in plan


def test_derived_columns_are_computed_by_the_write(spark, scratch):
    """The exchange of a partitioned write carries no column that follows from others: what it held is not used."""
    from martflow.operators.merge import merge_upsert
    store = TableStore(spark, scratch("derived"))
    rows = spark.sql("SELECT id, id * 2 AS other, 'carried' AS both, timestamp_ntz '1995-01-01' + make_dt_interval(CAST(id AS INT)) AS created_at "
                     "FROM range(40)")
    derived = {"both": F.concat_ws("_", "id", "other")}
    for batch in (rows.where("id < 30"), rows.where("id >= 20")):
        store.upsert("core", "t", batch, ["id"], lambda old, new: merge_upsert(old, new, ["id"], dedupe=False), grain="month",
                     cluster_by=["created_at", "id"], derived=derived)
    got = store.read("core", "t")
    assert got.columns == rows.columns
    assert sorted(r.both for r in got.collect()) == sorted(f"{i}_{2 * i}" for i in range(40))
