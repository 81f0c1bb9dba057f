"""Rows delivered again do not reach the upsert; late and corrected ones do."""

from martflow import schemas
from martflow.plans import silver
from martflow.sources.tables import TableStore
from martflow.streaming.ingest import stream_upsert

HEADER = "order_id,customer_id,store_id,order_status,total_amount,discount_amount,shipping_cost,payment_type,created_at\n"
FIRST = ["o1,c,s,Pending,10.00,0,0,PayPal,2024-05-01T00:00:00", "o2,c,s,Pending,20.00,0,0,PayPal,2024-05-01T00:00:00"]
LATE = "o3,c,s,Pending,30.00,0,0,PayPal,2020-01-01T00:00:00"  # far older than anything seen
CORRECTED = "o1,c,s,Shipped,10.00,0,0,PayPal,2024-05-02T00:00:00"
BROKEN = "o9,c,s,Pending,many,0,0,PayPal,2024-05-01T00:00:00"


def test_redelivered_rows_stop_at_the_state(spark, scratch):
    src, store = scratch("landing"), TableStore(spark, scratch("store"))
    schema, seen = schemas.orders_schema(), []

    def land(name, lines):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{src}/{name}.csv")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray((HEADER + "\n".join(lines) + "\n").encode()))
        out.close()

    def model(rows):
        seen.append(sorted(r.order_id for r in rows.collect()))
        return silver.fact_orders(rows)

    def run(checkpoint="one"):
        seen.clear()
        stream_upsert(spark, src, schema, store, "core", "fact_orders", ["order_id"], model,
                      checkpoint=f"{store.root}-{checkpoint}", max_files_per_trigger=1, redelivery="2 days").awaitTermination()
        return [x for x in seen if x]

    land("1", [*FIRST, BROKEN])
    land("2", [*FIRST, FIRST[0], BROKEN])  # delivered again, one row twice
    assert run() == [["o1", "o2"]]
    before = store.versions("core", "fact_orders")
    land("3", [*FIRST, LATE, CORRECTED])  # after a restart: the state is in the checkpoint
    assert run() == [["o1", "o3"]]
    assert run() == [] and len(store.versions("core", "fact_orders")) > len(before)
    rows = {r.order_id: r.order_status for r in store.read("core", "fact_orders").collect()}
    assert rows == {"o1": "Shipped", "o2": "Pending", "o3": "Pending"}
    assert store.read("core", "fact_orders_quarantine").count() == 1
    # replay from nothing (a lost checkpoint): batches that the table has applied are skipped, the table stays
    run("two")
    assert {r.order_id: r.order_status for r in store.read("core", "fact_orders").collect()} == rows


def test_upserts_have_tasks_for_the_batch_and_not_for_the_state(spark, scratch):
    """A batch with keyed state has a part per shuffle partition; the model and the upsert read it packed by size."""
    src, store = scratch("landing"), TableStore(spark, scratch("store"))
    schema, parts = schemas.orders_schema(), []
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{src}/1.csv")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray((HEADER + "\n".join(FIRST) + "\n").encode()))
    out.close()

    def model(rows):
        parts.append(rows.rdd.getNumPartitions())
        return silver.fact_orders(rows)

    stream_upsert(spark, src, schema, store, "core", "fact_orders", ["order_id"], model,
                  checkpoint=f"{store.root}-ckpt", redelivery="2 days").awaitTermination()
    assert parts[0] < int(spark.conf.get("spark.sql.shuffle.partitions")) and store.read("core", "fact_orders").count() == 2
