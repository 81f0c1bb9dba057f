"""Continuous landing of order files (Structured Streaming).

``stream_landing``  each new CSV file under a prefix is loaded exactly once: the
                    file source's checkpoint is the ledger of loaded files.
                    Every micro-batch is typed, stamped with one load time and
                    split into good rows and quarantine; both are written to a
                    folder named after the batch id, so a replayed batch
                    overwrites its own output instead of duplicating it.
``stream_upsert``   the silver form: each micro-batch is cleaned, reduced to the
                    newest row per key and upserted into a stored table.  The
                    applied batch id is recorded in the table's commit, so a
                    replay after a failure is a no-op.

                    With ``redelivery`` rows that were delivered before within
                    that time never reach the upsert: they are dropped by keyed
                    state of the stream.

``row_number`` cannot run on a stream directly, hence ``foreachBatch``; the
late-row rule of the original (drop rows not newer than the target's max) is
the ``late_policy="drop"`` option, not a watermark (a watermark bounds state,
it does not compare against the stored table).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martflow.operators.clean import newer_than
from martflow.operators.merge import late_count
from martflow.session import scratch_dir
from martflow.sources.landing import SOURCE_FILE, csv_options, raw_schema, split_good_bad, type_rows, with_source_file
from martflow.sources.tables import TableStore

BATCH_COL = "load_batch"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def landing_stream(spark: SparkSession, path: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None, multiline: bool = False) -> DataFrame:
    reader = spark.readStream.schema(raw_schema(schema)).options(**csv_options(multiline))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_source_file(reader.csv(path))


def state_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` for a stream with keyed state.

    The state lies in RocksDB, not on the executors' heap, and a micro-batch saves its
    changes only.  Each part of the state is opened and saved by a task in every
    micro-batch, however few rows it has, so there are no more parts than tasks that run
    at once.  Both hold for new checkpoints; an old one keeps what it was started with.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    for key, value in STATE_CONF.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", str(parts))
    return session


def without_redelivered(raw: DataFrame, within: str) -> DataFrame:
    """Each landed row once, however often it is delivered ``within`` that time (as "2 days").

    The state holds one entry per row (a SHA-256 of all its landed columns: a corrected
    row of the same version time is another one) and is cleared by a watermark, for which
    each micro-batch looks through all entries, so they are kept short.  The watermark
    follows the time of arrival and not the version time: one on the version time
    would drop late orders, which the upsert must see, and no row is late by its
    arrival.  A row delivered again after that time reaches the upsert, which
    ignores versions that are not newer.  Malformed rows are delivered once, too.
    """
    landed = [c for c in raw.columns if c != SOURCE_FILE]
    # each value behind its length, so no two rows have the same text
    text = F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in landed])
    return (raw.withColumns({"_landed": F.unhex(F.sha2(text, 256)), "_arrived": F.current_timestamp()}).withWatermark("_arrived", within)
            .dropDuplicatesWithinWatermark(["_landed"]).drop("_landed", "_arrived"))


def _start(df: DataFrame, fn, checkpoint: str, trigger: str, name: str | None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start()


def stream_landing(spark: SparkSession, path: str, schema: T.StructType, target: str,
                   checkpoint: str, trigger: str = "availableNow",
                   max_files_per_trigger: int | None = None, name: str | None = None) -> StreamingQuery:
    """Land every new file under ``path`` into ``target/rows`` and ``target/quarantine``."""
    raw = landing_stream(spark, path, schema, max_files_per_trigger)

    def land(batch: DataFrame, batch_id: int) -> None:
        stamp = F.current_timestamp().cast(T.TimestampNTZType())
        typed = type_rows(batch, schema, stamp).persist()
        try:
            good, bad = split_good_bad(typed, schema)
            good.write.mode("overwrite").parquet(f"{target}/rows/{BATCH_COL}={batch_id}")
            bad.write.mode("overwrite").parquet(f"{target}/quarantine/{BATCH_COL}={batch_id}")
        finally:
            typed.unpersist()

    return _start(raw, land, checkpoint, trigger, name)


def read_landed(spark: SparkSession, target: str, kind: str = "rows") -> DataFrame:
    return spark.read.parquet(f"{target}/{kind}")


def stream_upsert(spark: SparkSession, path: str, schema: T.StructType, store: TableStore,
                  layer: str, table: str, keys: Sequence[str],
                  model: Callable[[DataFrame], DataFrame], checkpoint: str,
                  late_policy: str = "merge", trigger: str = "availableNow",
                  max_files_per_trigger: int | None = None,
                  cluster_by: Sequence[str] | None = None, grain: str = "day",
                  redelivery: str | None = None) -> StreamingQuery:
    """Micro-batches of landed files -> ``model`` (clean + newest per key) -> upsert.

    ``redelivery``: how long rows delivered again are kept from the upsert (see
    :func:`without_redelivered`).  Give it from a stream's first start on: its
    state is part of the checkpoint.
    """
    raw = landing_stream(state_session(spark) if redelivery else spark, path, schema, max_files_per_trigger)
    if redelivery:
        raw = without_redelivered(raw, redelivery)
    fn = upsert_batch_fn(schema, store, layer, table, keys, model, late_policy, cluster_by, grain)
    return _start(raw, fn, checkpoint, trigger, None)


def stored_batch(rows: DataFrame, store: TableStore) -> tuple[DataFrame, int, int]:
    """The typed rows of a micro-batch, written once and read back in the store's session;
    how many of them are good and bad, counted by the write.

    A stream's session plans without adaptive execution and its rows lie in one part
    per state partition.  What is read back is packed by size instead, so the many
    steps of an upsert have tasks for the batch and not for the shuffle partitions,
    and each task that is saved is one report less to the driver.
    """
    folder, counts = scratch_dir(store.spark, "batch"), Observation()
    rows.observe(counts, F.count(F.lit(1)).alias("rows"), F.count("_reason").alias("bad")).write.parquet(folder)
    n = counts.get
    return store.spark.read.schema(rows.schema).parquet(folder), n["rows"] - n["bad"], n["bad"]


def upsert_batch_fn(schema: T.StructType, store: TableStore, layer: str, table: str,
                    keys: Sequence[str], model: Callable[[DataFrame], DataFrame],
                    late_policy: str = "merge", cluster_by: Sequence[str] | None = None,
                    grain: str = "day") -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body: idempotent per batch id.

    If the table commit of batch n exists, a re-delivery of batch n (the
    stream's own commit was lost with the driver) changes nothing; if the
    upsert failed before its commit, the re-run applies it once.  Malformed
    rows go to ``<table>_quarantine``, committed first and once per batch.
    The commit says how many rows the drop policy left out.
    """
    qtable = f"{table}_quarantine"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        info = store.commit_info(layer, table)
        if applied(info, batch_id):  # replay of an applied batch: the table has it, the stream's state may not
            batch.write.format("noop").mode("overwrite").save()
            return
        stamp = F.current_timestamp().cast(T.TimestampNTZType())
        # the batch is read several times (quarantine, touched partitions, merge, mark)
        typed, n_good, n_bad = stored_batch(type_rows(batch, schema, stamp), store)
        good, bad = split_good_bad(typed, schema)
        if not applied(store.commit_info(layer, qtable), batch_id):
            store.append(layer, qtable, bad, meta={"stream_batch": batch_id}, empty=n_bad == 0)
        incoming = model(good)
        late = 0
        if late_policy == "drop":
            mark = info.get("hwm") if info else None
            late = late_count(good, mark)
            incoming = newer_than(incoming, mark)
        store.upsert_later(layer, table, incoming, keys, grain=grain, cluster_by=cluster_by,
                           meta={"stream_batch": batch_id, "late_dropped": late}, empty=n_good == 0)

    return upsert


def applied(info: dict | None, batch_id: int) -> bool:
    """Whether a table's record already includes a micro-batch."""
    return info is not None and info.get("stream_batch", -1) >= batch_id


def stream_to_table(spark: SparkSession, path: str, schema: T.StructType, store: TableStore,
                    layer: str, table: str, checkpoint: str, trigger: str = "availableNow",
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Continuous load into an append-only stored table (``<table>`` and
    ``<table>_quarantine``), each micro-batch committed once.

    The quarantine commit is written first and the table commit last; both
    record the batch id, so after a failure between the two the re-run skips
    whatever was already committed.
    """
    raw = landing_stream(spark, path, schema, max_files_per_trigger)
    qtable = f"{table}_quarantine"

    def load(batch: DataFrame, batch_id: int) -> None:
        if applied(store.commit_info(layer, table), batch_id):
            return
        stamp = F.current_timestamp().cast(T.TimestampNTZType())
        typed = type_rows(batch, schema, stamp).persist()
        try:
            good, bad = split_good_bad(typed, schema)
            if not applied(store.commit_info(layer, qtable), batch_id):
                store.append(layer, qtable, bad, meta={"stream_batch": batch_id})
            store.append(layer, table, good, hwm_col="created_at", meta={"stream_batch": batch_id})
        finally:
            typed.unpersist()

    return _start(raw, load, checkpoint, trigger, None)
