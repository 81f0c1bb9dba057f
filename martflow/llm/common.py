"""Small shared pieces of the operators: tables, scratch tables, row identity."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martflow.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and reread: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """From now on Arrow batches of the session hold ``rows`` rows and ``size`` bytes at most (or less, if set so)."""
    for key, most, default in (("maxRecordsPerBatch", rows, 10_000), ("maxBytesPerBatch", size, 1 << 26)):
        key = f"spark.sql.execution.arrow.{key}"
        now = str(spark.conf.get(key, str(default)))
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def crc32_of_id(column: str = "doc_id"):
    """Unsigned crc32 of an id written as decimal text (null: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def drop_rows(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents without those in ``rejected`` (doc_id, text_hash), null-safe.

    ``rejected`` should be a stored table: its size is then known before the
    join is planned, so Spark broadcasts it only below its threshold.
    """
    left = docs.withColumn("__hash", F.xxhash64("text"))
    r = rejected.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__rejected"))
    return left.join(r, left.doc_id.eqNullSafe(r["__id"]) & (left["__hash"] == r["__rejected"]),
                     "left_anti").select(*docs.columns)


def hash_bound(limit: Column, rows: Column) -> Column:
    """Signed 64-bit bound below which about twice ``limit`` of ``rows`` hashes lie (all of them if there are fewer)."""
    share = F.least(F.lit(1.0), 2.0 * limit / F.greatest(rows, F.lit(1)))
    return F.when(share >= 1.0, F.lit((1 << 63) - 1)).otherwise(F.floor((share - 0.5) * 2.0**64).cast("long"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, limit: int,
                    value: int | None = None) -> DataFrame:
    """doc_id, y and text of at most ``limit`` labelled documents outside the held-out fold.

    Rows are taken in the order of a hash of their id, so the sample does not
    depend on partitions; a repeated id or row does not lengthen it.  Null or contradicting labels are left out.  With
    ``value`` only rows of that label are taken.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .where(F.pmod(crc32_of_id(), F.lit(folds)) != held)
             .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("other")).where("y = other"))
    if value is not None:
        known = known.where(F.col("y") == value)
    order = F.xxhash64("doc_id", F.lit(label))
    # Twice the limit is expected below the bound: no task ranks more than that.
    known = known.where(order <= hash_bound(F.lit(limit), F.lit(known.count())))
    ids = known.orderBy(order, "doc_id").limit(limit).select("doc_id", "y")
    return bounded_rows(docs.select("doc_id", "text"), ids, limit).select("doc_id", "y", "text")


def bounded_rows(docs: DataFrame, ids: DataFrame, limit: int, per: str | None = None) -> DataFrame:
    """Rows of ``docs`` with an id in ``ids``: at most ``limit`` (of each value of ``per``), however often an id stands.

    Rows of one id and text count once; if more are left, a hash of id and text
    chooses.  ``ids`` must be bounded itself.
    """
    row = F.xxhash64("doc_id", "text").alias("__row")
    seen = docs.join(F.broadcast(ids), "doc_id").select("doc_id", *([per] if per else []), row).distinct()
    if per:
        rank = F.row_number().over(Window.partitionBy(per).orderBy("__row", "doc_id"))
        seen = seen.withColumn("__n", rank).where(F.col("__n") <= limit)
    else:
        seen = seen.orderBy("__row", "doc_id").limit(limit)
    # ``limit`` rows at most (for each value of ``per``)
    chosen = stored(seen.select("__row").distinct(), "sample-rows")
    found = docs.withColumn("__row", F.xxhash64("doc_id", "text")).join(F.broadcast(chosen), "__row")
    return found.join(F.broadcast(ids), "doc_id").dropDuplicates(["__row"]).drop("__row")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Coefficients and, last, the intercept of a ridge logistic regression (Newton's method)."""
    a = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    scale = np.maximum(np.abs(a).max(axis=0), 1e-12)
    a = a / scale
    w = np.zeros(a.shape[1])
    penalty = np.append(np.full(a.shape[1] - 1, ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (p - y) + penalty * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w / scale
