"""Facts stored in buckets of a key, so that grouping and joining on it need no shuffle.

Both facts of a mart are written once, in the same number of buckets of
``order_id``, one sorted file per bucket.  Every later roll-up of the items and
join with the orders then reads bucket by bucket: Spark sees the partitioning of
the scan and plans no exchange of either fact.  The shuffle is paid when a fact is
written instead of in every mart that joins them.

The number of buckets is a parameter and must be equal for the facts that
are joined (or one a multiple of the other); a bucket should fit a task, about
256 MB of a fact.  A key in many rows makes its bucket as large, so only tables
whose key is bounded belong here: the facts hold an order once, and each product of
an order once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from martflow.session import scratch_dir


def bucket_count(df: DataFrame) -> int:
    """The session's number of shuffle partitions, as the default number of buckets."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_bucketed(df: DataFrame, keys: Sequence[str], purpose: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """``df`` stored as a table bucketed and sorted by ``keys`` below the shared folder (or at ``path``), and reread."""
    buckets = buckets or bucket_count(df)
    name = f"martflow_{purpose}_{uuid.uuid4().hex[:12]}"
    # dealt as the buckets are, so each bucket is written by one task into one file
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path or scratch_dir(df.sparkSession, purpose)).saveAsTable(name))
    return df.sparkSession.table(name)
