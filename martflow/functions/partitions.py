"""How many tasks a keyed step gets.

Adaptive execution joins shuffle partitions by their compressed bytes.  A few
key columns compress so well that millions of keys land in one task, and a hash
aggregate keeps every one of them.  Steps that hold one entry per row are dealt
by the size of their input files instead, so what a task holds stays the same
however large the input is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

# Bytes of input files for one task of a keyed step: some 400,000 narrow rows.
TASK_BYTES = 8 * 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """Total length of the files that ``df`` is read from (their contents are not read); 0 if it has none."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = (jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles())
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def by_key(df: DataFrame, *keys: str | Column) -> DataFrame:
    """``df`` dealt by ``keys`` to one task for every ``TASK_BYTES`` of its input; unchanged if one is enough."""
    tasks = input_bytes(df) // TASK_BYTES
    if tasks < 2:
        return df
    return df.repartition(max(tasks, df.sparkSession.sparkContext.defaultParallelism), *keys)
