"""Which files of a landing prefix were taken already.

A ledger is a Parquet folder with one row per taken file: path, modification
time and length.  A load lists the prefix (no file is opened), anti-joins the
listing with the ledger and reads only what is left: files that are new, or
were overwritten in place since they were taken, which a file stream would
miss.  The cost of a cycle follows the new files and not the history.

Record the files after their rows are stored.  A load that fails in between
sees them again, so the rows of a load must be safe to store twice (rows above
a high-water mark are).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.session import scratch_dir
from martflow.sources.landing import has_files

COLUMNS = ["path", "modified", "length"]
LEDGER = "path string, modified timestamp, length long"


def plain_path(path: str) -> Column:
    """A path as the listing writes it: without the escapes and extra slashes of ``_metadata.file_path``."""
    plain = F.regexp_replace(F.col(path), r"\+", "%2B")
    return F.regexp_replace(F.coalesce(F.try_url_decode(plain), F.col(path)), "^file:/+", "file:/")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """One row per file under ``path`` and its folders, as the landing reader sees them; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"),
                        F.col("modificationTime").alias("modified"), "length")


def not_taken(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Files under ``path`` that the ledger lacks as they are now, as a stored table."""
    files = listing(spark, path)
    if has_files(spark, ledger):
        files = files.join(spark.read.schema(LEDGER).parquet(ledger), COLUMNS, "left_anti")
    folder = scratch_dir(spark, "files")
    files.write.parquet(folder)
    return spark.read.schema(LEDGER).parquet(folder)


def paths(files: DataFrame) -> list[str]:
    """The paths on the driver, where the reader that gets them lists every file anyway."""
    return [r.path for r in files.select("path").orderBy("path").collect()]


def record(files: DataFrame, ledger: str) -> None:
    files.select(*COLUMNS).write.mode("append").parquet(ledger)
