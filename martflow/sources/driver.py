"""Reading the driver's parquet tables.

Each table is one parquet file/folder under ``sf_dir``.  Reads are lazy: the
column lists and filters of the calling model reach the scan (``ReadSchema`` /
``PushedFilters``), so nothing beyond the needed columns is read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class DriverTables:
    """Lazy accessor: ``tables.lineitem`` is ``spark.read.parquet(.../lineitem.parquet)``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.sf_dir, f"{name}.parquet")

    def read(self, name: str) -> DataFrame:
        """One DataFrame per table: the file listing and footer schema are read once."""
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.read(name)
        raise AttributeError(name)
