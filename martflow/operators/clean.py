"""Row-level cleansing: clamps, required keys, composite keys, high-water filters.

All of these are narrow (no shuffle) and compile into the scan's codegen stage;
key filters reach the parquet reader as ``IsNotNull`` pushed filters.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.columns import clamp_non_negative, composite_key

# The high-water mark of an empty target.
EMPTY_HWM = "1900-01-01 00:00:00"


def clamp(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Negative or NULL values of ``cols`` become 0 (in place, types kept)."""
    return df.withColumns({c: clamp_non_negative(c) for c in cols})


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL."""
    cond = None
    for c in cols:
        e = F.col(c).isNotNull()
        cond = e if cond is None else cond & e
    return df if cond is None else df.where(cond)


def require_positive(df: DataFrame, col: str) -> DataFrame:
    """``col IS NOT NULL AND col > 0``."""
    return df.where(F.col(col).isNotNull() & (F.col(col) > 0))


def with_composite_key(df: DataFrame, name: str, cols: Iterable[str], sep: str = "_") -> DataFrame:
    return df.withColumn(name, composite_key(*cols, sep=sep))


def high_water_mark(target: DataFrame | None, col: str = "created_at"):
    """``COALESCE(max(col), '1900-01-01')`` of the target as a Python value.

    One aggregate over a single column; on parquet with statistics it reads
    footers and one column chunk only.  Returning a literal (instead of a
    scalar subquery) lets the filter reach the next scan as a static
    ``PushedFilter``.
    """
    if target is None:
        return None
    row = target.agg(F.max(col).alias("hwm")).first()
    return None if row is None else row["hwm"]


def newer_than(df: DataFrame, hwm, col: str = "created_at") -> DataFrame:
    """Rows strictly newer than the mark; an absent mark means '1900-01-01'.

    NULL ``col`` never passes (a NULL comparison is not true), which is the
    incremental behaviour; callers route such rows to quarantine first.
    """
    return df.where(F.col(col) > ts_literal(EMPTY_HWM if hwm is None else hwm))


def ts_literal(value) -> "F.Column":
    """A TIMESTAMP_NTZ literal from a string or naive datetime.

    Goes through the ISO text so neither the Python nor the session time zone
    shifts it.
    """
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast(T.TimestampNTZType())
