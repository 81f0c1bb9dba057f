"""Keep the newest row per key (``ROW_NUMBER() OVER (PARTITION BY k ORDER BY ..) = 1``).

Catalyst rewrites ``row_number() = 1`` into a *partial* ``WindowGroupLimit``
before the shuffle and a final one after it, so every map task forwards at most
one row per key.  A key that holds a third of all rows therefore costs one row
per map task in the exchange, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.columns import latest_first_order
from martflow.functions.partitions import by_key
from martflow.session import cut_lineage

RN = "_rn"
REPEATED_KEYS = 2_000_000  # most keys that are broadcast


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
                   version_col: str = "created_at", load_col: str | None = "ingestion_ts",
                   tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first under ``order``.

    The default order is ``version desc nulls last, load stamp desc nulls last``
    followed by ``tiebreak`` columns; pass all remaining columns there when the
    survivor must not depend on input order.
    """
    if order is None:
        order = latest_first_order(version_col, load_col if load_col in df.columns else None,
                                   list(tiebreak or []))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RN, F.row_number().over(w)).where(F.col(RN) == 1).drop(RN)


def latest_of_repeated(df: DataFrame, keys: Sequence[str], **order) -> DataFrame:
    """``latest_per_key`` for a table whose keys mostly occur once.

    The keys alone are counted first.  Rows of a key that occurs once need no ranking and no
    exchange; those of the repeated keys, told apart by a broadcast of these, are ranked.  With
    more than ``REPEATED_KEYS`` of them all rows are ranked.  Runs a job for the count; the
    input is read three times, so it should be a stored table.
    """
    repeated = cut_lineage(by_key(df.select(*keys), *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                           .where("_n > 1").select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
    if repeated.count() > REPEATED_KEYS:
        return latest_per_key(df, keys, **order)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    once = df.join(F.broadcast(repeated), same, "left_anti")
    return once.unionByName(latest_per_key(df.join(F.broadcast(repeated), same, "left_semi"), keys, **order))


def versions_per_key(df: DataFrame, keys: Sequence[str], version_col: str = "created_at",
                     load_col: str = "ingestion_ts", tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per (key, version): the most recently loaded copy wins."""
    order = [F.col(load_col).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tiebreak or []]
    return latest_per_key(df, list(keys) + [version_col], order=order)
