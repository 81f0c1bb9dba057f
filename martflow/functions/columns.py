"""Scalar expressions shared by the models.

Everything here is a plain ``pyspark.sql.functions`` expression so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.schemas import AGG_MONEY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp_non_negative(c) -> Column:
    """NULL or negative -> 0, else the value.

    ``CASE WHEN c < 0 OR c IS NULL THEN 0 ELSE c END``; the literal 0 widens to
    the column's type, so decimals keep their precision and ints stay ints.
    """
    c = _col(c)
    return F.when(c.isNull() | (c < 0), F.lit(0)).otherwise(c)


def composite_key(*cols, sep: str = "_") -> Column:
    """``a || '_' || b``: NULL if any part is NULL (unlike concat_ws)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast(T.StringType()))
    return F.concat(*parts)


def day_start(c) -> Column:
    """Truncate a TIMESTAMP_NTZ to its day, staying TIMESTAMP_NTZ.

    Going through DATE keeps the result independent of the session time zone
    (``date_trunc`` returns a zoned timestamp).
    """
    return _col(c).cast(T.DateType()).cast(T.TimestampNTZType())


def money(c, precision=(12, 2)) -> Column:
    return _col(c).cast(T.DecimalType(*precision))


def agg_money(c) -> Column:
    """Aggregated money at one fixed width, identical on every engine."""
    return _col(c).cast(AGG_MONEY)


# Decimals of up to this many digits are summed as 64-bit whole numbers: nine million of the largest fit.
SUM_DIGITS = 12


def unscaled_sum(c, scale: int) -> Column:
    """Exact sum of a decimal with ``scale`` digits behind the point, counted in its smallest unit.

    The buffer is one 64-bit number.  That of ``sum`` over a decimal has 38 digits and a flag, which
    makes the partial sums of small groups, as the lines of an order, twice as wide in an exchange.
    A sum beyond 64 bits is an arithmetic error.
    """
    return sum_of_units(unscaled(c, scale), scale)


def unscaled(c, scale: int) -> Column:
    """A decimal with ``scale`` digits behind the point as a 64-bit number of its smallest units."""
    return (_col(c) * F.lit(10 ** scale)).cast(T.LongType())


def sum_of_units(c, scale: int) -> Column:
    """Sum of ``unscaled`` numbers as a decimal."""
    return F.sum(c).cast(T.DecimalType(19, 0)) * F.lit(Decimal(1).scaleb(-scale))


def money_sum(df: DataFrame, c: str) -> Column:
    """Sum of a money column of ``df`` as ``agg_money``."""
    t = df.schema[c].dataType
    narrow = isinstance(t, T.DecimalType) and t.precision <= SUM_DIGITS
    return agg_money(unscaled_sum(c, t.scale) if narrow else F.sum(c))


def latest_first_order(version_col: str = "created_at", load_col: str | None = "ingestion_ts",
                       tiebreak: list[str] | None = None) -> list[Column]:
    """Total order for "newest version first": version desc NULLS LAST, then the
    load stamp desc, then the remaining columns so the survivor is deterministic."""
    order = [F.col(version_col).desc_nulls_last()]
    if load_col:
        order.append(F.col(load_col).desc_nulls_last())
    for c in tiebreak or []:
        order.append(F.col(c).asc_nulls_last())
    return order
