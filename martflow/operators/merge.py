"""Incremental loads: high-water append, keyed upsert, column append.

``append_newer``   staging models: keep incoming rows strictly newer than the
                   target's high-water mark, append them (no key, no dedup).
``merge_upsert``   silver facts: newest version per key replaces the stored row.
                   ``late_policy="drop"`` is the original behaviour (only rows
                   newer than the target's global max are considered, so late
                   rows vanish); ``late_policy="merge"`` upserts whenever the
                   incoming version is newer than the stored one *for that key*.
``align_columns``  schema evolution: new incoming columns are appended, columns
                   missing on one side become NULL, nothing is dropped.  A
                   column of two types takes the smallest type that holds every
                   value of both (``wider``); without one the load is refused.

The upsert is one full join of target and batch on the key.  The target is only read, never written
in place; the caller writes the result as a new table version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators.clean import high_water_mark, newer_than, ts_literal
from martflow.operators.dedupe import latest_per_key


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = (3, 5, 10, 19)  # decimal digits that hold every value of the integer type


def _decimal_of(t: T.DataType) -> T.DecimalType | None:
    if isinstance(t, _INTEGERS):
        return T.DecimalType(_DIGITS[_INTEGERS.index(type(t))], 0)
    return t if isinstance(t, T.DecimalType) else None


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The smallest type that holds every value of ``a`` and of ``b`` unchanged; None if there is none.

    Integers grow to longer integers or to decimals, decimals in digits before
    and after the point (38 at most), float to double, integers of up to 32
    bits to double, dates to either timestamp.  Text never mixes with another type.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    da, db = _decimal_of(a), _decimal_of(b)
    if da and db:
        scale = max(da.scale, db.scale)
        digits = max(da.precision - da.scale, db.precision - db.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    for x, y in ((a, b), (b, a)):
        if isinstance(y, T.DoubleType) and isinstance(x, (T.FloatType, *_INTEGERS[:3])):
            return y
        if isinstance(y, T.FloatType) and isinstance(x, _INTEGERS[:2]):
            return y
        if isinstance(x, T.DateType) and isinstance(y, (T.TimestampType, T.TimestampNTZType)):
            return y
    return None


def align_columns(existing: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give both frames the same columns and types: existing order first, new columns appended."""
    cols = list(existing.columns) + [c for c in incoming.columns if c not in existing.columns]
    old, new = ({f.name: f.dataType for f in df.schema.fields} for df in (existing, incoming))
    types = {c: wider(old.get(c, T.NullType()), new.get(c, T.NullType())) for c in cols}
    refused = [f"{c}: {old[c].simpleString()} and {new[c].simpleString()}" for c in cols if types[c] is None]
    if refused:
        raise TypeError(f"no type holds both sides of {', '.join(refused)}")

    def fill(df: DataFrame, has: dict[str, T.DataType]) -> DataFrame:
        return df.select(*[F.col(c) if has.get(c) == types[c] else (F.col(c) if c in has else F.lit(None)).cast(types[c]).alias(c)
                           for c in cols])
    return fill(existing, old), fill(incoming, new)


def union_evolving(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    a, b = align_columns(existing, incoming)
    return a.unionByName(b)


def append_newer(existing: DataFrame | None, incoming: DataFrame, ts_col: str = "created_at",
                 hwm=None) -> DataFrame:
    """existing + incoming rows with ``ts_col`` > max(existing.ts_col) (default 1900-01-01)."""
    if hwm is None and existing is not None:
        hwm = high_water_mark(existing, ts_col)
    fresh = newer_than(incoming, hwm, ts_col)
    return fresh if existing is None else union_evolving(existing, fresh)


def merge_upsert(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
                 ts_col: str = "created_at", late_policy: str = "merge",
                 hwm=None, dedupe: bool = True, order=None) -> DataFrame:
    """Upsert ``incoming`` into ``existing`` on ``keys``.

    ``incoming`` is reduced to its newest row per key first (unless ``dedupe``
    is False because the caller already did).  Returns the full new table.
    """
    keys = list(keys)
    if late_policy not in ("merge", "drop"):
        raise ValueError("late_policy must be 'merge' or 'drop'")
    if late_policy == "drop" and existing is not None:
        if hwm is None:
            hwm = high_water_mark(existing, ts_col)
        incoming = newer_than(incoming, hwm, ts_col)
    if dedupe:
        incoming = latest_per_key(incoming, keys, order=order, version_col=ts_col)
    if existing is None:
        return incoming
    existing, incoming = align_columns(existing, incoming)
    # One full join on the key picks the winner of each key in a single pass
    # over either side; both hold a key once, so no key is hot.  The key is
    # shuffled once and not again inside the row.
    row = [c for c in existing.columns if c not in keys or c == ts_col] or keys
    old = existing.select(*keys, F.struct(*row).alias("_old"))
    new = incoming.select(*keys, F.struct(*row).alias("_new"))
    wins = F.col("_new").isNotNull()
    if late_policy == "merge":
        stored = F.col(f"_old.{ts_col}")
        wins = wins & (stored.isNull() | (F.col(f"_new.{ts_col}") > stored))
    both = old.join(new, keys, "full").select(*keys, F.when(wins, F.col("_new")).otherwise(F.col("_old")).alias("_row"))
    return both.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in existing.columns])


def late_count(incoming: DataFrame, hwm, ts_col: str = "created_at") -> int:
    """How many rows the parity policy leaves out for being no newer than the mark (0 without one)."""
    if hwm is None:
        return 0
    return incoming.where(F.col(ts_col).isNull() | (F.col(ts_col) <= ts_literal(hwm))).count()


def late_rows(existing: DataFrame, incoming: DataFrame, ts_col: str = "created_at", hwm=None) -> DataFrame:
    """Incoming rows the parity policy drops (not newer than the target's mark)."""
    if hwm is None:
        hwm = high_water_mark(existing, ts_col)
    if hwm is None:
        return incoming.where(F.lit(False))
    return incoming.where(F.col(ts_col).isNull() | (F.col(ts_col) <= ts_literal(hwm)))
