"""Declarative data-quality checks.

A check is data (model, kind, columns).  Kinds:

* ``unique``          - a non-NULL value occurring more than once fails (one failure per value)
* ``not_null``        - every NULL row fails
* ``non_negative``    - every row with value < 0 fails (NULL passes)
* ``unique_combination`` - every repeated combination of the columns fails

``summary`` runs a whole suite: all row-wise checks of one table are fused into
a *single* aggregate pass (conditional sums), every uniqueness check is one
grouped count followed by a global count.  A small table is counted with map-side
partial aggregation; the rows of a large one are dealt by their key to tasks of
bounded input (:mod:`martflow.functions.partitions`), as keys that are almost all
different leave nothing to combine: there a value that is repeated very often
lengthens one task, but takes one entry of its memory.  ``failures`` returns the offending rows
/ values themselves, so a check is also a query.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.partitions import by_key

ROW_KINDS = ("not_null", "non_negative")
GROUP_KINDS = ("unique", "unique_combination")


@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    columns: tuple[str, ...]

    @property
    def column_label(self) -> str:
        return ",".join(self.columns)


def _c(model, kind, *cols):
    return Check(model, kind, tuple(cols))


# The assertion suite over the silver tables (20 assertions).
SILVER_SUITE: tuple[Check, ...] = (
    _c("dim_product", "unique", "product_id"),
    _c("dim_product", "not_null", "product_id"),
    _c("dim_product", "not_null", "price"),
    _c("dim_product", "non_negative", "price"),
    _c("dim_customer", "not_null", "customer_id"),
    _c("dim_customer", "unique", "customer_id"),
    _c("dim_customer", "not_null", "first_name"),
    _c("dim_customer", "not_null", "last_name"),
    _c("dim_store", "not_null", "store_id"),
    _c("dim_store", "unique", "store_id"),
    _c("fact_orders", "unique", "order_id"),
    _c("fact_orders", "not_null", "order_id"),
    _c("fact_orders", "non_negative", "total_amount"),
    _c("fact_orders", "non_negative", "discount_amount"),
    _c("fact_orders", "non_negative", "shipping_cost"),
    _c("fact_orderitems", "unique_combination", "order_id", "product_id"),
    _c("fact_orderitems", "non_negative", "quantity"),
    _c("fact_orderitems", "non_negative", "unit_price"),
    _c("fact_orderitems", "non_negative", "line_total"),
    _c("fact_orderitems", "non_negative", "line_discount"),
)

# Row checks report the offending row by its model key.
MODEL_KEYS = {
    "dim_product": ("product_id",),
    "dim_customer": ("customer_id",),
    "dim_store": ("store_id",),
    "fact_orders": ("order_id",),
    "fact_orderitems": ("order_id", "product_id"),
}

# Output columns: summary -> model, test, columns, failures (bigint);
# failures -> model, test, columns, value (offending key / value as text), n_records (bigint).


def _row_fail(check: Check):
    c = F.col(check.columns[0])
    return c.isNull() if check.kind == "not_null" else (c < 0)


def _label_cols(check: Check):
    return [F.lit(check.model).alias("model"), F.lit(check.kind).alias("test"),
            F.lit(check.column_label).alias("columns")]


def _value_text(cols: Sequence[str]):
    """Offending value(s) as text; NULL parts shown as 'NULL'."""
    parts = [F.coalesce(F.col(c).cast(T.StringType()), F.lit("NULL")) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def _duplicates(df: DataFrame, check: Check, scope: DataFrame | None = None) -> DataFrame:
    cols = list(check.columns)
    src = df.select(*cols)
    if check.kind == "unique":
        src = src.where(F.col(cols[0]).isNotNull())
    if scope is not None:
        # only values present in the changed rows can have become duplicates
        src = src.join(scope.select(*cols).distinct(), cols, "left_semi")
    return by_key(src, *cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


# Fixed values of Spark's bitmap functions, and what a row of a grouped count takes in a shuffle.
BITMAP_BITS = 32_768
BITMAP_BYTES = BITMAP_BITS // 8
GROUP_ROW_BYTES = 24


def dense_key(df: DataFrame, cols: Sequence[str]) -> DataFrame | None:
    """``df`` with its integer key as one number ``_key`` (NULL if a part is), or None if that is no 64-bit number.

    Several columns are combined by place value: each counts from its least
    value and is worth as much as the ranges of those behind it.
    """
    if not all(isinstance(df.schema[c].dataType, T.IntegralType) for c in cols):
        return None
    if len(cols) == 1:
        return df.select(*cols, F.col(cols[0]).cast("long").alias("_key"))
    ends = df.agg(*[f(c).cast("long") for c in cols for f in (F.min, F.max)]).first()
    low, spans = ends[::2], [None if a is None else b - a + 1 for a, b in zip(ends[::2], ends[1::2])]
    product = 1
    for span in spans:
        product *= span or 1
    if product >= 1 << 62 or any(a is not None and not -(1 << 62) < a < 1 << 62 for a in ends):
        return None
    key = F.lit(0).cast("long")
    for c, a, span in zip(cols, low, spans):
        key = key * F.lit(span or 1) + (F.col(c).cast("long") - F.lit(a or 0))
    return df.select(*cols, key.alias("_key"))


def bitmap_pays(keyed: DataFrame) -> bool:
    """Whether bitmaps shuffle less than one row per key: few buckets of keys per input partition.

    One pass over the key column; it gathers two numbers.  Keys that lie together
    (a table written in key order, or loaded by time with growing keys) pay,
    random ones do not.
    """
    per_task = keyed.groupBy(F.spark_partition_id().alias("_p")).agg(
        F.count("_key").alias("n"), F.approx_count_distinct(F.bitmap_bucket_number("_key")).alias("buckets"))
    n, buckets = per_task.agg(F.sum("n"), F.sum("buckets")).first()
    return buckets is not None and buckets * BITMAP_BYTES < n * GROUP_ROW_BYTES


def bitmap_buckets(keyed: DataFrame) -> DataFrame:
    """Buckets of 32,768 neighbouring keys that hold one twice: more rows than distinct bits.

    A key is one bit of its bucket's bitmap, so this is exact.  Map tasks ship one row
    of 4 KB for each bucket they hold, whatever the number of its rows.
    """
    return (keyed.where(F.col("_key").isNotNull()).groupBy(F.bitmap_bucket_number("_key").alias("_bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("bits"))
            .where(F.col("n") > F.bitmap_count("bits")).select("_bucket"))


def bitmap_duplicates(df: DataFrame, check: Check) -> DataFrame:
    """``_duplicates`` for integer keys: only rows of buckets that hold a repeated key are grouped.

    Falls back to the grouped count where the key is no integer or bitmaps would
    shuffle more; rows with a NULL part are counted apart, as combinations may hold them.
    """
    cols = list(check.columns)
    keyed = dense_key(df.select(*cols), cols)
    if keyed is None or not bitmap_pays(keyed):
        return _duplicates(df, check)
    suspect = keyed.withColumn("_bucket", F.bitmap_bucket_number("_key")).join(bitmap_buckets(keyed), "_bucket", "left_semi")
    if check.kind == "unique_combination":
        suspect = suspect.select(*cols).unionByName(keyed.where(F.col("_key").isNull()).select(*cols))
    return suspect.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


SALT = "_salt"


def _null_salt(unique: Check, row_checks: Sequence[Check]) -> list:
    """One more grouping column for a single key: 0 for a value, a hash of the checked columns for NULL."""
    checked = sorted({c for ch in row_checks for c in ch.columns if c not in unique.columns})
    if unique.kind != "unique" or not checked:
        return []
    return [F.when(F.col(unique.columns[0]).isNull(), F.xxhash64(*checked)).otherwise(F.lit(0).cast("long")).alias(SALT)]


FAILS = "_fails"


def _fails(row_checks: Sequence[Check]):
    """The failed row checks of a row as one number, a bit for each: a row that is dealt carries no column per check."""
    bits = [F.when(_row_fail(ch), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, ch in enumerate(row_checks)]
    return reduce(lambda a, b: a + b, bits, F.lit(0).cast("long"))


def _one_pass(df: DataFrame, row_checks: Sequence[Check], unique: Check) -> DataFrame:
    """All assertions of a table with one key from a single scan.

    Rows are counted per key together with their failed row checks; the global
    sums of these are the row failures, and keys counted more than once the
    uniqueness failures.  The rows of a large table are dealt by their key first,
    so the tasks, which keep a count for each key, follow its size.  NULLs need
    not meet where NULL is no key; a hash of the checked values deals them apart.
    """
    checks = [*row_checks, unique]
    keys = list(unique.columns)
    rows = df.select(*keys, _fails(row_checks).alias(FAILS), *_null_salt(unique, row_checks))
    keys = [c for c in rows.columns if c in keys or c == SALT]
    per_key = by_key(rows, *keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *(F.sum(F.shiftright(FAILS, i).bitwiseAND(F.lit(1).cast("long"))).alias(f"_f{i}") for i in range(len(row_checks))))
    repeated = F.col("_n") > 1
    if unique.kind == "unique":  # NULL is no value that could repeat
        repeated = repeated & F.col(unique.columns[0]).isNotNull()
    total = per_key.agg(*(F.sum(f"_f{i}").alias(f"_f{i}") for i in range(len(row_checks))),
                        F.count_if(repeated).alias(f"_f{len(row_checks)}"))
    rows = F.array(*[F.struct(*_label_cols(ch), F.coalesce(F.col(f"_f{i}"), F.lit(0)).cast("long").alias("failures"))
                     for i, ch in enumerate(checks)])
    return total.select(F.inline(rows))


def summary(tables: Mapping[str, DataFrame], suite: Sequence[Check] = SILVER_SUITE,
            changed: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per assertion: (model, test, columns, failures).

    ``changed`` (optional) maps a model to the rows written since the table last
    passed: row checks then run on those rows only, and uniqueness is counted
    over the whole table but only for the values present in them (the rest was
    unique before and no new copy of it exists).  Models missing from
    ``changed`` are checked in full.
    """
    changed = changed or {}
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for ch in suite:
        by_model.setdefault(ch.model, []).append(ch)
    for model, checks in by_model.items():
        df = tables[model]
        scope = changed.get(model)
        row_checks = [ch for ch in checks if ch.kind in ROW_KINDS]
        group_checks = [ch for ch in checks if ch.kind in GROUP_KINDS]
        if scope is None and len(group_checks) == 1:
            parts.append(_one_pass(df, row_checks, group_checks[0]))
            continue
        if row_checks:
            # One pass over the table for all row-wise checks, then unpivot.
            aggs = [F.sum(F.when(_row_fail(ch), 1).otherwise(0)).cast("long").alias(f"_f{i}")
                    for i, ch in enumerate(row_checks)]
            wide = (df if scope is None else scope).agg(*aggs)
            rows = F.array(*[
                F.struct(F.lit(ch.model).alias("model"), F.lit(ch.kind).alias("test"),
                         F.lit(ch.column_label).alias("columns"),
                         F.coalesce(F.col(f"_f{i}"), F.lit(0).cast("long")).alias("failures"))
                for i, ch in enumerate(row_checks)])
            parts.append(wide.select(F.inline(rows)))
        for ch in group_checks:
            parts.append(_duplicates(df, ch, scope).agg(F.count(F.lit(1)).alias("failures"))
                         .select(*_label_cols(ch), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failures(tables: Mapping[str, DataFrame], suite: Sequence[Check] = SILVER_SUITE, bitmaps: bool = False) -> DataFrame:
    """The offending rows (row checks, n_records = 1) and values (uniqueness).

    All row checks of one table run in a single pass: each row yields the
    array of checks it fails (usually empty), which is exploded.  With
    ``bitmaps`` uniqueness of integer keys is counted by :func:`bitmap_duplicates`.
    """
    repeated = bitmap_duplicates if bitmaps else _duplicates
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for ch in suite:
        by_model.setdefault(ch.model, []).append(ch)
    for model, checks in by_model.items():
        df = tables[model]
        row_checks = [ch for ch in checks if ch.kind in ROW_KINDS]
        if row_checks:
            hits = F.array(*[F.when(_row_fail(ch), F.struct(*_label_cols(ch))) for ch in row_checks])
            failed = df.select(_value_text(MODEL_KEYS.get(model, row_checks[0].columns)).alias("value"),
                               F.filter(hits, lambda h: h.isNotNull()).alias("_hits"))
            parts.append(failed.where(F.size("_hits") > 0)
                         .select(F.explode("_hits").alias("_h"), "value")
                         .select("_h.model", "_h.test", "_h.columns", "value",
                                 F.lit(1).cast("long").alias("n_records")))
        for ch in checks:
            if ch.kind in GROUP_KINDS:
                parts.append(repeated(df, ch).select(
                    *_label_cols(ch), _value_text(ch.columns).alias("value"), "n_records"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(summary_df: DataFrame) -> list:
    """Collect the failing assertions (at most one row per assertion)."""
    return summary_df.where(F.col("failures") > 0).collect()
