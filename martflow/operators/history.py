"""Type-2 history (slowly changing dimensions).

Contract:

(a) one row per (key, version time); the most recently loaded copy wins;
(b) ``valid_from`` = the version time;
(c) ``valid_to`` = the next version's time, NULL for the newest (half-open);
(d) an incoming version not newer than the key's last version changes nothing,
    so re-running a batch is idempotent; with ``late="split"`` a never-seen older
    version cuts the interval that holds its time (or fills the gap before the
    next one), and a copy of a stored version with a newer load stamp replaces
    its attributes, so batches may arrive in any order;
(e) with ``close_missing`` the open row of a key absent from the batch is closed
    at ``now``; a closed key that reappears opens a new row with
    ``valid_from = max(version time, last valid_to)``;
(f) at most one open row per key.

``rebuild_scd2`` derives the whole history from all versions at once;
``apply_scd2`` merges one batch into an existing history.  Applying batches in
order equals the rebuild over their union (no deletes); with ``late="split"``
so does applying them in any order.

Skew: the "next version" of a row is computed by :func:`next_in_key`, which
never needs all versions of one key in a single task (see there).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators.clean import ts_literal
from martflow.operators.dedupe import latest_per_key, versions_per_key
from martflow.session import cut_lineage

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def _bucket(level: str, ts: str) -> Column:
    """Time bucket of an NTZ timestamp, computed without any time zone."""
    d = F.col(ts).cast(T.DateType())
    if level == "hour":
        return F.struct(d.alias("d"), F.hour(F.col(ts)).alias("h"))
    if level == "day":
        return d
    if level in ("month", "year"):
        return F.trunc(d, level)
    raise ValueError(f"unknown bucket level {level!r}")


def next_in_key(df: DataFrame, keys: Sequence[str], ts: str, out: str,
                levels: Sequence[str] = ("day", "year")) -> DataFrame:
    """Add ``out`` = the next larger ``ts`` within the same key (NULL for the last).

    ``df`` must be unique on (keys, ts).  A plain ``lead`` over
    ``partitionBy(keys)`` sends every version of a key to one task; here the
    rows are first ranked inside (key, time bucket) groups, and only the last
    row of each bucket looks up the first row of the next non-empty bucket.
    That lookup is the same problem one level up on the much smaller table of
    bucket starts (one row per key and bucket), solved recursively; the top
    level is a plain lead over per-key bucket starts.  Every window group is
    bounded by the fan-out of one bucket level, every join is 1:1.
    """
    if not levels:
        w = Window.partitionBy(*keys).orderBy(F.col(ts).asc())
        return df.withColumn(out, F.lead(ts).over(w))
    b = f"_b_{len(levels)}"
    local = f"_local_{len(levels)}"
    first = f"_first_{len(levels)}"
    nxt = f"_next_{len(levels)}"
    bucketed = df.withColumn(b, _bucket(levels[0], ts))
    w = Window.partitionBy(*keys, b).orderBy(F.col(ts).asc())
    ranked = bucketed.withColumn(local, F.lead(ts).over(w))
    starts = bucketed.groupBy(*keys, b).agg(F.min(ts).alias(first))
    starts_next = next_in_key(starts, keys, first, nxt, levels[1:]).select(*keys, b, nxt)
    inner = ranked.where(F.col(local).isNotNull()).withColumn(out, F.col(local))
    last = (ranked.where(F.col(local).isNull())
            .join(starts_next, list(keys) + [b], "left")
            .withColumn(out, F.col(nxt)).drop(nxt))
    return inner.unionByName(last).drop(b, local)


def rebuild_scd2(versions: DataFrame, keys: Sequence[str], version_col: str = "created_at",
                 load_col: str = "ingestion_ts", levels: Sequence[str] = ("day", "year")) -> DataFrame:
    """Whole history from all staged versions (H5)."""
    tiebreak = [c for c in versions.columns if c not in set(keys) | {version_col, load_col}]
    v = versions_per_key(versions, keys, version_col, load_col, tiebreak)
    cols = v.columns
    v = next_in_key(v, keys, version_col, VALID_TO, levels)
    return v.select(*cols, F.col(version_col).alias(VALID_FROM), VALID_TO)


def apply_scd2_split(open_rows: DataFrame, closed_rows: DataFrame | None, batch: DataFrame,
                     keys: Sequence[str], version_col: str = "created_at",
                     load_col: str = "ingestion_ts", close_missing: bool = False, now=None,
                     levels: Sequence[str] = ("day", "year")) -> tuple[DataFrame, DataFrame]:
    """Merge a batch into history kept as (open rows, closed rows).

    Returns ``(newly_closed, new_open)``: closed history is append-only, the
    open part has one row per key and is replaced.  Closed rows are only read
    for keys present in the batch (semi join), to find the last version of a
    key whose open row was closed by a hard delete.  Cost per run:
    O(keys + batch + closed rows of the batch's keys), independent of how
    long the history is.
    """
    keys = list(keys)
    cols = open_rows.columns
    tiebreak = [c for c in batch.columns if c not in set(keys) | {version_col, load_col}]
    batch = versions_per_key(batch, keys, version_col, load_col, tiebreak)
    batch_keys = batch.select(*keys).distinct()

    # Last row per batch key: the open one, else the newest closed one.
    info_cols = [*keys, VALID_FROM, F.col(version_col).alias("_last_v"), F.col(VALID_TO).alias("_last_to")]
    cands = open_rows.join(batch_keys, keys, "left_semi").select(*info_cols)
    if closed_rows is not None:
        cands = cands.unionByName(closed_rows.join(batch_keys, keys, "left_semi").select(*info_cols))
    last_info = latest_per_key(cands, keys, order=[F.col(VALID_FROM).desc_nulls_last()]).drop(VALID_FROM)

    cand = batch.join(last_info, keys, "left")
    is_new = (F.col("_last_v").isNull()
              | (F.col(version_col) > F.col("_last_v"))
              | (F.col("_last_to").isNotNull() & (F.col(version_col) >= F.col("_last_v"))))
    new = next_in_key(cand.where(is_new), keys, version_col, VALID_TO, levels)
    new = new.withColumn(
        VALID_FROM,
        F.when(F.col("_last_to").isNotNull(), F.greatest(F.col(version_col), F.col("_last_to")))
         .otherwise(F.col(version_col))).drop("_last_v", "_last_to")

    first_new = new.groupBy(*keys).agg(F.min(version_col).alias("_first_new"))
    upd = open_rows.join(first_new, keys, "left")
    close_at = F.col("_first_new")
    if close_missing:
        upd = upd.join(batch_keys.withColumn("_present", F.lit(True)), keys, "left")
        now_lit = ts_literal(now) if now is not None else F.localtimestamp().cast(T.TimestampNTZType())
        close_at = F.coalesce(close_at, F.when(F.col("_present").isNull(), now_lit))
    upd = upd.withColumn(VALID_TO, close_at).select(*cols)
    new = new.select(*cols)
    newly_closed = upd.where(F.col(VALID_TO).isNotNull()).unionByName(new.where(F.col(VALID_TO).isNotNull()))
    new_open = upd.where(F.col(VALID_TO).isNull()).unionByName(new.where(F.col(VALID_TO).isNull()))
    return newly_closed, new_open


def late_changes(open_rows: DataFrame, closed_rows: DataFrame, batch: DataFrame, keys: Sequence[str],
                 version_col: str = "created_at", load_col: str = "ingestion_ts",
                 levels: Sequence[str] = ("day", "year")) -> tuple[DataFrame, DataFrame]:
    """What late versions and newer copies in ``batch`` change in a stored history: ``(retired, replacing)``.

    ``retired`` are stored rows (open or closed), ``replacing`` the rows that
    take their place and the late versions themselves; both hold keys of the
    batch only.  A version is late if its key has a stored row whose version is
    newer and none with the same version; it never touches an open row, as
    that one is newer.  All starts and ends of the late keys are events, and an
    interval ends at the next event of its key: the end that a row had, the
    next row's start or a late version inside it, whichever comes first.  This
    is one :func:`next_in_key` over the late keys, so no task holds all versions
    of a key, and ends set by hard deletes stay.  The batch, its late rows, their
    events and the changes are checkpointed, as each is read several times; none
    is larger than the batch and the stored rows of its keys.
    """
    keys = list(keys)
    cols = open_rows.columns
    tiebreak = [c for c in batch.columns if c not in set(keys) | {version_col, load_col}]
    batch = cut_lineage(versions_per_key(batch.where(F.col(version_col).isNotNull()), keys, version_col, load_col, tiebreak))
    rows = open_rows.unionByName(closed_rows)
    known = cut_lineage(rows.join(batch.select(*keys).distinct(), keys, "left_semi"))

    last = known.groupBy(*keys).agg(F.max(F.struct(VALID_FROM, version_col)).alias("_last"))
    late = cut_lineage(batch.join(last, keys).where(F.col(version_col) < F.col(f"_last.{version_col}")).drop("_last")
            .join(known.select(*keys, version_col), [*keys, version_col], "left_anti")
            .join(known.select(*keys, F.col(VALID_FROM).alias(version_col)), [*keys, version_col], "left_anti"))

    late_keys = late.select(*keys).distinct()
    concerned = known.join(late_keys, keys, "left_semi")
    events = (concerned.select(*keys, F.col(VALID_FROM).alias("_at"))
              .union(concerned.where(F.col(VALID_TO).isNotNull()).select(*keys, VALID_TO))
              .union(late.select(*keys, version_col))).distinct()
    following = cut_lineage(next_in_key(cut_lineage(events), keys, "_at", "_next", levels).select(*keys, "_at", "_next"))
    cut = (concerned.where(F.col(VALID_TO).isNotNull()).withColumn("_at", F.col(VALID_FROM))
           .join(following, [*keys, "_at"]).where(F.col("_next") < F.col(VALID_TO)).select(*cols, "_next"))
    added = (late.withColumn("_at", F.col(version_col)).join(following, [*keys, "_at"])
             .withColumn(VALID_FROM, F.col(version_col)).withColumn(VALID_TO, F.col("_next")).select(*cols))

    # Newer copies of stored versions keep their interval.
    fresh = batch.select(*keys, version_col, F.struct(*[c for c in cols if c not in (VALID_FROM, VALID_TO)]).alias("_fresh"))
    copies = (known.join(fresh, [*keys, version_col])
              .where(F.col(f"_fresh.{load_col}") > F.coalesce(F.col(load_col), F.lit("0001-01-01").cast(T.TimestampNTZType()))))
    retired = cut.select(*cols, "_next", F.lit(None).cast(fresh.schema["_fresh"].dataType).alias("_fresh")).unionByName(
        copies.select(*cols, F.lit(None).cast(T.TimestampNTZType()).alias("_next"), "_fresh"))
    # A row may be cut and replaced by a copy at once: one row per (key, start).
    names = [c for c in cols if c not in keys and c != VALID_FROM]
    changes = cut_lineage(retired.groupBy(*keys, VALID_FROM).agg(
        *[F.any_value(c).alias(c) for c in names], F.max("_next").alias("_next"), F.max("_fresh").alias("_fresh")))
    new_end = F.coalesce(F.col("_next"), F.col(VALID_TO)).alias(VALID_TO)
    replacing = changes.select(*[
        new_end if c == VALID_TO else F.col(c) if c in keys or c == VALID_FROM else
        F.when(F.col("_fresh").isNotNull(), F.col(f"_fresh.{c}")).otherwise(F.col(c)).alias(c) for c in cols])
    return changes.select(*cols), cut_lineage(replacing.unionByName(added))


def with_changes(rows: DataFrame, retired: DataFrame, replacing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows without the retired ones, and those that take their place."""
    return rows.join(retired.select(*keys, VALID_FROM), [*keys, VALID_FROM], "left_anti").unionByName(replacing)


def apply_scd2(history: DataFrame | None, batch: DataFrame, keys: Sequence[str],
               version_col: str = "created_at", load_col: str = "ingestion_ts",
               close_missing: bool = False, now=None,
               levels: Sequence[str] = ("day", "year"), late: str = "ignore") -> DataFrame:
    """Merge one batch of source versions into ``history`` (H1-H4), whole-table form.

    Closed rows pass through untouched, see :func:`apply_scd2_split`; with
    ``late="split"`` but for those that :func:`late_changes` cuts or replaces.
    """
    if late not in ("ignore", "split"):
        raise ValueError("late must be 'ignore' or 'split'")
    if history is None:
        return rebuild_scd2(batch, keys, version_col, load_col, levels)
    if late == "split":
        rows = history.where(F.col(VALID_TO).isNull()), history.where(F.col(VALID_TO).isNotNull())
        history = with_changes(history, *late_changes(*rows, batch, keys, version_col, load_col, levels), keys)
    open_rows = history.where(F.col(VALID_TO).isNull())
    closed_rows = history.where(F.col(VALID_TO).isNotNull())
    newly_closed, new_open = apply_scd2_split(open_rows, closed_rows, batch, keys, version_col,
                                              load_col, close_missing, now, levels)
    return closed_rows.unionByName(newly_closed).unionByName(new_open)
