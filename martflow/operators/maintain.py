"""Grouped aggregates kept up to date from what changed, instead of from all rows.

A :class:`Measures` names the group keys and the aggregates of a mart: a row
count, sums and extremes (min / max).  ``aggregate`` computes its state from all
rows; ``apply_delta`` brings a state up to date from the rows of the rewritten
partitions *before* and *after* the change:

* counts and sums: the old contribution is subtracted, the new one added, in one
  partial aggregation over the two row sets (a hot group ships one row per task);
* extremes: a group's extreme stays unless it was among the rows that went.  If
  the new rows hold one at least as good, that is it; else the group's extreme
  was retracted, and only such groups are recomputed from the source (a semi
  join on the keys, columns of keys and extremes only).  Without such groups the
  source is not read;
* groups without a row left are dropped.

Groups are compared null-safe: NULL is a group of its own, as in GROUP BY.  A sum
keeps the number of its non-NULL inputs beside it, so it turns NULL again when
the last of them goes.  Sums are decimals, so subtracting is exact.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.columns import agg_money, money_sum
from martflow.session import cut_lineage

ROWS = "_rows"


@dataclass(frozen=True)
class Measures:
    """``keys`` and inputs are columns of the prepared rows; names on the left are those of the state."""

    keys: tuple[str, ...]
    sums: Mapping[str, str] = field(default_factory=dict)
    minima: Mapping[str, str] = field(default_factory=dict)
    maxima: Mapping[str, str] = field(default_factory=dict)

    @property
    def extremes(self) -> dict[str, tuple[str, bool]]:
        """State column -> (input, whether it is a maximum)."""
        return {o: (c, False) for o, c in self.minima.items()} | {o: (c, True) for o, c in self.maxima.items()}

    @property
    def columns(self) -> list[str]:
        return [*self.keys, ROWS, *[x for o in self.sums for x in (o, f"_n_{o}")], *self.extremes]


def same_keys(left: DataFrame, right: DataFrame, keys, prefix: str = "_k_") -> tuple[DataFrame, Column]:
    """``right`` with renamed keys, and the null-safe condition that both rows are of one group."""
    renamed = right.withColumnsRenamed({k: prefix + k for k in keys})
    return renamed, reduce(lambda a, b: a & b, [left[k].eqNullSafe(F.col(prefix + k)) for k in keys])


def _best(maximum: bool, c) -> Column:
    return F.max(c) if maximum else F.min(c)


def aggregate(rows: DataFrame, m: Measures) -> DataFrame:
    """State from all rows."""
    aggs = [F.count(F.lit(1)).alias(ROWS)]
    for out, c in m.sums.items():
        aggs += [money_sum(rows, c).alias(out), F.count(c).alias(f"_n_{out}")]
    aggs += [_best(top, c).alias(out) for out, (c, top) in m.extremes.items()]
    return rows.groupBy(*m.keys).agg(*aggs).select(*m.columns)


def delta(before: DataFrame, after: DataFrame, m: Measures) -> DataFrame:
    """Change of every group: signed counts and sums, extremes of the old and of the new rows; unchanged groups are left out."""
    inputs = sorted({*m.sums.values(), *(c for c, _ in m.extremes.values())} - set(m.keys))
    both = before.select(*m.keys, *inputs, F.lit(-1).alias("_sign")).unionByName(
        after.select(*m.keys, *inputs, F.lit(1).alias("_sign")))
    aggs = [F.sum("_sign").alias("_d_rows")]
    for out, c in m.sums.items():
        aggs += [agg_money(F.sum(F.col("_sign") * F.col(c))).alias(f"_d_{out}"),
                 F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.col("_sign"))), F.lit(0)).alias(f"_dn_{out}")]
    for out, (c, top) in m.extremes.items():
        aggs += [_best(top, F.when(F.col("_sign") == s, F.col(c))).alias(f"_{name}_{out}") for s, name in ((-1, "old"), (1, "new"))]
    changed = [F.col("_d_rows") != 0]
    changed += [(F.coalesce(F.col(f"_d_{o}"), F.lit(0)) != 0) | (F.col(f"_dn_{o}") != 0) for o in m.sums]
    changed += [~F.col(f"_old_{o}").eqNullSafe(F.col(f"_new_{o}")) for o in m.extremes]
    return both.groupBy(*m.keys).agg(*aggs).where(reduce(lambda a, b: a | b, changed))


def apply_delta(state: DataFrame, before: DataFrame, after: DataFrame, source: DataFrame, m: Measures) -> tuple[DataFrame, DataFrame]:
    """``(touched, rows)``: keys of all groups that changed, and the new state rows of those that still have rows.

    ``source`` holds all rows after the change.  The state itself is read by the
    changed keys only.
    """
    changes, same = same_keys(state, cut_lineage(delta(before, after, m)), m.keys)
    old = changes.join(state, same, "left")
    out = [F.col(f"_k_{k}").alias(k) for k in m.keys]
    out.append((F.coalesce(ROWS, F.lit(0)) + F.col("_d_rows")).alias(ROWS))
    for o in m.sums:
        n = F.coalesce(f"_n_{o}", F.lit(0)) + F.col(f"_dn_{o}")
        total = F.coalesce(o, F.lit(0)) + F.coalesce(f"_d_{o}", F.lit(0))
        out += [F.when(n > 0, agg_money(total)).alias(o), n.alias(f"_n_{o}")]
    lost = F.lit(False)
    for o, (_, top) in m.extremes.items():
        went, came, held = F.col(f"_old_{o}"), F.col(f"_new_{o}"), F.col(o)
        at_least = (lambda a, b: a >= b) if top else (lambda a, b: a <= b)
        retracted = F.coalesce(at_least(went, held), F.lit(False))
        replaced = F.coalesce(at_least(came, held), F.lit(False))
        lost = lost | (retracted & ~replaced)
        out.append((F.greatest if top else F.least)(held, came).alias(o))
    found = cut_lineage(old.select(*out, lost.alias("_lost")))
    touched = found.select(*m.keys)
    found = found.where(F.col(ROWS) > 0)
    kept = found.where(~F.col("_lost")).select(*m.columns)
    again = found.where("_lost")
    if not m.extremes or again.isEmpty():
        return touched, kept
    wanted, same = same_keys(source, again.select(*m.keys), m.keys)
    inputs = sorted({c for c, _ in m.extremes.values()} - set(m.keys))
    fresh = source.select(*m.keys, *inputs).join(wanted, same, "left_semi").groupBy(*m.keys).agg(
        *[_best(top, c).alias(o) for o, (c, top) in m.extremes.items()])
    fresh, same = same_keys(again, fresh, m.keys)
    mended = again.drop(*m.extremes).join(fresh, same).select(*m.columns)
    return touched, kept.unionByName(mended)


def maintained(state: DataFrame, touched: DataFrame, rows: DataFrame, m: Measures) -> DataFrame:
    """The whole state after a change: untouched groups and the new rows."""
    gone, same = same_keys(state, touched, m.keys)
    return state.join(gone, same, "left_anti").select(*m.columns).unionByName(rows.select(*m.columns))
