"""Minimax contiguous partition of atomic groups into shards (law ``bytes``).

Rows with equal text form one atomic group.  Groups stand in the order of
their text's 64-bit hash (texts with one hash form one group), and shards are
runs of that order.  The smallest capacity for which a greedy pass needs no
more than the given shards is found by binary search, and the greedy pass of
that capacity makes the cuts, so the largest shard is as small as any
contiguous partition allows.  If a single group sets the capacity, it becomes
a shard of its own and the runs before and after it are cut again by the same
search over the shards left.  Shards that are still left over take half of
the largest run, so none is empty while there are groups enough.

Only sums leave Spark.  The driver holds weights of hash ranges, a few
thousand at a time: ranges are first coarse, then those in which a cut can
fall are split further until each is one group, which makes the search exact
at any number of groups.  A shard is then a comparison of a row's hash with
at most ``shards - 1`` cuts.

Edge cases: null text counts as empty (size 1); a group larger than the ideal
shard sets the capacity; with fewer groups than shards the last shards are
empty; an empty table gives an empty result; repeated rows and null ids are
rows like any other, dealt by their place in the stored table; extra columns
are ignored.
"""

from __future__ import annotations

from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martflow.llm.common import stored

SHARDS = 16
SLOT_BUCKETS = 256
FIRST_BITS = 12
MORE_BITS = 6


class Range(NamedTuple):
    """Groups whose hash shifted right by ``shift`` is ``key``."""

    key: int
    shift: int
    weight: int
    groups: int
    last: int  # largest hash present


def greedy(ranges: list[Range], capacity: int, shards: int, alone: frozenset[int] = frozenset()) -> list[int] | None:
    """Indexes of the ranges that end each shard but the last; None if ``shards`` don't suffice.

    Groups with a hash in ``alone`` fill a shard of their own.
    """
    ends, filled = [], 0
    for i, r in enumerate(ranges):
        weight = capacity if r.last in alone else r.weight
        if weight > capacity:
            return None
        if filled + weight > capacity:
            ends.append(i - 1)
            if len(ends) == shards:
                return None
            filled = 0
        filled += weight
    return ends


def _relaxed(ranges: list[Range], capacity: int, shards: int, alone: frozenset[int]) -> bool:
    """Whether ``shards`` could suffice if unsplit ranges could be cut anywhere."""
    used, filled = 1, 0
    for r in ranges:
        left = capacity if r.last in alone else r.weight
        if r.groups == 1:
            if left > capacity:
                return False
            if filled + left > capacity:
                used, filled = used + 1, 0
            filled += left
            continue
        while filled + left > capacity:
            left -= capacity - filled
            used, filled = used + 1, 0
        filled += left
    return used <= shards


def smallest(low: int, high: int, feasible) -> int:
    """Smallest integer in [low, high] that is feasible; ``high`` must be."""
    while low < high:
        middle = (low + high) // 2
        if feasible(middle):
            high = middle
        else:
            low = middle + 1
    return low


def _undecided(ranges: list[Range], low: int, high: int, shards: int, alone: frozenset[int]) -> list[Range]:
    """Ranges of several groups in which a cut can fall for a capacity in [low, high]."""
    begins, starts, at = [], [0], 0
    for r in ranges:
        begins.append(at)
        at += r.weight
        if r.last in alone:
            starts.append(at)  # cuts are counted anew behind a shard of one group
    found: dict[int, Range] = {}
    for first in starts:
        last = first
        for _ in range(shards - 1):
            first, last = min(at, first + low), min(at, last + high)
            hit = [i for i, r in enumerate(ranges) if begins[i] < last + 1 and begins[i] + r.weight > first - 1]
            for i in hit:
                if ranges[i].groups > 1:
                    found[i] = ranges[i]
            if hit:
                first = min(first, begins[hit[0]])
    return list(found.values())


class _Groups:
    """Hash ranges of ``groups`` (h, weight), split further on demand."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        self.ranges = self._sorted(self._summed(groups, 64 - FIRST_BITS))
        self.total = sum(r.weight for r in self.ranges)

    @staticmethod
    def _sorted(ranges: list[Range]) -> list[Range]:
        return sorted(ranges, key=lambda r: r.last)

    @staticmethod
    def _summed(df: DataFrame, shift: int) -> list[Range]:
        rows = (df.groupBy(F.shiftright("h", shift).alias("key"))
                .agg(F.sum("weight").alias("weight"), F.count("*").alias("n"), F.max("h").alias("last")).collect())
        return [Range(r.key, shift, r.weight, r.n, r.last) for r in rows]

    def split(self, some: list[Range]) -> None:
        finer = []
        for shift in {r.shift for r in some}:
            part = self.groups.where(F.shiftright("h", shift).isin([r.key for r in some if r.shift == shift]))
            finer += self._summed(part, max(0, shift - MORE_BITS))
        gone = {(r.shift, r.key) for r in some}
        self.ranges = self._sorted([r for r in self.ranges if (r.shift, r.key) not in gone] + finer)

    def capacity(self, shards: int, alone: frozenset[int] = frozenset()) -> int | None:
        """Smallest capacity with the groups ``alone`` in shards of their own; None if ``shards`` don't suffice."""
        while True:
            singles = [r.weight for r in self.ranges if r.groups == 1 and r.last not in alone]
            rest = self.total - sum(r.weight for r in self.ranges if r.last in alone and r.groups == 1)
            floor = max([1, -(-rest // max(1, shards - len(alone))), *singles])
            if greedy(self.ranges, self.total, shards, alone) is None:
                return None
            high = smallest(min(floor, self.total), self.total, lambda c: greedy(self.ranges, c, shards, alone) is not None)
            low = smallest(min(floor, high), high, lambda c: _relaxed(self.ranges, c, shards, alone))
            undecided = _undecided(self.ranges, low, high, shards, alone)
            if not undecided:
                return high
            self.split(undecided)


def _halved(groups: _Groups, ends: list[int], shards: int) -> list[int]:
    """Ends (hashes) with the largest divisible shard cut near its half until every shard has groups, if there are enough."""
    cuts_at = sorted(groups.ranges[i].last for i in ends)
    while len(cuts_at) < shards - 1:
        runs, run = [], []
        for r in groups.ranges:
            run.append(r)
            if r.last in cuts_at:
                runs, run = [*runs, run], []
        runs.append(run)
        wide = [run for run in runs if len(run) > 1]
        if wide:
            run = max(wide, key=lambda run: sum(r.weight for r in run))
            half, sums = sum(r.weight for r in run) / 2, list(accumulate(r.weight for r in run))
            best = min(range(len(run) - 1), key=lambda i: abs(sums[i] - half))
            cuts_at = sorted([*cuts_at, run[best].last])
            continue
        several = [r for r in groups.ranges if r.groups > 1]
        if not several:
            break
        groups.split(several)
    return cuts_at


def cuts(groups: DataFrame, shards: int = SHARDS) -> list[int]:
    """Largest hash of each shard but the last, for ``groups`` (h, weight)."""
    known = _Groups(groups)
    if not known.total:
        return []
    capacity, alone = known.capacity(shards), frozenset()
    while True:
        heavy = [r.last for r in known.ranges if r.groups == 1 and r.weight == capacity and r.last not in alone]
        if not heavy or len(alone) + len(heavy) >= shards:
            break
        smaller = known.capacity(shards, alone.union(heavy))
        if smaller is None or smaller >= capacity:
            break
        capacity, alone = smaller, alone.union(heavy)
    return _halved(known, greedy(known.ranges, capacity, shards, alone), shards)


def shard_rows(docs: DataFrame, shards: int = SHARDS, slot_buckets: int = SLOT_BUCKETS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard) of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    groups = stored(rows.groupBy("h").agg(F.sum("size").alias("weight")), "shard-groups")
    at = cuts(groups, shards)
    shard = F.lit(0)
    for cut in at:
        shard = shard + (F.col("h") > F.lit(cut)).cast("int")
    # Slots: rows of a shard are dealt by their stored number, which no repeated
    # row can skew, numbered in each part, and each part starts after those before it.
    dealt = rows.withColumn("shard", shard).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(slot_buckets)))
    sizes = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = sizes.select("shard", "part", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row"))
    # shards * slot_buckets rows at most
    return (dealt.withColumn("number", number).join(F.broadcast(before), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("number") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
