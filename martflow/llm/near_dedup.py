"""SimHash near-dedup with Golay-code fuzzy keys.

A document's 64-bit fingerprint takes the majority of the XXH64 hashes of its
word shingles.  Fingerprints that differ in at most four bits are linked; a
component of links is a group of near copies.

Finding links.  The 64 bits are cut into three segments.  Two fingerprints at
distance four or less differ in at most two bits over some pair of segments,
so one word of that pair lies within one bit of both.  The (23,12) Golay code
is perfect: every 23-bit word (shorter segments are zero-extended) decodes to
exactly one codeword.  The keys of a fingerprint are therefore the codeword
indices of a segment pair after flipping no or one bit of it, and linked
fingerprints share at least one key.  Everything under a key is verified by
its bit distance.  ``segments`` and ``chosen`` trade keys for their length:
(3, 2) gives about 29 keys of 24 bits, good to some hundred million distinct
fingerprints; (5, 3) gives 36 bits, for more.

Edge cases: null or blank text has fingerprint zero and is linked like any
other; fewer words than a shingle form one shingle; equal texts and repeated
rows share a fingerprint and so a component; a null ``doc_id`` keeps its row
and takes its component from the others (null if there are none); an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm import words as W
from martflow.llm.common import drop_rows, stored

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4

# Generator polynomial of the binary (23,12) Golay code,
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0xC75


# fingerprints ---------------------------------------------------------------

def _majority(hashes: np.ndarray) -> int:
    """64-bit word whose bits are set in over half of ``hashes``."""
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 15):
        part = hashes[low:low + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_text(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of one UTF-8 text."""
    found = text.lower().split() if text else []
    n = len(found)
    if not n:
        return 0
    joined = b" ".join(found)
    if n <= shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = list(accumulate(map(len, found), lambda a, b: a + b + 1))
        starts = [0, *(e + 1 for e in ends[:n - shingle_words])]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle_words - 1:])),
                             np.uint64, n - shingle_words + 1)
    return _majority(hashes)


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (long) and the ``keep`` columns of every document, whole texts."""
    cols = ["doc_id", *keep]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = b.column("__text")
            fp = [fingerprint_text(None if not x.is_valid else bytes(x.as_buffer()), shingle_words) for x in texts]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(fp, pa.int64())], [*cols, "fp"])

    source = docs.select(*cols, F.col("text").cast("binary").alias("__text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.select(*cols).schema.fields)
    return source.mapInArrow(W.released(batches), f"{schema}, fp long")


# Golay keys -----------------------------------------------------------------

def _remainders(bits: int, offset: int) -> np.ndarray:
    """Remainder by the generator of each ``bits``-bit word shifted left by ``offset``."""
    v = np.arange(1 << bits, dtype=np.int64) << offset
    for top in range(22, 10, -1):
        v = np.where(v >> top & 1, v ^ GENERATOR << (top - 11), v)
    return v.astype(np.int32)


def _decoder() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and high 11 bits, and the error word of each remainder."""
    low, high = _remainders(12, 0), _remainders(11, 12)
    error = np.zeros(2048, np.int32)
    for weight in (1, 2, 3):
        for places in combinations(range(23), weight):
            word = sum(1 << p for p in places)
            error[low[word & 0xFFF] ^ high[word >> 12]] = word
    return low, high, error


_table: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def decode(word: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    if not _table:
        _table.append(_decoder())
    low, high, error = _table[0]
    word = word.astype(np.int32)
    return (word ^ error[low[word & 0xFFF] ^ high[word >> 12]]) >> 11


SEGMENTS, CHOSEN = 3, 2


def golay_keys(fp: np.ndarray, segments: int = SEGMENTS, chosen: int = CHOSEN) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every fuzzy key of the fingerprints; a key once per row."""
    bits = fp.view(np.uint64)
    near = []
    borders = np.linspace(0, 64, segments + 1).round().astype(int).tolist()
    for start, length in zip(borders, np.diff(borders).tolist()):
        word = (bits >> np.uint64(start) & np.uint64((1 << length) - 1)).astype(np.int32)
        flips = np.array([0, *(1 << k for k in range(length))], np.int32)
        near.append(decode(word[:, None] ^ flips).astype(np.int64))
    rows, keys = [], []
    for number, members in enumerate(combinations(near, chosen)):
        base = sum(m[:, :1] << 12 * i for i, m in enumerate(members))
        # no bit flipped, or one bit of one segment
        found = np.concatenate([base, *(base + (m[:, 1:] - m[:, :1] << 12 * i) for i, m in enumerate(members))], axis=1)
        found.sort(axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        r, c = np.nonzero(new)
        rows.append(r)
        keys.append(found[r, c] | np.int64(number) << 12 * chosen)
    return np.concatenate(rows), np.concatenate(keys)


def _key_batches(it: Iterator[pa.RecordBatch], segments: int, chosen: int) -> Iterator[pa.RecordBatch]:
    for b in it:
        fp = b.column("fp").to_numpy(zero_copy_only=False)
        for low in range(0, len(fp), 1 << 13):
            part = fp[low:low + (1 << 13)]
            row, key = golay_keys(part, segments, chosen)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], ["key", "fp"])


# links ----------------------------------------------------------------------

def spanning_links(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect exactly the components of ``fp`` under ``max_bits``.

    Breadth first: every fingerprint is compared with those not reached yet,
    so a dense group costs about its size and gives one link per member.
    """
    left, right = [], []
    rest = fp
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count((rest ^ at).view(np.uint64)) <= max_bits
            if near.any():
                reached = rest[near]
                rest = rest[~near]
                left.append(np.full(len(reached), at))
                right.append(reached)
                frontier.extend(reached)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


SMALL_RUN = 16


def run_links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal (sorted) keys, each pair at most once."""
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(edge, len(key)))
    left, right = [], []
    small = np.repeat(size <= SMALL_RUN, size)
    for gap in range(1, SMALL_RUN):  # all pairs of short runs, by distance within the run
        a = np.flatnonzero((key[gap:] == key[:-gap]) & small[gap:]) if len(key) > gap else np.zeros(0, np.int64)
        if not len(a):
            break
        ok = np.bitwise_count((fp[a] ^ fp[a + gap]).view(np.uint64)) <= max_bits
        left.append(fp[a[ok]])
        right.append(fp[a[ok] + gap])
    for at, n in zip(edge[size > SMALL_RUN], size[size > SMALL_RUN]):
        a, b = spanning_links(fp[at:at + n], max_bits)
        left.append(a)
        right.append(b)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _link_batches(max_bits: int):
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in it:
            key = np.concatenate([key, b.column("key").to_numpy()])
            fp = np.concatenate([fp, b.column("fp").to_numpy()])
            if len(key) < 1 << 16:
                continue
            done = int(np.searchsorted(key, key[-1]))  # the last run may go on in the next batch
            if done:
                a, c = run_links(key[:done], fp[:done], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])
                key, fp = key[done:], fp[done:]
        if len(key):
            a, c = run_links(key, fp, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])
    return batches


HOT_KEY = 4096


def links(distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, chosen: int = CHOSEN) -> DataFrame:
    """(a, b): enough verified links to connect every component of distinct ``fp``.

    A key with over ``HOT_KEY`` fingerprints is dealt in blocks: each pair of
    blocks is one smaller run, so no task holds a whole hot key.
    """
    if max_bits * chosen // segments > 2 or not 0 < chosen < segments or 64 > 23 * segments:
        raise ValueError("the chosen segments must hold at most two of the differing bits")
    keys = stored(distinct.select("fp").mapInArrow(lambda it: _key_batches(it, segments, chosen), "key long, fp long"),
                  "golay-keys")
    hot = stored(keys.groupBy("key").count().where(F.col("count") > HOT_KEY)
                 .select(F.col("key").alias("hot_key"), F.ceil(F.col("count") / HOT_KEY).cast("int").alias("blocks")),
                 "golay-hot")
    joined = keys.join(hot, keys.key == hot.hot_key, "left")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    cells = joined.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, coalesce(blocks, 1) - 1)")))
    cells = cells.select(
        F.when(F.col("blocks").isNull(), F.col("key")).otherwise(
            F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).bitwiseOR(F.lit(1 << 62))).alias("key"),
        "fp")
    dealt = cells.repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(_link_batches(max_bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b).

    Smallest-label propagation with pointer jumping; each round's labels are a
    stored table.  Ends when a round changes no label.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("near"))
        best = labels.join(seen, labels.node == seen.a).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        best = stored(best, "labels-near")
        jump = best.select(F.col("node").alias("via"), F.col("root").alias("far"))
        after = best.join(jump, best.root == jump.via, "left").select(
            "node", F.coalesce("far", "root").alias("root"),
            (F.coalesce("far", "root") != F.col("old")).alias("changed"))
        after = stored(after, "labels")
        if after.where("changed").isEmpty():
            return after.select("node", "root")
        labels = after.select("node", "root")


def _grouped(docs: DataFrame, shingle_words: int, max_bits: int, keep: tuple[str, ...]) -> DataFrame:
    """doc_id, fp, the ``keep`` columns, root (of the group, never null) and component_id of every document."""
    prints = stored(fingerprints(docs, shingle_words, keep), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, max_bits))
    member = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    member = stored(member, "members")
    smallest = stored(member.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    of = stored(member.join(smallest, "root").select("fp", "root", "component_id"), "component-of")
    return prints.join(of, "fp")


def near_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and ``keep`` columns of every document."""
    return _grouped(docs, shingle_words, max_bits, keep).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", *keep)


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group: that with the smallest doc_id (null if it has no other), then text hash.

    Repeated rows of it count once; rows of other groups with the same id, or also without one, stay.
    """
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    found = stored(_grouped(hashed, shingle_words, max_bits, ("text_hash",))
                   .select("doc_id", "text_hash", "root", "component_id"), "near-groups")
    is_first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    firsts = stored(found.where(is_first).groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("rows")), "near-firsts")
    several = stored(firsts.groupBy("root").agg(F.min("text_hash").alias("best"), F.count("*").alias("texts"))
                     .where("texts > 1").select("root", "best"), "near-several")
    others = firsts.join(several, "root").where("text_hash != best").select("doc_id", "text_hash")
    gone = stored(found.where(~is_first).select("doc_id", "text_hash").distinct().union(others), "near-copies")
    kept = drop_rows(docs, gone)
    if firsts.where("rows > 1").isEmpty():
        return kept
    return kept.withColumn("__hash", F.xxhash64("text")).dropDuplicates(["doc_id", "__hash"]).select(*docs.columns)
