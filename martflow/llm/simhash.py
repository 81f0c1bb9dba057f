"""Document fingerprints: SimHash over weighted words and word pairs.

Terms are words (ASCII lower case) and pairs of adjacent words; longer words
weigh more, as short ones are common.  The 128-bit hash of each term votes
with its weight for (bit set) or against each bit, and the sign of the sum is
the fingerprint's bit.  Likeness is the share of equal bits.

``pairs_within`` finds all fingerprints within a Hamming radius.  The bits are
cut into blocks, and there is one table per choice of ``blocks - radius`` of
them (of one block if the radius is no smaller than their number), keyed by
their bits: the permuted block tables.  By the pigeonhole principle a match
differs in at most ``_tables``' number of errors over the blocks of some table
(none if the radius is below the number of blocks), so each query is looked up
with every choice of that many of their bits flipped, and an equi-join brings
every match together.  Candidates are verified by their distance and returned
from the first table that has them.

Edge cases: null text counts as empty, a text without words has fingerprint
zero; equal texts have equal fingerprints; repeated rows stand next to each
other in the order (doc_id, text hash), null ids first; a sole document is its
own next; an empty table gives an empty result; texts of any length are read
whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martflow.llm import words as W
from martflow.llm.common import stored

BITS = 128
HEAVIEST = 12  # bytes from which a word has full weight
PAIR_WEIGHT = 2.0
_SECOND = np.uint64(0xD6E8FEB86659FD93)


# Bits of each byte value, and where the values of each of the 16 bytes are counted.
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
_COUNTED_AT = 256 * np.arange(16)


def _votes(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of weights of set bits minus half of all, for each of the 128 bits."""
    total = np.zeros((16, 8))
    for low in range(0, len(hashes), 1 << 14):
        h, w = hashes[low:low + (1 << 14)], weights[low:low + (1 << 14)]
        octets = np.stack([h, W.mix(h ^ _SECOND)], axis=1).view(np.uint8).reshape(len(h), 16)
        by_value = np.bincount((octets + _COUNTED_AT).ravel(), np.repeat(w, 16), 16 * 256)
        total += by_value.reshape(16, 256) @ _BITS_OF_BYTE - w.sum() / 2
    return total.ravel()


def fingerprints(texts: pa.Array) -> list[bytes]:
    """16-byte fingerprint of each text; zero for a text without words."""
    out: list[bytes] = []
    for low, high in W.slices(texts):
        raw, at = W.buffer_of(texts.slice(low, high - low))
        w = W.words(raw, at, W.ALNUM)
        weight = np.minimum(w.end - w.start, HEAVIEST).astype(np.float32)
        pair, pair_doc = W.combine(w, 0, 1)
        same = w.doc[:-1] == w.doc[1:]
        pair_weight = PAIR_WEIGHT * np.minimum(weight[:-1], weight[1:])[same]
        rows = np.arange(high - low + 1)
        one, two = np.searchsorted(w.doc, rows), np.searchsorted(pair_doc, rows)
        for i in range(high - low):
            a, b, c, d = one[i], one[i + 1], two[i], two[i + 1]
            if a == b:
                out.append(bytes(16))
                continue
            hashes, first, count = np.unique(np.concatenate([w.hash[a:b], pair[c:d]]), return_index=True, return_counts=True)
            each = np.concatenate([weight[a:b], pair_weight[c:d]])[first]
            votes = _votes(hashes, each * np.log2(count + 1))
            out.append(np.packbits(votes > 0, bitorder="little").tobytes())
    return out


def likeness(a: bytes, b: bytes) -> float:
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``after``."""
    k = len(text) // 4
    return text[:len(text) - k] + after[:k]


# in document order ----------------------------------------------------------

ROW = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                 ("fp", pa.binary()), ("edited_fp", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                 ("is_first", pa.bool_()), ("is_last", pa.bool_()), ("text", pa.string())])
_DDL = ("part int, doc_id long, n_chars long, edited_sha256 string, fp binary, edited_fp binary, near_edited double, "
        "near_next double, is_first boolean, is_last boolean, text string")


def _finished(part, docs, texts, prints, after, first) -> pa.RecordBatch:
    """Rows of documents whose next text is known; ``after`` holds the next texts and fingerprints."""
    changed = [edited(t, n) for t, (n, _) in zip(texts, after)]
    changed_fp = fingerprints(pa.array(changed, pa.large_string()))
    return pa.RecordBatch.from_arrays([
        pa.array([part] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(map(len, texts), pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), pa.array(prints, pa.binary()),
        pa.array(changed_fp, pa.binary()), pa.array([likeness(a, b) for a, b in zip(prints, changed_fp)], pa.float64()),
        pa.array([likeness(a, b) for a, (_, b) in zip(prints, after)], pa.float64()),
        pa.array(first, pa.bool_()), pa.array([False] * len(docs), pa.bool_()),
        pa.array([t if f else None for t, f in zip(texts, first)], pa.string())], schema=ROW)


def _in_order(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range of documents; its first row keeps its text and its last waits for the next range."""
    part = TaskContext.get().partitionId()
    held = None  # (doc_id, text, fingerprint, is first) of the row before
    for b in it:
        docs, column = b.column("doc_id"), b.column("text").cast(pa.large_string()).fill_null("")
        for low, high in W.slices(column):
            texts, ids = column.slice(low, high - low), docs.slice(low, high - low).to_pylist()
            rows = list(zip(ids, texts.to_pylist(), fingerprints(texts), [held is None] + [False] * (len(ids) - 1)))
            rows = ([held] if held else []) + rows
            held = rows[-1]
            if len(rows) > 1:
                doc, text, fp, first = (list(c) for c in zip(*rows[:-1]))
                yield _finished(part, doc, text, fp, [(r[1], r[2]) for r in rows[1:]], first)
    if held:
        doc, text, fp, first = held
        yield pa.RecordBatch.from_pylist([{"part": part, "doc_id": doc, "n_chars": len(text), "fp": fp, "is_first": first,
                                           "is_last": True, "text": text}], ROW)


def _at_borders(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        r = b.to_pydict()
        yield _finished(0, r["doc_id"], r["text"], r["fp"], list(zip(r["next_text"], r["next_fp"])), [False] * b.num_rows)


def compare_in_order(docs: DataFrame) -> DataFrame:
    """One row per document in ascending doc_id: its fingerprint against its edited text's and the next document's."""
    ordered = docs.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    rows = stored(ordered.mapInArrow(_in_order, _DDL), "fingerprints-in-order")
    # Two rows per range at most: the last document of each meets the first of the next.
    borders = rows.where("is_first or is_last")
    firsts = borders.where("is_first").select("part", F.col("text").alias("next_text"), F.col("fp").alias("next_fp"))
    by_part = Window.orderBy("part")  # one row per range; the last goes on with the first
    after = firsts.select("part", F.coalesce(F.lead("part").over(by_part), F.min("part").over(by_part)).alias("next_part"))
    last = borders.where("is_last").select("part", "doc_id", "text", "fp").join(after, "part").join(
        firsts.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "fp", "next_text", "next_fp")
    ends = last.mapInArrow(_at_borders, _DDL)
    columns = ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"]
    return rows.where("not is_last").select(*columns).union(ends.select(*columns))


# search ---------------------------------------------------------------------

# Share of copies within the radius when 1, 2 or 3 words are replaced (958 texts of sf0.01, median 246 words):
# 0.40, 0.23, 0.15 for 3 bits; 0.93, 0.81, 0.67 for 9; 0.97, 0.90, 0.77 for 11, the most that six blocks find with one flip.
RADIUS = 11
BLOCKS = 6


def _tables(radius: int, blocks: int) -> tuple[list[int], int]:
    """Mask of each table's blocks, and the most bits in which a match differs under its best table."""
    borders = [round(BITS * k / blocks) for k in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(borders, borders[1:])]
    chosen = max(blocks - radius, 1)
    each, more = divmod(radius, blocks)  # a match spread as evenly as can be
    return [sum(c) for c in combinations(masks, chosen)], chosen * each + max(0, chosen - (blocks - more))


def _halves(values: list[int]) -> np.ndarray:
    return np.array([(v >> 64, v & (1 << 64) - 1) for v in values], np.uint64).reshape(-1, 2)


def block_keys(prints: DataFrame, radius: int, blocks: int, flip: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    """high and low half of each fingerprint, the ``keep`` columns, and number and key of each table.

    With ``flip`` also the keys after flipping up to the tables' number of errors.
    """
    masks, errors = _tables(radius, blocks)
    plan = []
    for mask in masks:
        places = [1 << p for p in range(BITS) if mask >> p & 1]
        flips = [sum(c) for n in range(errors + 1 if flip else 1) for c in combinations(places, n)]
        plan.append((_halves([mask]), _halves(flips)))
    columns = [*keep, "high", "low", "table", "key"]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for start in range(0, b.num_rows, 1 << 12):
                part = b.slice(start, 1 << 12)
                fp = np.frombuffer(b"".join(part.column("fp").to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
                for number, (mask, flips) in enumerate(plan):
                    bits = (fp & mask)[:, None, :] ^ flips
                    key = W.mix(W.mix(bits[..., 0] ^ _SECOND) ^ bits[..., 1]) + np.uint64(number)
                    row = np.repeat(np.arange(len(fp)), len(flips))
                    yield pa.RecordBatch.from_arrays([
                        *(part.column(c).take(pa.array(row)) for c in keep), pa.array(fp[row, 0].view(np.int64)),
                        pa.array(fp[row, 1].view(np.int64)), pa.array(np.full(len(row), number, np.int32)),
                        pa.array(key.ravel().view(np.int64))], columns)

    source = prints.select("fp", *keep)
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in source.select(*keep).schema.fields) if keep else ""
    return source.mapInArrow(batches, f"{kept}high long, low long, table int, key long")


def pairs_within(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(fp, found, distance, rows): every corpus fingerprint within ``radius`` of each query fingerprint.

    Both sides are first reduced to distinct fingerprints, so copies cost
    nothing; ``rows`` is the number of corpus rows of ``found``, and the
    corpus itself says which documents these are.
    """
    if not 0 < blocks <= BITS or radius < 0:
        raise ValueError("the bits must be cut into 1 to 128 blocks")
    a = stored(block_keys(queries.select("fp").distinct(), radius, blocks, True), "query-blocks").alias("a")
    c = stored(corpus.groupBy("fp").agg(F.count("*").alias("rows")), "corpus-prints")
    b = block_keys(c, radius, blocks, False, ("rows",)).alias("b")
    high, low = F.col("a.high").bitwiseXOR(F.col("b.high")), F.col("a.low").bitwiseXOR(F.col("b.low"))
    distance = F.bit_count(high) + F.bit_count(low)
    # the first table in which the pair meets: no other returns it
    masks, errors = _tables(radius, blocks)
    first = F.lit(None).cast("int")
    for number, (mask_high, mask_low) in reversed(list(enumerate(_halves(masks).view(np.int64).tolist()))):
        under = F.bit_count(high.bitwiseAND(F.lit(mask_high).cast("long"))) + F.bit_count(low.bitwiseAND(F.lit(mask_low).cast("long")))
        first = F.when(under <= errors, F.lit(number)).otherwise(first)
    match = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.table") == F.col("b.table"))
                   & (distance <= radius) & (first == F.col("a.table")))

    def whole(side: str) -> Column:
        return F.unhex(F.concat(*(F.lpad(F.hex(F.col(f"{side}.{half}")), 16, "0") for half in ("high", "low"))))
    return match.select(whole("a").alias("fp"), whole("b").alias("found"), distance.alias("distance"), F.col("b.rows").alias("rows"))


def within(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(fp, n, found): corpus rows within ``radius`` of each distinct query fingerprint, their number and fingerprints.

    ``found`` is an array of (distance, fingerprint in hex digits), nearest first.
    """
    return pairs_within(queries, corpus, radius, blocks).groupBy("fp").agg(
        F.sum("rows").alias("n"),
        F.sort_array(F.collect_list(F.struct("distance", F.lower(F.hex("found")).alias("fingerprint")))).alias("found"))
