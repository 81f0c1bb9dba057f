"""Cross-tokenizer alignment: which tokens of two tokenizers end together, and how often over the corpus.

Tokenizer A is a byte-level BPE file whose ids follow its merges (tiktoken
reads these as ranks, the tokenizers library takes very long words), B a SentencePiece model.  Both read a
space and the text, both tokenize it losslessly (a text whose joined token bytes of
either differ has no tokens).  Byte offsets at which a token of A and one of B
end cut the tokens into groups; the two last tokens of a group are linked.

Both tokenizers work on units: a run of white space that begins with a space
or line break, and what follows up to the next one.  No rule of A and no piece
of B reaches across the begin of a unit (the pieces are checked when loaded),
so a text is the concatenation of its units, each distinct unit is
tokenized and aligned once per worker while cached, and unit ends are group ends.

Counts of linked id pairs are exact and come in two passes:

1. Every task aligns its documents and writes its distinct pairs with their
   local counts.  The shorter token of a linked pair is a suffix of the
   longer, so the vocabularies bound the number of distinct pairs
   (``Tokenizers.most_pairs``, 324,300 for the public files), whatever
   the corpus; that is why they may be gathered.  A minimal perfect hash gives each
   pair its own place in a dense vector; the written partial counts become one vector
   per task, and the vectors are summed up a tree (``FAN`` to one, block by block).
2. The hash, its keys and the counts go to all tasks, which align the
   documents again and look every link up; the key at the place is compared,
   so a pair that was not counted is not taken for another one.

Edge cases: null or empty text, and texts that a tokenizer changes (U+2581),
have zeros and the empty digest; white space alone has tokens; special tokens'
strings are plain text; texts and units of any length are taken whole;
repeated rows count as often as they stand; null ids stay; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm import words as W
from martflow.llm.bpe import byte_alphabet
from martflow.llm.common import stored

SPACE = "▁"
CACHE_UNITS = 500_000
CACHE_BYTES = 64 << 20  # of the cached group texts
SLICE = 1 << 20  # bytes of text aligned at once
JOIN = 256  # units tokenized by one call of the libraries
LONG_UNIT = 1 << 16  # bytes
# Fixed value: how a byte-level pre-tokenizer with ``use_regex`` splits a text.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FAN = 16
BLOCK = 8192  # counts summed as one row

# Bytes of white space that ends in a continuation byte: its last byte, and the byte before.
_BLANK_LAST = np.zeros(256, bool)
_BLANK_LAST[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_BLANK_BEFORE = np.zeros(256, bool)
_BLANK_BEFORE[[0x80, 0x81, 0x9A, 0xC2]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(0x1C, 0x21)]] = True


# units ------------------------------------------------------------------------

def spaced(texts: pa.Array) -> pa.Array:
    """A space before every text; null and empty ones stay empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    blank, empty = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    return pc.if_else(pc.equal(texts, empty), texts, pc.binary_join_element_wise(blank, texts, empty))


def unit_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First byte of every unit: each text's, and each space or line break that follows no white space."""
    starts = np.zeros(len(raw) + 1, bool)
    blank = _BLANK[raw]
    after = blank.copy()  # white space ends at this byte
    if len(raw) > 1:
        after[1:] |= _BLANK_LAST[raw[1:]] & _BLANK_BEFORE[raw[:-1]]
        starts[1:-1] = ((raw[1:] == 32) | (raw[1:] == 10)) & ~after[:-1]
    starts[at[:-1][at[1:] > at[:-1]]] = True
    starts[-1] = False
    return np.flatnonzero(starts)


def segment_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of adjoining byte ranges."""
    out = np.empty(len(start), np.uint64)
    k = 0
    while k < len(start):
        stop = max(k + 1, int(np.searchsorted(end, start[k] + W.BLOCK, "right")))
        low, high = int(start[k]), int(end[stop - 1])
        if high - low <= W.BLOCK:
            up, down = W._power(high - low)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * up[:high - low], out=sums[1:])
            s, e = start[k:stop] - low, end[k:stop] - low
            out[k:stop] = W.mix((sums[e] - sums[s]) * down[s])
        k = stop
    for k in np.flatnonzero(end - start > LONG_UNIT):
        out[k] = xxhash.xxh64_intdigest(raw[start[k]:end[k]])
    return out


# tokenizers -------------------------------------------------------------------

class Tokenizers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        vocabulary, merges = model["vocab"], [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        first = len(vocabulary) - len(merges)
        if spec["normalizer"] or split["type"] != "ByteLevel" or not split["use_regex"] or split["add_prefix_space"] or any(
                vocabulary[m.replace(" ", "")] != first + i for i, m in enumerate(merges)):
            raise ValueError("a rule of this tokenizer file is not known, or its ids are not in the order of its merges")
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token)
        # Ids in the order of the merges are ranks, which the faster encoder takes; special tokens stay plain text.
        self.ranked = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, special_tokens={},
                                        mergeable_ranks={x: i for i, x in enumerate(self.a_bytes) if x})
        self.whole = Tokenizer.from_file(a_path)  # for very long words
        self.whole.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        ids = range(self.b.get_piece_size())
        pieces = [self.b.id_to_piece(i) for i in ids]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in zip(ids, pieces)]
        plain = [p for i, p in zip(ids, pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in plain):
            raise ValueError("a piece reaches across the begin of a word")
        self.start = self.b.encode("\n", num_threads=1)  # put before units, so that they stand inside a text
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.a_length = self.a_size.tolist()
        ids = range(max(len(self.a_bytes), len(self.b_bytes)))
        self.ready = [b"%d%s" % (i, after) for after in (b",", b"|", b";", b"") for i in ids]  # id and what follows it

    def most_pairs(self) -> int:
        """Number of id pairs of which one token's bytes end with the other's: no other pair can be linked."""
        def ids_of(tokens: list[bytes]) -> dict[bytes, int]:
            out: dict[bytes, int] = {}
            for t in tokens:
                out[t] = out.get(t, 0) + 1
            return out
        a, b = ids_of(self.a_bytes), ids_of(self.b_bytes)
        shorter_b = sum(b.get(t[k:], 0) for t in self.a_bytes for k in range(len(t)))
        shorter_a = sum(a.get(t[k:], 0) for t in self.b_bytes for k in range(1, len(t)))
        return shorter_a + shorter_b

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        return (self.ranked.encode_ordinary(text) if len(text) <= 2 * LONG_UNIT else
                self.whole.encode(text, add_special_tokens=False).ids,
                self.b.encode("\n" + text, num_threads=1)[len(self.start):])

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all units in one array each, and which units both give back.

        Units are tokenized many at a time, as the text that they form; a group that
        does not give this text back is taken unit by unit.
        """
        a_ids, b_ids, good = [], [], np.ones(len(units), bool)
        low = 0
        while low < len(units):
            high, size = low + 1, len(units[low])
            while high < len(units) and high - low < JOIN and size < LONG_UNIT and units[high - 1][-1] > 32:
                size += len(units[high])
                high += 1
            joined = b"".join(units[low:high])
            a, b = self.encode(str(joined, "utf-8"))
            if sum([self.a_length[i] for i in a]) == len(joined) and b"".join([self.b_bytes[i] for i in b]) == joined:
                a_ids += a
                b_ids += b
            else:
                for k in range(low, high):
                    a, b = self.encode(str(units[k], "utf-8"))
                    good[k] = b"".join([self.a_bytes[i] for i in a]) == units[k] == b"".join([self.b_bytes[i] for i in b])
                    if good[k]:
                        a_ids += a
                        b_ids += b
            low = high
        return np.array(a_ids, np.int64), np.array(b_ids, np.int64), good


class Aligned(NamedTuple):
    """Aligned units: group text, numbers of tokens and groups, linked pairs of all units in one array."""

    text: list[bytes]
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray
    good: np.ndarray


def align(t: Tokenizers, units: list[bytes], with_text: bool = True) -> Aligned:
    """Groups and links of each unit (none of a unit that a tokenizer changes); the group text is empty if not asked for."""
    a, b, good = t.encode_units(units)
    sizes = np.fromiter(map(len, units), np.int64, len(units)) * good
    ends = np.cumsum(sizes)
    a_end, b_end = np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b])
    total = int(ends[-1]) if len(ends) else 0
    ended = np.zeros(total + 1, np.int8)
    ended[a_end] += 1
    ended[b_end] += 1
    a_cut, b_cut = np.flatnonzero(ended[a_end] == 2), np.flatnonzero(ended[b_end] == 2)
    pairs = a[a_cut] << 32 | b[b_cut]
    groups = np.searchsorted(a_end[a_cut], ends, "right")  # groups up to the end of each unit
    upto_a, upto_b = np.searchsorted(a_end, ends, "right"), np.searchsorted(b_end, ends, "right")
    first = np.concatenate([[0], groups[:-1]]).astype(np.int64)
    return Aligned(_group_texts(t, a, b, a_cut, b_cut, groups) if with_text else [b""] * len(units),
                   np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0), groups - first, pairs, good)


def _group_texts(t: Tokenizers, a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, groups: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each unit: ids with what follows them, joined once."""
    # the separator after each token is chosen by an offset into three lists of ready texts
    size = len(t.ready) // 4
    a_kind, b_kind = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_kind[a_cut], b_kind[b_cut] = size, 2 * size
    last = groups[np.diff(groups, prepend=0) > 0] - 1
    b_kind[b_cut[last]] = 3 * size
    # A tokens of a group come before its B tokens
    order = np.argsort(np.concatenate([2 * np.searchsorted(a_cut, np.arange(len(a))),
                                       2 * np.searchsorted(b_cut, np.arange(len(b))) + 1]), kind="stable")
    parts = [t.ready[i] for i in np.concatenate([a + a_kind, b + b_kind])[order].tolist()]
    upto = np.concatenate([[0], np.append(-1, a_cut)[groups] + np.append(-1, b_cut)[groups] + 2]).tolist()
    return [b"".join(parts[x:y]) for x, y in zip(upto, upto[1:])]


class Units:
    """Aligned distinct units of a worker, at most ``limit`` (or ``CACHE_BYTES`` of text); then it starts anew."""

    def __init__(self, tokenizers: Tokenizers, limit: int = CACHE_UNITS, with_text: bool = True):
        self.tokenizers, self.limit, self.with_text = tokenizers, limit, with_text
        self.clear()

    def clear(self) -> None:
        self.known, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.held = 0
        self.data = Aligned([], *(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, bool))

    def full(self) -> bool:
        return len(self.known) >= self.limit or self.held > CACHE_BYTES

    def rows(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Row of each unit in ``data``; unknown units are aligned and added."""
        distinct, first, which = np.unique(segment_hashes(raw, start, end), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        seen = place < len(self.known)
        seen[seen] = self.known[place[seen]] == distinct[seen]
        if not seen.all():
            view, new = memoryview(raw), first[~seen]
            found = align(self.tokenizers, [bytes(view[x:y]) for x, y in zip(start[new].tolist(), end[new].tolist())],
                          self.with_text)
            rows = len(self.data.text) + np.arange(len(new))
            self.data.text.extend(found.text)
            self.held += sum(map(len, found.text))
            self.data = Aligned(self.data.text, *(np.concatenate(x) for x in zip(self.data[1:], found[1:])))
            known, row = np.concatenate([self.known, distinct[~seen]]), np.concatenate([self.row, rows])
            order = np.argsort(known)
            self.known, self.row = known[order], row[order]
            place = np.searchsorted(self.known, distinct)
        return self.row[place][which]


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


def _slices(it: Iterator[pa.RecordBatch], units: Units) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_id, rows of all units, first unit of each text (and the end), and whether each text has tokens."""
    for b in it:
        text, doc = b.column("text"), b.column("doc_id")
        for low, high in W.slices(text, SLICE):
            raw, at = W.buffer_of(spaced(text.slice(low, high - low)))
            start = unit_starts(raw, at)
            rows = units.rows(raw, start, np.append(start[1:], len(raw)))
            first = np.searchsorted(start, at)
            bad = np.concatenate([[0], np.cumsum(~units.data.good[rows])])
            yield doc.slice(low, high - low), rows, first, (bad[first[1:]] == bad[first[:-1]]) & (first[1:] > first[:-1])


# counting ---------------------------------------------------------------------

def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, which = np.unique(keys, return_inverse=True)
    out = np.zeros(len(distinct), np.int64)
    np.add.at(out, which, n)
    return distinct, out


def _pair_batches(it: Iterator[pa.RecordBatch], a_path: str, b_path: str, cache_units: int) -> Iterator[pa.RecordBatch]:
    units = Units(tokenizers(a_path, b_path), cache_units, with_text=False)
    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    used = np.zeros(0, np.int64)  # occurrences of each cached unit

    def moved() -> tuple[np.ndarray, np.ndarray]:
        each = np.repeat(used, units.data.n_links[:len(used)])
        return _summed(np.concatenate([keys, units.data.pairs[:len(each)][each > 0]]), np.concatenate([n, each[each > 0]]))

    for _, rows, first, has in _slices(it, units):
        counted = np.bincount(rows[np.repeat(has, np.diff(first))], minlength=len(units.data.text))
        counted[:len(used)] += used
        used = counted
        if units.full():
            keys, n = moved()
            used = used[:0]
            units.clear()
    keys, n = moved()
    for low in range(0, len(keys), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(keys[low:low + (1 << 16)]), pa.array(n[low:low + (1 << 16)])], ["pair", "n"])


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bit arrays, a key sits where it met no other.

    Keys that collide at a level go to the next; the place of a key is the
    number of set bits before its own.
    """

    def __init__(self, keys: np.ndarray, load: float = 2.0):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, base = keys.astype(np.uint64), 0
        while len(rest):
            size = int(len(rest) * load) | 1
            place = self._place(rest, len(self.levels), size)
            met = np.bincount(place, minlength=size)
            bits = met == 1
            self.levels.append((bits, base + np.cumsum(bits) - bits))
            base += int(bits.sum())
            rest = rest[met[place] > 1]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (W.mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; -1 or another key's place for one that was not given."""
        out, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, before) in enumerate(self.levels):
            at = self._place(keys[rest].astype(np.uint64), level, len(bits))
            hit = bits[at]
            out[rest[hit]] = before[at[hit]]
            rest = rest[~hit]
        return out


class PairCounts(NamedTuple):
    """Corpus-wide counts by perfect hash; ``best``: the count is the highest of the pair's B id."""

    hash: PerfectHash
    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray

    def look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair (0 if it was not counted), and whether it is its B id's best."""
        if not len(self.keys):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        at = self.hash.places(pairs)
        same = (at >= 0) & (self.keys[at] == pairs)
        return np.where(same, self.counts[at], 0), same & self.best[at]


def _vector_batches(it: Iterator[pa.RecordBatch], perfect: PerfectHash, size: int, block: int) -> Iterator[pa.RecordBatch]:
    vector = np.zeros(size, np.int64)
    for b in it:
        np.add.at(vector, perfect.places(b.column("pair").to_numpy()), b.column("n").to_numpy())
    if vector.any():
        yield _blocks_of(vector, TaskContext.get().partitionId(), block)


def _blocks_of(vector: np.ndarray, node: int, block: int) -> pa.RecordBatch:
    parts = [vector[i:i + block].astype("<i8").tobytes() for i in range(0, len(vector), block)]
    return pa.RecordBatch.from_arrays([pa.array([node] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int64()),
                                       pa.array(parts, pa.binary())], ["node", "block", "counts"])


def _add_up(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), "<i8") for x in group["counts"])
    return pa.table({"node": group["node"][:1].cast(pa.int64()), "block": group["block"][:1],
                     "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def count_pairs(docs: DataFrame, a_path: str, b_path: str, cache_units: int = CACHE_UNITS, block: int = BLOCK) -> PairCounts:
    """First pass: exact corpus-wide counts of all linked pairs."""
    part = stored(docs.select("doc_id", "text").mapInArrow(
        lambda it: _pair_batches(it, a_path, b_path, cache_units), "pair long, n long"), "alignment-pairs")
    most = tokenizers(a_path, b_path).most_pairs()
    # at most ``most`` rows, whatever the corpus
    keys = part.select("pair").distinct().toPandas()["pair"].to_numpy(np.int64)
    if len(keys) > most:
        raise ValueError(f"{len(keys)} distinct pairs, but the vocabularies allow {most}")
    perfect = PerfectHash(keys)
    by_place = np.zeros(len(keys), np.int64)
    by_place[perfect.places(keys)] = keys
    size, nodes = len(keys), max(1, part.rdd.getNumPartitions())
    vectors = part.mapInArrow(lambda it: _vector_batches(it, perfect, size, block), "node long, block long, counts binary")
    while nodes > 1:
        nodes = -(-nodes // FAN)
        vectors = vectors.withColumn("node", F.floor(F.col("node") / FAN)).groupBy("node", "block").applyInArrow(
            _add_up, "node long, block long, counts binary")
    counts = np.zeros(size, np.int64)
    for r in vectors.select("block", "counts").collect():  # one vector of ``size`` counts
        counts[r.block * block:(r.block + 1) * block] += np.frombuffer(r.counts, "<i8")
    b_id = by_place & 0xFFFFFFFF
    highest = np.zeros(int(b_id.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, b_id, counts)
    return PairCounts(perfect, by_place, counts, counts == highest[b_id])


# second pass ------------------------------------------------------------------

def _score_batches(it: Iterator[pa.RecordBatch], a_path: str, b_path: str, counts: PairCounts, with_groups: bool,
                   cache_units: int) -> Iterator[pa.RecordBatch]:
    units = Units(tokenizers(a_path, b_path), cache_units)
    n_best = count_sum = np.zeros(0, np.int64)
    for doc, rows, first, has in _slices(it, units):
        d = units.data
        if len(n_best) < len(d.text):  # links of units that have come since
            new = d.n_links[len(n_best):]
            count, best = counts.look_up(d.pairs[len(d.pairs) - int(new.sum()):])
            cuts = np.concatenate([[0], np.cumsum(new)])
            sums, bests = (np.concatenate([[0], np.cumsum(x)])[cuts] for x in (count, best.astype(np.int64)))
            n_best, count_sum = np.append(n_best, np.diff(bests)), np.append(count_sum, np.diff(sums))

        def per_text(of_unit: np.ndarray) -> pa.Array:
            upto = np.concatenate([[0], np.cumsum(of_unit[rows])])[first]
            return pa.array(np.where(has, np.diff(upto), 0), pa.int64())
        text = [b";".join([d.text[r] for r in rows[x:y].tolist()]) if ok else b""
                for x, y, ok in zip(first.tolist(), first[1:].tolist(), has.tolist())]
        digest = [hashlib.sha256(x).hexdigest() if x else "" for x in text]
        columns = [doc, per_text(d.n_a), per_text(d.n_b), per_text(d.n_links), per_text(d.n_links), per_text(n_best),
                   per_text(count_sum), pa.array(digest, pa.string())]
        if with_groups:
            columns.append(pa.array(text, pa.binary()).cast(pa.string()))
        yield pa.RecordBatch.from_arrays(columns, COLUMNS + ["groups"] * with_groups)
        if units.full():
            units.clear()
            n_best, count_sum = n_best[:0], count_sum[:0]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def align_rows(docs: DataFrame, a_path: str, b_path: str, counts: PairCounts, with_groups: bool = False,
               cache_units: int = CACHE_UNITS) -> DataFrame:
    """Second pass: tokens, groups, links and their counts of each document; with ``with_groups`` also the groups' text."""
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in COLUMNS)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda it: _score_batches(it, a_path, b_path, counts, with_groups, cache_units), schema + ", groups string" * with_groups)


def pair_table(spark, counts: PairCounts) -> DataFrame:
    """a_id, b_id and n of every linked pair (as many as the vocabularies allow at most)."""
    columns = {"a_id": counts.keys >> 32, "b_id": counts.keys & 0xFFFFFFFF, "n": counts.counts}
    return spark.createDataFrame(pa.table(columns))
