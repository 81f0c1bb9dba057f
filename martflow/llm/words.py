"""Vectorised word spans and 64-bit word hashes over a batch of texts.

A batch is an Arrow string column: one byte buffer plus offsets, so no Python
string per word is made.  The per-byte work runs in blocks of about a megabyte
that end outside words, so its memory does not depend on the length of a text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

# ASCII upper case to lower case; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes that belong to words: all but ASCII white space, or letters and digits
# of ASCII plus every byte of a longer code point.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


class Words(NamedTuple):
    """Words of a batch in order: byte span, text number, hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(at):
        at = np.zeros(1, np.int64)
    return raw[at[0]:at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer text has its own range."""
    _, at = buffer_of(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield row, min(stop, rows)
        row = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i in 0..n."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, BLOCK + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base & _MASK, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def words(raw: np.ndarray, at: np.ndarray, table: np.ndarray = NON_SPACE, lower: bool = True,
          hashed: bool = True) -> Words:
    """All words (maximal runs of ``table`` bytes within a text) with their hashes.

    Texts without a word give none.  Equal byte strings (after ASCII lower
    case if ``lower``) have equal hashes wherever they stand.
    """
    starts, ends, hashes = [], [], []
    n, low = len(raw), 0
    breaks = at[1:-1]
    while low < n:
        high = min(n, low + BLOCK)
        if high < n:  # end the block outside words; a longer word lengthens the block
            while True:
                free = np.flatnonzero(~table[raw[low:high]])
                if len(free):
                    high = low + int(free[-1]) + 1
                    break
                if high == n:
                    break
                high = min(n, high + BLOCK)
        block = raw[low:high]
        inside = table[block]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = breaks[np.searchsorted(breaks, low, "right"):np.searchsorted(breaks, high, "left")] - low
        cut = cut[(cut > 0) & (cut < len(block))]
        first[cut] |= inside[cut]
        last[cut - 1] |= inside[cut - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        starts.append(s + low)
        ends.append(e + low)
        if hashed:
            up, down = _power(len(block))
            values = (LOWER[block] if lower else block).astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(values * up[:len(block)], out=sums[1:])
            hashes.append(mix((sums[e] - sums[s]) * down[s]))
        low = high
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    doc = np.searchsorted(at, start, "right") - 1
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Words(start, end, doc, h)


def counts(w: Words, rows: int) -> np.ndarray:
    """Number of words of each text."""
    return np.bincount(w.doc, minlength=rows)[:rows] if len(w.doc) else np.zeros(rows, np.int64)


def combine(w: Words, *gaps: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of word tuples (each word with those ``gaps`` places on) and their text numbers."""
    reach = max(gaps)
    n = len(w.hash) - reach
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = w.hash[:n] * np.uint64(3)
    for k, gap in enumerate(gaps):
        h = mix(h + w.hash[gap:gap + n] * np.uint64(2 * k + 5) + np.uint64(gap))
    same = w.doc[:n] == w.doc[reach:]
    return h[same], w.doc[:n][same]


def released(batches):
    """``batches`` for mapInArrow; when a task ends, unused memory goes back to the system, as workers live on."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from batches(it)
        finally:
            _powers.clear()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)
    return run


class WordCache:
    """Token ids of words by word hash, for at most ``limit`` words (or sixteen times as many ids); then it starts anew."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.row = np.zeros(0, np.int64)  # their rows in the table below
        self.at = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, hashes: np.ndarray, encode_new) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the end of each word in it.

        ``encode_new`` gets places of new words in ``hashes`` and returns their
        ids in one array and the number of ids of each.
        """
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        seen = place < len(self.known)
        seen[seen] = self.known[place[seen]] == distinct[seen]
        if not seen.all():
            if len(self.known) + len(distinct) > self.limit or len(self.ids) > 16 * self.limit:
                self.clear()
                seen = np.zeros(len(distinct), bool)
            flat, sizes = encode_new(first[~seen])
            rows = len(self.at) - 1 + np.arange(len(sizes))
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, flat.astype(np.uint32)])
            known, row = np.concatenate([self.known, distinct[~seen]]), np.concatenate([self.row, rows])
            order = np.argsort(known)
            self.known, self.row = known[order], row[order]
            place = np.searchsorted(self.known, distinct)
        row = self.row[place][which]
        size = self.at[row + 1] - self.at[row]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.at[row] - (ends - size), size) + np.arange(total)], ends
