"""BPE encoding and decoding: merge rounds over many words at once in numpy.

A tokenizer file names its merges in order.  Pairs of neighbouring symbols are
keyed as one 64-bit number; all keys are sorted once, so the rank of a pair is
one binary search.  The symbols of all new words of a batch lie in one flat
array.  A round takes the lowest-ranked pair of every word, merges all its
occurrences from the left, closes the gaps and probes only the pairs that have
changed; words without a known pair leave the array.  Rounds are as many as the
longest word needs, whatever the number of words.  Words above ``LONG`` symbols
(text without a space) are merged rank by rank over a linked list, so their
cost stays in proportion to their length.

Merging all occurrences of the lowest rank at once equals merging them one by
one if no merge yields a symbol that an earlier merge takes; this is checked
when a file is loaded.

What stands before the merges follows the tokenizer file: special tokens are
cut out of the text, the rest is normalised and split into pieces by the
library's normaliser and pre-tokenizer, once for every distinct word between
ASCII white space (no rule of such a file reaches across it; this is checked
too).  Words are cached in a table of bounded size.  Decoding joins
the tokens as the file's decoder says (without one: by single spaces).

Edge cases: null or empty text has no ids and decodes to the empty text; white
space alone has no ids; texts and words of any length are encoded whole;
repeated rows get equal ids; an empty table gives an empty result; null ids
stay; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm import words as W

NO_PAIR = np.int64(1 << 40)  # rank of a pair that is not merged
LONG = 1024  # symbols of a word that is merged by rank order
CACHE_WORDS = 600_000
SLICE = 1 << 20  # bytes of text encoded at once
JOIN = 512  # words split by one call of the library
_BLANK = re.compile(r"\s")


class Merges:
    """Ranks and results of all merges, found by binary search over sorted pair keys."""

    def __init__(self, pairs: list[tuple[int, int]], results: list[int]):
        left, right = np.array(pairs, np.int64).reshape(-1, 2).T
        key, made = left << 32 | right, np.array(results, np.int64)
        born = np.full(int(max(left.max(initial=0), right.max(initial=0), made.max(initial=0))) + 1, -1, np.int64)
        born[made] = np.arange(len(made))
        rank = np.arange(len(made))
        if len(np.unique(made)) != len(made) or (born[left] >= rank).any() or (born[right] >= rank).any():
            raise ValueError("a merge takes a symbol that a later merge makes")
        order = np.argsort(key)
        self.keys, self.rank, self.made = key[order], rank[order], made[order]

    def probe(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NO_PAIR`` if there is none) and result of each pair."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NO_PAIR), self.made[at]

    def rounds(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of words that lie one after the other, and their number in each word."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        long = (sizes > LONG)[word]
        parts = [self._by_round(symbols[~long], word[~long])]
        if long.any():
            parts.append(self._by_rank(symbols[long], word[long]))
        merged, of = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(of, kind="stable")
        return merged[order], np.bincount(of, minlength=len(sizes))

    def _pairs(self, s: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the pairs that begin at the places ``at``."""
        after = np.minimum(at + 1, len(s) - 1)
        rank, made = self.probe(s[at], s[after])
        rank[(after == at) | (word[after] != word[at])] = NO_PAIR
        return rank, made

    def _by_round(self, s: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done_s, done_w = [s[:0]], [word[:0]]
        rank, made = self._pairs(s, word, np.arange(len(s)))
        while len(s):
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, head), np.diff(np.append(head, len(s))))
            go = least < NO_PAIR
            if not go.all():  # words without a pair left are done
                done_s.append(s[~go])
                done_w.append(word[~go])
                s, word, rank, made, least = s[go], word[go], rank[go], made[go], least[go]
                if not len(s):
                    break
            at = np.flatnonzero(rank == least)
            at = at[_alternate(at[1:] == at[:-1] + 1)]  # of a run of equal symbols every second pair, from the left
            s[at] = made[at]
            keep = np.ones(len(s), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            s, word, rank, made = s[keep], word[keep], rank[keep], made[keep]
            at = place[at]
            changed = np.zeros(len(s), bool)
            changed[at] = changed[at[at > 0] - 1] = True
            near = np.flatnonzero(changed)
            rank[near], made[near] = self._pairs(s, word, near)
        return np.concatenate(done_s), np.concatenate(done_w)

    def _by_rank(self, s: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same merges in ascending rank over a linked list; every symbol is touched a few times only."""
        n = len(s)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[np.append(word[1:] != word[:-1], True)] = n
        before[np.append(True, word[1:] != word[:-1])] = n
        s, alive = np.append(s, -1), np.ones(n, bool)
        after, before = np.append(after, n), np.append(before, n)  # place n: nothing
        rank = np.full(n + 1, NO_PAIR)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(at: np.ndarray) -> None:
            r, _ = self.probe(s[at], s[after[at]])
            r[after[at] == n] = NO_PAIR
            rank[at] = r
            at, r = at[r < NO_PAIR], r[r < NO_PAIR]
            order = np.argsort(r, kind="stable")
            cuts = np.flatnonzero(np.diff(r[order])) + 1
            for group in np.split(at[order], cuts) if len(at) else ():
                value = int(rank[group[0]])
                if value not in waiting:
                    heapq.heappush(heap, value)
                waiting.setdefault(value, []).append(group)

        wait(np.arange(n))
        by_rank = np.argsort(self.rank)
        while heap:
            value = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(value)))
            at = at[alive[at] & (rank[at] == value)]
            if not len(at):
                continue
            at = at[_alternate(after[at[:-1]] == at[1:])]
            right = after[at]
            s[at], alive[right], after[at] = self.made[by_rank[value]], False, after[right]
            follower = after[at]
            before[follower[follower < n]] = at[follower < n]
            left = before[at]
            wait(np.unique(np.concatenate([at, left[left < n]])))
        return s[:n][alive], word[alive]


def _alternate(chained: np.ndarray) -> np.ndarray:
    """First, third, fifth ... member of every run; ``chained``: whether a member follows in its predecessor's run."""
    head = np.concatenate([[True], ~chained])
    first = np.flatnonzero(head)
    return (np.arange(len(head)) - np.repeat(first, np.diff(np.append(first, len(head))))) % 2 == 0


def byte_alphabet() -> list[str]:
    """Character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class Bpe:
    """Encoder and decoder of a byte-level BPE tokenizer file."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        plain = ("unk_token", "dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(k) for k in plain) or any(
                t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added) or spec.get("decoder"):
            raise ValueError("a rule of this tokenizer file is not known")
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # A suffix marks the last symbol of a word, so it stands on the right part of a merge alone.
        self.merges = Merges([(vocabulary[a], vocabulary[b]) for a, b in pairs], [vocabulary[a + b] for a, b in pairs])
        self.inner, self.last = np.zeros(0x200, np.int64), np.zeros(0x200, np.int64)
        for c in byte_alphabet():
            self.inner[ord(c)], self.last[ord(c)] = vocabulary[c], vocabulary[c + suffix]
        self.specials = {t["content"]: t["id"] for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if added else None
        tokens = vocabulary | self.specials
        self.tokens = [b""] * (max(tokens.values()) + 1)
        for t, i in tokens.items():
            self.tokens[i] = t.encode()
        self.decimal = [str(i).encode() for i in range(len(self.tokens))]
        probe = "á ́b ' s \n 1 2"
        if [p for p, _ in self.split(self.normalise(probe))] != [
                p for w in probe.split() for p, _ in self.split(self.normalise(w))]:
            raise ValueError("a rule of this tokenizer file reaches across white space")
        self.cache = W.WordCache(cache_words)

    # words -> pieces -> ids ---------------------------------------------------

    def _pieces(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """Pieces of words without white space and special tokens, and the word of each; many words go to the library at a time."""
        pieces, owners = [], [np.zeros(0, np.int64)]
        for low in range(0, len(words), JOIN):
            group = words[low:low + JOIN]
            text = self.normalise(" ".join(group))
            starts = np.flatnonzero(np.frombuffer((" " + text).encode("utf-32-le"), np.uint32) == 32)
            if len(starts) != len(group):
                raise ValueError("normalising a word has made white space")
            found = self.split(text)
            pieces += [piece for piece, _ in found]
            owners.append(low + np.searchsorted(starts, [at[0] for _, at in found], "right") - 1)
        return pieces, np.concatenate(owners)

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, and their number in each; each distinct piece is merged once."""
        index: dict[str, int] = {}
        which = np.array([index.setdefault(x, len(index)) for x in pieces], np.int64)
        sizes = np.fromiter(map(len, index), np.int64, len(index))
        code = np.frombuffer("".join(index).encode("utf-32-le"), np.uint32)
        symbols, end = self.inner[code], np.cumsum(sizes) - 1
        symbols[end] = self.last[code[end]]
        ids, sizes = self.merges.rounds(symbols, sizes)
        first, sizes = (np.cumsum(sizes) - sizes)[which], sizes[which]
        ends = np.cumsum(sizes)
        return ids[np.repeat(first - (ends - sizes), sizes) + np.arange(int(sizes.sum()))], sizes

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and their number in each; special tokens inside are cut out first."""
        odd = [k for k, x in enumerate(words) if "<" in x or _BLANK.search(x)]
        plain = sorted(set(range(len(words))).difference(odd)) if odd else range(len(words))
        pieces, owner = self._pieces([words[k] for k in plain] if odd else words)
        owners = [np.array(plain, np.int64)[owner]]
        singles: dict[int, int] = {}  # number of a piece that stands for a special token
        for k in odd:
            before = len(pieces)
            for i, part in enumerate(self.cut.split(words[k]) if self.cut else [words[k]]):
                if i % 2:
                    singles[len(pieces)] = self.specials[part]
                    pieces.append("!")
                elif part:
                    pieces += [piece for piece, _ in self.split(self.normalise(part))]
            owners.append(np.full(len(pieces) - before, k))
        ids, sizes = self._merged(pieces)
        first = np.cumsum(sizes) - sizes
        for k, special in singles.items():
            ids[first[k]] = special
        owner = np.repeat(np.concatenate(owners), sizes)
        return ids[np.argsort(owner, kind="stable")] if odd else ids, np.bincount(owner, minlength=len(words))

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the offsets of each text in it."""
        w = W.words(raw, at, W.NON_SPACE, lower=False)
        view = memoryview(raw)
        flat, ends = self.cache.encode(w.hash, lambda new: self.encode_words(
            [str(view[a:b], "utf-8") for a, b in zip(w.start[new].tolist(), w.end[new].tolist())]))
        return flat, np.concatenate([[0], ends])[np.searchsorted(w.start, at)]

    def decode(self, ids) -> bytes:
        """UTF-8 text of one sequence of ids, special tokens included."""
        tokens = self.tokens
        return b" ".join([tokens[i] for i in ids])

    def forget(self) -> None:
        """Free the cached words."""
        self.cache.clear()


_loaded: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def _encoded_slices(it: Iterator[pa.RecordBatch], coder: Bpe) -> Iterator[tuple[pa.Array, list[list[int]]]]:
    """doc_id and ids of each text, about a megabyte of text at a time."""
    for b in it:
        text, doc = b.column("text"), b.column("doc_id")
        for low, high in W.slices(text, SLICE):
            flat, upto = coder.encode(*W.buffer_of(text.slice(low, high - low)))
            flat, upto = flat.tolist(), upto.tolist()
            yield doc.slice(low, high - low), [flat[a:z] for a, z in zip(upto, upto[1:])]


def _encode_batches(it: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = bpe(path)
    try:
        for doc, ids in _encoded_slices(it, coder):
            yield pa.RecordBatch.from_arrays([doc, pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    finally:
        coder.forget()


def _decode_batches(it: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = bpe(path)
    for b in it:
        texts = [coder.decode(i.as_py() or ()) for i in b.column("ids")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])


def _digest_batches(it: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = bpe(path)
    decimal, sha = coder.decimal, hashlib.sha256
    try:
        for doc, ids in _encoded_slices(it, coder):
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(map(len, ids), pa.int64()),
                 pa.array([sha(b" ".join([decimal[i] for i in x])).hexdigest() for x in ids], pa.string()),
                 pa.array([sha(coder.decode(x)).hexdigest() for x in ids], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    finally:
        coder.forget()


def encode_rows(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every whole text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda it: _encode_batches(it, path), "doc_id long, ids array<int>")


def decode_rows(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of encoded rows (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _decode_batches(it, path), "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, number of ids, and sha256 of the ids (decimal, space-joined) and of the text that they decode to."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda it: _digest_batches(it, path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
