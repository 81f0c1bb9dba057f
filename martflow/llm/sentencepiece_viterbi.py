"""SentencePiece encoding and decoding by Viterbi search in numpy.

A text is normalised as the model says (spaces become U+2581, one is put
before), then cut before every run of spaces: no piece of a model that splits
by white space reaches across.  The distinct parts of a batch are searched in
groups of equal length, which advance together: the hashes of all substrings
of one length are probed in the sorted keys of the pieces of that length, and
for every end place the best predecessor of all parts is one vectorised
maximum, kept as a backpointer.  A part above 4,096 code points is searched
alone in blocks, which keep the scores within reach of a piece and one byte for
each code point.  A task caches parts in a table of bounded
size and frees it when it ends, as a worker goes on to other operators.

The result is the segmentation with the largest sum of piece scores (of equal
sums, the one whose last piece is longest, and so on towards the start).  That
is what SentencePiece's unigram search returns for the same pieces and scores;
a model trained by merges (BPE) has the same pieces and decodes to the same
text, but its own encoder may cut a word elsewhere.  Code points without a
piece become byte pieces, so decoding gives back the exact text; U+2581 in a
text is a space afterwards, as in SentencePiece itself.

Edge cases: null or empty text has no ids and decodes to the empty text; white
space alone is kept; texts of any length are encoded whole, in parts; repeated
rows get equal ids; an empty table gives an empty result; extra columns are
ignored by ``encode_rows`` and kept by ``encode_documents``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm import words as W

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # below the smallest score, fixed by SentencePiece
CACHE_WORDS = 200_000
SLICE = 1 << 20  # bytes of text encoded at once
GROUP_CHARS = 1 << 15
LONG_PART = 1 << 12  # code points from which a part is searched alone, block by block
PREFIX = np.uint64(44)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
# Words end at a space only; other white space is part of them.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[32] = False


def _prefix_hashes(chars: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the first 0..L code points of each row."""
    out = np.zeros((len(chars), chars.shape[1] + 1), np.uint64)
    for i in range(chars.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + chars[:, i].astype(np.uint64) + np.uint64(1)
    return out


class Pieces:
    """Scores and sorted substring keys of a model's pieces."""

    def __init__(self, model_path: str, cache_words: int = CACHE_WORDS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = range(model.get_piece_size())
        text = [model.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.byte_ids = np.zeros(256, np.int64)
        self.out = [b""] * len(text)  # bytes that each id decodes to
        for i in ids:
            if model.is_byte(i):
                value = int(text[i][3:5], 16)
                self.byte_ids[value], self.out[i] = i, bytes([value])
        for i in plain:
            self.out[i] = text[i].replace(SPACE, " ").encode()
        scores = np.array([model.get_score(i) for i in ids], np.float64)
        self.unknown = scores[plain].min() - UNKNOWN_PENALTY
        self.keys, self.ids, self.scores = {}, {}, {}
        by_length: dict[int, list[int]] = {}
        for i in plain:
            by_length.setdefault(len(text[i]), []).append(i)
        for length, members in by_length.items():
            chars = np.array([[ord(c) for c in text[i]] for i in members], np.uint32)
            key, members = W.mix(_prefix_hashes(chars)[:, -1]), np.array(members)
            order = np.argsort(key)
            if len(np.unique(key)) != len(key):
                raise ValueError("two pieces share a key")
            self.keys[length], self.ids[length], self.scores[length] = key[order], members[order], scores[members[order]]
        self.longest = max(by_length)
        self.maybe = np.zeros(1 << 20, bool)  # leading bits of any key
        for key in self.keys.values():
            self.maybe[(key >> PREFIX).astype(np.int64)] = True
        self.cache = W.WordCache(cache_words)
        self.known: dict[str, bytes] = {}  # ids of parts, 32 bits each
        # Safe cuts: no piece has these two neighbours, so none reaches across.
        after_word = {b for i in plain for a, b in zip(text[i], text[i][1:]) if a.isalnum() and not b.isalnum()}
        cuts = [f"(?<=[^\\W_])(?=[^\\w{re.escape(SPACE + ''.join(sorted(after_word)))}])"]
        if not any("\n" in text[i] for i in plain):
            cuts += ["(?=\n)", "(?<=\n)"]
        self.cuts = re.compile("|".join(cuts))

    def _probe(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``hashes``, score, id) of every hash that is a key of a piece of ``length``."""
        place = np.flatnonzero(self.maybe[(hashes >> PREFIX).astype(np.int64)])  # most substrings end here
        keys = self.keys[length]
        at = np.minimum(np.searchsorted(keys, hashes[place]), len(keys) - 1)
        hit = keys[at] == hashes[place]
        return place[hit], self.scores[length][at[hit]], self.ids[length][at[hit]]

    def viterbi(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of rows of equally many code points, row after row, and their number in each.

        An unknown code point has the id -1 - code point.
        """
        rows, length = chars.shape
        reach = min(self.longest, length)
        prefix = _prefix_hashes(chars)
        # score and id of the piece that ends at j and has k code points, longest first
        score = np.full((rows, length + 1, reach), -np.inf)
        piece = np.full((rows, length + 1, reach), -1, np.int32)
        for k in range(1, reach + 1):
            power = np.uint64(pow(int(_BASE), k, 1 << 64))
            if k in self.keys:
                spans = W.mix(prefix[:, k:] - prefix[:, :length + 1 - k] * power)
                at, value, found = self._probe(spans.ravel(), k)
                row, end = np.divmod(at, spans.shape[1])
                score[row, end + k, reach - k], piece[row, end + k, reach - k] = value, found
        single, unknown = score[:, 1:, reach - 1], piece[:, 1:, reach - 1] < 0
        single[unknown] = self.unknown
        piece[:, 1:, reach - 1][unknown] = -1 - chars[unknown].astype(np.int32)
        best = np.full((rows, length + 1 + reach), -np.inf)  # shifted by reach: no place before the start
        best[:, reach] = 0
        back = np.zeros((rows, length + 1), np.int64)
        every = np.arange(rows)
        for j in range(1, length + 1):
            total = best[:, j:j + reach] + score[:, j]
            back[:, j] = choice = total.argmax(axis=1)
            best[:, reach + j] = total[every, choice]
        used = np.zeros((rows, length + 1), bool)
        place = np.full(rows, length)
        active = every
        while len(active):
            used[active, place[active]] = True
            place[active] -= reach - back[active, place[active]]
            active = active[place[active] > 0]
        r, j = np.nonzero(used)
        return piece[r, j, back[r, j]], used.sum(axis=1)

    def viterbi_long(self, chars: np.ndarray, block: int = GROUP_CHARS) -> np.ndarray:
        """The same for one long row: scores of the last places only, one byte for each backpointer."""
        n = len(chars)
        reach = min(self.longest, n)
        back = np.zeros(n + 1, np.uint8)  # code points of the best last piece that ends here
        tail = [0.0]  # best sums of the places up to ``low``, as many as a piece can reach
        for low in range(0, n, block):
            high = min(n, low + block)
            base = max(0, low + 1 - reach)
            near = chars[base:high].astype(np.uint64) + np.uint64(1)
            hashes = np.zeros(len(near) + 1, np.uint64)
            ends, sizes, values = [], [], []
            for k in range(1, reach + 1):
                hashes = hashes[:-1] * _BASE + near[k - 1:]  # of the k code points from each place on
                if k in self.keys:
                    at, value, _ = self._probe(W.mix(hashes), k)
                    end = at + base + k
                    new = end > low
                    end, value = end[new], value[new]
                else:
                    end, value = np.zeros(0, np.int64), np.zeros(0)
                if k == 1:
                    unknown = np.setdiff1d(np.arange(low + 1, high + 1), end)
                    end, value = np.concatenate([end, unknown]), np.concatenate([value, np.full(len(unknown), self.unknown)])
                ends.append(end)
                sizes.append(np.full(len(end), k))
                values.append(value)
            ends, sizes, values = (np.concatenate(x) for x in (ends, sizes, values))
            order = np.lexsort((-sizes, ends))  # longest first: it wins ties
            first = np.searchsorted(ends[order], np.arange(low + 1, high + 2)).tolist()
            sizes, values = sizes[order].tolist(), values[order].tolist()
            best, chosen = tail, []
            for a, z in zip(first, first[1:]):
                top, size = -np.inf, 1
                for i in range(a, z):
                    total = best[-sizes[i]] + values[i]
                    if total > top:
                        top, size = total, sizes[i]
                best.append(top)
                chosen.append(size)
            back[low + 1:high + 1] = chosen
            tail = best[-reach:]
        steps, cut, j = back.tobytes(), np.zeros(n + 1, bool), n
        while j:
            cut[j] = True
            j -= steps[j]
        found = []
        for low in range(0, n, block):
            end = np.flatnonzero(cut[low + 1:low + 1 + block]) + low + 1
            size = back[end].astype(np.int64)
            ids = -1 - chars[end - 1].astype(np.int64)  # unknown, unless found below
            for k in np.unique(size).tolist():
                if k in self.keys:
                    rows = np.flatnonzero(size == k)
                    spans = chars[(end[rows] - k)[:, None] + np.arange(k)]
                    at, _, known = self._probe(W.mix(_prefix_hashes(spans)[:, -1]), k)
                    ids[rows[at]] = known
            found.append(ids.astype(np.int32))
        return np.concatenate(found)

    def _search(self, parts: list[str]) -> None:
        """Put the ids of distinct parts into ``known``; parts of equal length advance together."""
        by_length: dict[int, list[str]] = {}
        for part in parts:
            by_length.setdefault(len(part), []).append(part)
        for length, members in by_length.items():
            step = 1 if length > LONG_PART else max(1, GROUP_CHARS // length)
            for low in range(0, len(members), step):
                group = members[low:low + step]
                chars = np.frombuffer("".join(group).encode("utf-32-le"), np.uint32).reshape(len(group), length)
                if length > LONG_PART:
                    ids = self.viterbi_long(chars[0])
                    sizes = np.array([len(ids)])
                else:
                    ids, sizes = self.viterbi(chars)
                ends, ids = np.cumsum(sizes).tolist(), ids.astype(np.int32)
                known = (ids < 0).cumsum()
                for part, a, z in zip(group, [0, *ends], ends):
                    if known[z - 1] > (known[a - 1] if a else 0):
                        self.known[part] = np.array(self._with_bytes(ids[a:z].tolist()), np.int32).tobytes()
                    else:
                        self.known[part] = ids[a:z].tobytes()

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in one array, and the number of ids of each."""
        if len(self.known) > self.cache.limit:
            self.known.clear()
        cut = [self.cuts.split(p) for p in parts]
        self._search(list({x for c in cut for x in c if x and x not in self.known}))
        found = [b"".join([self.known[x] for x in c if x]) for c in cut]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.int32).astype(np.int64), sizes

    def _with_bytes(self, ids: list[int]) -> list[int]:
        out: list[int] = []
        for i in ids:
            out += [i] if i >= 0 else self.byte_ids[list(chr(-1 - i).encode())].tolist()
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text."""
        raw, at = W.buffer_of(texts)
        rows = len(at) - 1
        w = W.words(raw, at, NOT_BLANK, lower=False)
        # Blanks before each word of a text (one more before the first), and after the last.
        first = np.searchsorted(w.start, at)
        before = np.empty(len(w.start), np.int64)
        before[1:] = w.start[1:] - w.end[:-1]
        heads = first[:-1][first[:-1] < first[1:]]
        before[heads] = w.start[heads] - at[:-1][w.doc[heads]] + 1
        last = first[1:] - 1
        has = first[1:] > first[:-1]
        size = np.diff(at)
        after = np.where(size > 0, size + 1, 0)  # a text of blanks only
        after[has] = at[1:][has] - w.end[last[has]]
        trailing = np.flatnonzero(after)
        # one sequence of parts: words with their blanks, and trailing blanks, in order of text
        hashes = np.concatenate([W.mix(w.hash + before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                                 W.mix(after[trailing].astype(np.uint64) + np.uint64(0xA5A5A5A5A5A5A5A5))])
        text_of = np.concatenate([w.doc, trailing])
        order = np.argsort(text_of, kind="stable")
        view = memoryview(raw)

        start, end = (np.concatenate([x, np.zeros(len(trailing), np.int64)]) for x in (w.start, w.end))
        blanks = np.concatenate([before, after[trailing]])

        def encode_new(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = order[places]
            return self.encode_parts([SPACE * n + str(view[a:z], "utf-8")
                                      for n, a, z in zip(blanks[at].tolist(), start[at].tolist(), end[at].tolist())])

        flat, ends = self.cache.encode(hashes[order], encode_new)
        cut = np.concatenate([[0], ends])[np.searchsorted(text_of[order], np.arange(rows + 1))]
        return [flat[a:z] for a, z in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def forget(self) -> None:
        """Free the cached parts."""
        self.cache.clear()
        self.known.clear()

    def decode(self, ids) -> str:
        """Text of one sequence of ids."""
        data = b"".join([self.out[i] for i in ids])
        return str(data[1:] if data[:1] == b" " else data, "utf-8", "replace")


_loaded: dict[str, Pieces] = {}


def pieces(model_path: str) -> Pieces:
    if model_path not in _loaded:
        _loaded[model_path] = Pieces(model_path)
    return _loaded[model_path]


def _encode_batches(it: Iterator[pa.RecordBatch], model_path: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    p = pieces(model_path)
    try:
        for b in it:
            text = b.column("__text")
            for low, high in W.slices(text, SLICE):
                part = text.slice(low, high - low)
                ids = p.encode(part)
                same = [p.decode(i.tolist()) == (t or "").replace(SPACE, " ") for i, t in zip(ids, part.to_pylist())]
                at = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(low, high - low) for c in columns), lists,
                                                  pa.array(np.diff(at), pa.int64()), pa.array(same)],
                                                 [*columns, "ids", "n_ids", "round_trip"])
    finally:
        p.forget()


def _decode_batches(it: Iterator[pa.RecordBatch], model_path: str) -> Iterator[pa.RecordBatch]:
    p = pieces(model_path)
    for b in it:
        texts = [p.decode(i or []) for i in b.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def _encoded(docs: DataFrame, model_path: str, columns: list[str]) -> DataFrame:
    source = docs.select(*columns, F.col("text").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*columns).schema.fields)
    return source.mapInArrow(W.released(lambda it: _encode_batches(it, model_path, columns)),
                             f"{schema}, ids array<int>, n_ids long, round_trip boolean")


def encode_rows(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, n_ids and round_trip (the ids decode to the text) of every document."""
    return _encoded(docs, model_path, ["doc_id"])


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """The documents' columns and their ids; clashing columns of the documents are replaced."""
    kept = [c for c in docs.columns if c not in ("ids", "n_ids", "round_trip")]
    return _encoded(docs, model_path, kept)


def decode_rows(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of encoded rows (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _decode_batches(it, model_path), "doc_id long, text string")
