"""Language identification with labelled spans of mixed-language text.

The script of a word (its first code point's range) narrows the candidates to
the languages that use it.  A word's score for a candidate is the sum of the
log-probabilities of its byte 4-grams under a smoothed model of the language,
centred over languages.  Viterbi over the words, with a penalty for each
switch of language, labels every word; runs of one label are spans.  A
document's language is the one with most bytes of words, and its score is
that language's share of them (words of a script that no learned language
uses belong to none; words that begin with a digit don't count).

Fitting uses at most ``PER_LANGUAGE`` documents of each language outside the
held-out fold (a documented bound), taken in the order of an id hash.

Edge cases: null text or text without a letter is ``und`` with score 0, and so
is everything when there is nothing to learn from; a text only of unlearned
scripts takes the likeliest learned language with score 0; ties go to the
first language in order; texts of any length are labelled whole; repeated rows
get equal results; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martflow.llm import words as W
from martflow.llm.common import bounded_rows, crc32_of_id, hash_bound, stored

PER_LANGUAGE = 1_500
GRAM_BITS = 17
SMOOTHING = 0.5
SWITCH_PENALTY = 8.0
SCRIPT_SHARE = 0.01  # of a language's words, for it to be said to use a script
UNKNOWN = "und"
SLICE = 2 << 20  # bytes of text labelled at once

# First code points of script ranges (Unicode blocks), in order.
SCRIPT_STARTS = (
    (0x0000, "none"), (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7C0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_STARTS))
_starts = np.array([s for s, _ in SCRIPT_STARTS])
_script_of_range = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])


class Model(NamedTuple):
    languages: tuple[str, ...]
    grams: np.ndarray  # places x languages: centred log-probabilities
    uses: np.ndarray  # scripts x languages


def prepared(texts: pa.Array) -> pa.Array:
    """Lower-cased texts, each ended by a line break so that words and 4-grams stay within one."""
    lower = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    empty, line = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    return pc.binary_join_element_wise(lower, empty, line)


def scripts(raw: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Script number of the code point at each place."""
    size = len(raw)
    byte = [raw[np.minimum(start + k, size - 1)].astype(np.int64) for k in range(4)]
    tail = [b & 0x3F for b in byte]
    code = np.select(
        [byte[0] < 0x80, byte[0] < 0xE0, byte[0] < 0xF0],
        [byte[0], (byte[0] & 0x1F) << 6 | tail[1], (byte[0] & 0x0F) << 12 | tail[1] << 6 | tail[2]],
        (byte[0] & 0x07) << 18 | tail[1] << 12 | tail[2] << 6 | tail[3])
    return _script_of_range[np.searchsorted(_starts, code, "right") - 1]


def places(raw: np.ndarray, low: int, high: int) -> np.ndarray:
    """Table place of the 4-gram around each byte of raw[low:high]; bytes outside words are blanks."""
    a, z = max(0, low - 1), min(len(raw), high + 2)
    b = np.where(W.ALNUM[raw[a:z]], raw[a:z], 32).astype(np.uint32)
    b = np.concatenate([np.full(a - low + 1, 32, np.uint32), b, np.full(high + 2 - z, 32, np.uint32)])
    n = high - low
    after, later = b[2:2 + n], b[3:3 + n]
    later = np.where(after == 32, np.uint32(32), later)
    gram = b[:n] | b[1:1 + n] << np.uint32(8) | after << np.uint32(16) | later << np.uint32(24)
    return (gram * np.uint32(0x9E3779B1) >> np.uint32(32 - GRAM_BITS)).astype(np.int64)


def _blocks(w: W.Words) -> Iterator[tuple[int, int]]:
    """Runs of words that span about a megabyte."""
    k = 0
    while k < len(w.start):
        stop = max(k + 1, int(np.searchsorted(w.end, w.start[k] + W.BLOCK, "right")))
        yield k, stop
        k = stop


def word_scores(raw: np.ndarray, w: W.Words, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score of each word for each language, whether any learned language uses its script, and whether it has one."""
    scores = np.empty((len(w.start), len(model.languages)), np.float32)
    for k, stop in _blocks(w):
        low, high = int(w.start[k]), int(w.end[stop - 1])
        each = np.concatenate([model.grams[places(raw, low, high)], np.zeros((1, scores.shape[1]), np.float32)])
        edges = np.stack([w.start[k:stop] - low, w.end[k:stop] - low], axis=1).ravel()
        scores[k:stop] = np.add.reduceat(each, edges, axis=0)[::2]
    script = scripts(raw, w.start) if len(w.start) else np.zeros(0, np.int64)
    lettered = script != SCRIPTS.index("none")
    uses = model.uses[script]
    known = uses.any(axis=1) & lettered
    scores[known[:, None] & ~uses] = -np.inf  # only languages of the word's script are candidates
    return scores, known, lettered


def viterbi(scores: np.ndarray, count: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of every word; the texts of a batch advance together, one word a step."""
    label = np.zeros(len(scores), np.uint8)
    order = np.argsort(-count, kind="stable")
    first = (np.cumsum(count) - count)[order]
    count = count[order]
    steps = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(steps), "left")  # texts with more than t words
    value = np.zeros((len(count), scores.shape[1]), np.float64)
    came = np.zeros(len(scores), np.uint8)  # best label before this word
    switched = np.zeros(scores.shape, bool)
    for t in range(steps):
        n = active[t]
        at, v = first[:n] + t, value[:n]
        if t:
            best = v.argmax(axis=1)
            top = v[np.arange(n), best] - penalty
            better = top[:, None] > v
            came[at], switched[at] = best, better
            v = np.where(better, top[:, None], v)
        value[:n] = v + scores[at]
    state = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at, s = first[:n] + t, state[:n]
        label[at] = s
        if t:
            state[:n] = np.where(switched[at, s], came[at], s)
    return label


def label_words(texts: pa.Array, model: Model) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the prepared texts, their labels, whether their script is learned, and whether they have one."""
    raw, at = W.buffer_of(texts)
    w = W.words(raw, at, W.ALNUM, lower=False, hashed=False)
    scores, known, lettered = word_scores(raw, w, model)
    return w, viterbi(scores, W.counts(w, len(texts))), known, lettered


def classify(texts: pa.Array, model: Model | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    rows = len(texts)
    names, score = np.full(rows, UNKNOWN, object), np.zeros(rows)
    if model is None:
        return names.tolist(), score
    letters = pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
    for low, high in W.slices(texts, SLICE):
        n = high - low
        w, label, known, lettered = label_words(prepared(texts.slice(low, n)), model)
        size = (w.end - w.start).astype(np.float64) * lettered
        width = len(model.languages)
        total = np.bincount(w.doc, size, n)
        share = np.bincount(w.doc * width + label, size * known, n * width).reshape(n, width)
        likely = np.bincount(w.doc * width + label, size, n * width).reshape(n, width)
        best = np.where(share.max(axis=1) > 0, share.argmax(axis=1), likely.argmax(axis=1))
        has = letters[low:high].astype(bool)
        names[low:high] = np.where(has, np.array(model.languages, object)[best], UNKNOWN)
        score[low:high] = np.where(has, share[np.arange(n), best] / np.maximum(total, 1), 0)
    return names.tolist(), score


def spans(text: str, model: Model) -> list[tuple[int, int, str]]:
    """(first byte, end, language) of each run of equally labelled words of the lower-cased text."""
    w, label, _, _ = label_words(prepared(pa.array([text], pa.large_string())), model)
    if not len(label):
        return []
    edge = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
    last = np.append(edge[1:], len(label)) - 1
    return [(int(w.start[a]), int(w.end[z]), model.languages[label[a]]) for a, z in zip(edge, last)]


# fitting --------------------------------------------------------------------

def _count_batches(languages: tuple[str, ...]):
    number = {name: i for i, name in enumerate(languages)}
    rows = (1 << GRAM_BITS) + len(SCRIPTS)  # 4-gram counts, then words by script

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(rows * len(languages), np.int64)
        for b in it:
            lang = np.array([number[x] for x in b.column("lang").to_pylist()], np.int64)
            texts = b.column("text")
            for low, high in W.slices(texts, SLICE):
                raw, at = W.buffer_of(prepared(texts.slice(low, high - low)))
                w = W.words(raw, at, W.ALNUM, lower=False, hashed=False)
                if not len(w.start):
                    continue
                of = lang[low:high][w.doc]
                total += np.bincount(((1 << GRAM_BITS) + scripts(raw, w.start)) * len(languages) + of, minlength=len(total))
                for k, stop in _blocks(w):
                    start, end = int(w.start[k]), int(w.end[stop - 1])
                    size = w.end[k:stop] - w.start[k:stop]
                    inside = np.flatnonzero(W.ALNUM[raw[start:end]])
                    at_words = places(raw, start, end)[inside]
                    total += np.bincount(at_words * len(languages) + np.repeat(of[k:stop], size), minlength=len(total))
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], ["place", "n"])
    return batches


def fit(docs: DataFrame, folds: int = 3, held: int = 1, per_language: int = PER_LANGUAGE) -> Model | None:
    """Model from text and lang of documents outside the held-out fold; None if there are none."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                       & (F.pmod(crc32_of_id(), F.lit(folds)) != held))
    order = F.xxhash64("doc_id")
    # Twice the limit of ids is expected of each language below its bound: no task ranks more than that.
    rows = stored(known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("count")), "language-rows")
    few = known.select("doc_id", "lang").join(rows, "lang").where(order <= hash_bound(F.lit(per_language), F.col("count"))).select("doc_id", "lang").distinct()
    ids = few.withColumn("n", F.row_number().over(
        Window.partitionBy("lang").orderBy(order, "doc_id"))).where(F.col("n") <= per_language)
    ids = stored(ids.select("doc_id", F.col("lang").alias("learned")), "language-sample")
    languages = tuple(sorted(r.learned for r in ids.select("learned").distinct().collect()))
    if not languages:
        return None
    sample = bounded_rows(known.select("doc_id", "lang", "text"), ids, per_language, "learned").where("lang = learned")
    found = sample.select("lang", "text").mapInArrow(W.released(_count_batches(languages)), "place long, n long")
    total = found.groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(((1 << GRAM_BITS) + len(SCRIPTS)) * len(languages))
    counts[total.place.to_numpy(np.int64)] = total.n.to_numpy()
    counts = counts.reshape(-1, len(languages))
    grams, words = counts[:1 << GRAM_BITS], counts[1 << GRAM_BITS:]
    if not grams.any():
        return None
    seen = grams.any(axis=1)
    logs = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * max(1, seen.sum())))
    logs[~seen] = 0
    centred = (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)
    return Model(languages, centred, words >= SCRIPT_SHARE * np.maximum(1, words.sum(axis=0)))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every document, whole texts."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            lang, score = classify(b.column("text"), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(W.released(batches), "doc_id long, lang_pred string, score double")


def keep_languages(docs: DataFrame, model: Model | None, min_score: float = 0.4) -> DataFrame:
    """The documents with a language that makes up at least ``min_score`` of them, unchanged; one pass, no shuffle."""
    if model is None:  # nothing learned, nothing to reject by
        return docs
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            lang, score = classify(b.column("text"), model)
            yield b.filter(pa.array([x != UNKNOWN and s >= min_score for x, s in zip(lang, score)], pa.bool_()))
    return docs.mapInArrow(W.released(batches), docs.schema)
