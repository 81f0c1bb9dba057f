"""BPE rounds, cross-tokenizer alignment and collocations against the libraries and brute force, and on odd input."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brute_force import plain_alignment, plain_collocations

from martflow.llm import alignment, bpe, collocations, common, language_id, token_records, words
from martflow.llm.common import table

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, ids string, n string, f string, "
        "phrase string, shard string, g string, pair string, n_a string, row string, hash string")
LONG = " ".join(f"word{i % 977} Größe, so" for i in range(20_000))
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "!!! ..."), (5, LONG), (6, "The same text."), (6, "The same text."), (7, "The same text."),
        (None, "The same text."), (None, None), (8, "a"), (9, "日本語 テキスト 12"), (10, "x" * 50_000), (11, "a▁b"), (12, "<|endoftext|> a<|endoftext|>b"),
        (13, "a\x1cb \x1d\x1e\x1f c")]
ALPHABET = "ab '’s\x00\x1c\x1d\x1e\x1f\x85\xa0　 ́éÉßİıΣσς12²½三語́àA<|>\n\n\t\r  -_.,😀👍🏽‍﻿ªº▁"
WORDS = ["<|startoftext|>", "<|endoftext|>", "<|endoftext", "</s>", "<0x0A>", "'s", "don't", "the ", "\n ", "  "]


def frame(spark, rows, langs=("en",)):
    width = DOCS.count(",") + 1
    return spark.createDataFrame([(i, t, langs[k % len(langs)], "s", 0, *["clash"] * (width - 5)) for k, (i, t) in enumerate(rows)], DOCS)


def texts_of(seed, n, size=25):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) if rnd.random() < 0.85 else rnd.choice(WORDS) for _ in range(rnd.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def word_file():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(word_file):
    return Tokenizer.from_file(word_file)


def encoded(coder, texts):
    flat, upto = coder.encode(*words.buffer_of(pa.array(texts, pa.large_string())))
    return [flat[a:z].tolist() for a, z in zip(upto, upto[1:])]


# 12: BPE ------------------------------------------------------------------------

def test_rounds_equal_the_library(word_file, library):
    coder, texts = bpe.Bpe(word_file), texts_of(1, 3000)
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(coder, texts) == wanted
    assert [coder.decode(i).decode() for i in wanted] == library.decode_batch(wanted, skip_special_tokens=False)


def test_low_code_points_equal_the_library(word_file, library):
    low = [chr(c) for c in range(0x180)]
    texts = low + [f"a{c}b" for c in low] + [c + d for c in low[:0x21] for d in low]
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(bpe.Bpe(word_file), texts) == wanted
    assert encoded(token_records.WordEncoder(word_file), texts) == wanted


@pytest.mark.parametrize("long", [0, 3, 1024])
def test_long_words_by_rank_equal_rounds(word_file, library, monkeypatch, long):
    monkeypatch.setattr(bpe, "LONG", long)
    rnd = random.Random(long)
    texts = ["".join(rnd.choice("etaoinshrdlu") for _ in range(n)) for n in (1, 7, 300, 5000)] + ["-" * 3001, "a" * 999 + "b", "aaa aa a"]
    assert encoded(bpe.Bpe(word_file), texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_small_cache_gives_the_same_ids(word_file):
    texts = texts_of(2, 300)
    coder = bpe.Bpe(word_file, cache_words=5)
    assert [encoded(coder, texts[i:i + 3])[j] for i in range(0, 300, 3) for j in range(3)] == encoded(bpe.Bpe(word_file), texts)


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):
        bpe.Merges([(3, 2), (0, 1)], [4, 3])


def test_bpe_rows_on_edges(spark, word_file, library):
    docs = frame(spark, EDGE)
    found = bpe.digests(docs, word_file)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    def digest(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        return len(ids), *sha
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(i, *digest(t)) for i, t in EDGE], key=str)
    rows = bpe.encode_rows(docs, word_file)
    assert {(r.doc_id, len(r.ids)) for r in rows.collect()} == {(i, digest(t)[0]) for i, t in EDGE}
    assert {r.text for r in bpe.decode_rows(rows, word_file).where("doc_id = 6").collect()} == {"the</w> same</w> text</w> .</w>"}
    assert bpe.digests(docs.where("false"), word_file).isEmpty()


# 11: alignment ------------------------------------------------------------------

@pytest.fixture(scope="module")
def files():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both(files):
    return alignment.tokenizers(*files)


def plain(both, texts):
    return plain_alignment(both.whole, both.b, both.a_bytes, both.b_bytes, texts)


def test_units_equal_whole_texts(both):
    texts = texts_of(3, 3000) + [t.replace("▁", "x") for t in texts_of(4, 3000)]
    units, out = alignment.Units(both), []
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.large_string())], ["doc_id", "text"])
    for _, rows, first, has in alignment._slices(iter([batch]), units):
        d = units.data
        out += [(int(d.n_a[rows[x:y]].sum()), int(d.n_b[rows[x:y]].sum()), b";".join([d.text[r] for r in rows[x:y]]).decode())
                if ok else (0, 0, "") for x, y, ok in zip(first, first[1:], has)]
    assert out == [r[:3] for r in plain(both, texts)[0]]


def test_tiktoken_ranks_equal_the_library(both):
    texts = [c for k in range(0x3100) for c in (f"a{chr(k)}b", f" {chr(k)} .")]
    assert both.ranked.encode_ordinary_batch(texts) == [e.ids for e in both.whole.encode_batch(texts, add_special_tokens=False)]


def test_perfect_hash_is_minimal_and_verified():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 20_000))
    perfect = alignment.PerfectHash(keys)
    assert np.array_equal(np.sort(perfect.places(keys)), np.arange(len(keys)))
    by_place = np.zeros(len(keys), np.int64)
    by_place[perfect.places(keys)] = keys
    counts = alignment.PairCounts(perfect, by_place, by_place % 1000, by_place % 2 == 0)
    other = keys[:-1] + 1
    other = other[~np.isin(other, keys)]
    assert not counts.look_up(other)[0].any() and np.array_equal(counts.look_up(keys)[0], keys % 1000)


@pytest.mark.parametrize("limit", [2, 10_000])
def test_alignment_equals_brute_force(spark, files, both, monkeypatch, limit):
    monkeypatch.setattr(alignment, "FAN", 2)
    rows = EDGE + list(enumerate([t.replace("▁", "") for t in texts_of(5, 60)], 100)) + [(500, "The same text, the same word.")] * 9
    docs = frame(spark, rows).repartition(5)
    counts = alignment.count_pairs(docs, *files, cache_units=limit, block=7)  # a full cache starts anew
    found = alignment.align_rows(docs, *files, counts, with_groups=True, cache_units=limit)
    want, links = plain(both, [t for _, t in rows])
    best = {}
    for (_, b), n in links.items():
        best[b] = max(n, best.get(b, 0))
    expected = [(i, na, nb, len(ls), len(ls), sum(links[x] == best[x[1]] for x in ls), sum(links[x] for x in ls),
                 hashlib.sha256(g.encode()).hexdigest() if g else "", g) for (i, _), (na, nb, g, ls) in zip(rows, want)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert {((r.a_id, r.b_id), r.n) for r in alignment.pair_table(spark, counts).collect()} == set(links.items())
    assert len(links) <= both.most_pairs()


def test_alignment_of_an_empty_table(spark, files):
    docs = frame(spark, EDGE).where("false")
    counts = alignment.count_pairs(docs, *files)
    assert alignment.align_rows(docs, *files, counts).isEmpty() and len(counts.keys) == 0
    nothing = alignment.align_rows(frame(spark, [(1, None), (2, "")]), *files, counts).collect()
    assert [tuple(r) for r in nothing] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


# 13: collocations ---------------------------------------------------------------

@pytest.mark.parametrize("bits", [1 << 15, collocations.FILTER_BITS])
def test_collocations_equal_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(collocations, "FILTER_BITS", bits)
    monkeypatch.setattr(collocations, "CHUNK", 40)
    monkeypatch.setattr(collocations, "HELD", 20)
    rnd = random.Random(1)
    vocabulary = ["the", "The", "of", "new", "york", "Größe", "日本", "a-b", "x"]
    made = lambda: "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", "  ", "\t", " \t", ", ", ".", "\n", "; "]) for _ in range(rnd.randint(0, 60)))
    rows = [(i, made()) for i in range(80)] + [(900, "new york city. New  york\tcity")] * 30 + [(None, None), (1, ""), (2, " \t "), (3, "...")]
    docs = frame(spark, rows, ("en", None, "de", "und")).repartition(4)
    want = plain_collocations([(r.lang, r.text) for r in docs.collect()], 10, 25)
    got = collocations.collocations(docs, per_language=25)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(want) and {r[0] for r in want} == {"en", "de", "und"}


def test_collocations_on_edges(spark):
    docs = frame(spark, EDGE + [(20, "ab cd " * 5000)])
    want = plain_collocations([(r.lang, r.text) for r in docs.collect()], 10, 2000)
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == sorted(want)
    assert collocations.collocations(docs.where("false")).isEmpty()


# samples --------------------------------------------------------------------------

def test_samples_bound_rows_of_a_repeated_id(spark):
    rows = [(1, f"text {i}") for i in range(400)] + [(1, "again")] * 200 + [(2, "two"), (4, "four")]
    docs, labels = frame(spark, rows), spark.createDataFrame([(1, 1), (2, 0), (4, 1)], "doc_id long, toxic int")
    sample = common.labelled_sample(docs, labels, "toxic", 5, 4, 10)
    assert 0 < sample.count() <= 10
    assert sample.dropDuplicates(["doc_id", "text"]).count() == sample.count()
    few = common.bounded_rows(docs.select("doc_id", "text", "lang"), labels.selectExpr("doc_id", "'en' AS learned"), 7, "learned")
    assert few.count() == 7
    assert language_id.fit(docs, held=7, per_language=5) is not None


def test_token_records_of_one_hot_id(spark, scratch, word_file, library):
    rows = [(5, f"text {i % 40}") for i in range(400)] + [(5, "the same")] * 300 + [(None, "none")] * 20 + [(9, "last")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # this little would become one file
    folder, manifest = token_records.write(frame(spark, rows).repartition(4), word_file, scratch("records"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = token_records.read(spark, folder, manifest).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, tuple(r.ids)) for r in found) == sorted(
        (i is None, i or 0, (*library.encode(t, add_special_tokens=False).ids, 1)) for i, t in rows)
    starts = sorted((r.start, len(r.ids)) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert max(r.records for r in manifest.collect()) < 500  # no file takes the whole hot id


def test_script_narrows_the_candidate_languages():
    """A word is never labelled with a language that does not use its script, whatever its neighbours."""
    scores = np.array([[9.0, 0.0], [-np.inf, -50.0], [9.0, 0.0]], np.float32)
    assert language_id.viterbi(scores, np.array([3])).tolist() == [0, 1, 0]
    scores = np.array([[-np.inf, 1.0], [2.0, -np.inf], [-np.inf, 1.0]], np.float32)
    assert language_id.viterbi(scores, np.array([1, 2])).tolist() == [1, 0, 1]
