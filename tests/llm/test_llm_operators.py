"""Every operator against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import itertools
import json
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from brute_force import plain_best, plain_call_ranks, plain_capacity, plain_components, plain_contamination, plain_fingerprint

from martflow.llm import (decontaminate, language_id, near_dedup, quality, queries, sentencepiece_viterbi, sharding,
                          simhash, token_records, tool_calls, toxicity, words)
from martflow.llm.common import stored, table

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "score string, ids string, fp string, h string, shard string, row string, w string, part string, y string")
LONG = " ".join(f"word{i % 977} Größe" for i in range(30_000))
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "!!! ..."), (5, LONG), (6, "The same text."), (6, "The same text."),
        (7, "The same text."), (None, "The same text."), (None, None), (8, "a"), (9, "日本語 テキスト 12"), (10, "x" * 5000)]


def frame(spark, rows, schema=DOCS):
    width = schema.count(",") + 1
    return spark.createDataFrame([(i, t, "en", "s", 0, *["clash"] * (width - 5)) for i, t in rows], schema)


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, EDGE).where("false")


@pytest.fixture(scope="module")
def sample(spark):
    """Whole sf0.001 documents as (doc_id, text)."""
    return sorted((r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect())


def array(texts):
    return pa.array(texts, pa.large_string())


# words ------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 é\n日-", max_size=30)), max_size=8))
def test_words_match_a_regular_expression(texts):
    raw, at = words.buffer_of(array(texts))
    for lookup, pattern in ((words.NON_SPACE, rb"[^\x20\x09-\x0D]+"), (words.ALNUM, rb"[0-9A-Za-z\x80-\xff]+")):
        found = words.words(raw, at, lookup)
        wanted = [(i, m) for i, t in enumerate(texts) for m in re.findall(pattern, (t or "").encode())]
        assert [(int(d), raw[a:b].tobytes()) for d, a, b in zip(found.doc, found.start, found.end)] == wanted
        by_text = {}
        for (_, m), h in zip(wanted, found.hash.tolist()):
            assert by_text.setdefault(m.lower(), h) == h
        assert len(set(by_text.values())) == len(by_text)


def test_words_across_blocks(monkeypatch):
    texts = ["one two " * 40, "y" * 300, "", "three"]
    raw, at = words.buffer_of(array(texts))
    whole = words.words(raw, at)
    monkeypatch.setattr(words, "BLOCK", 64)
    small = words.words(raw, at)
    assert all((a == b).all() for a, b in zip(whole, small))


# 1: token records ---------------------------------------------------------------

def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_word_encoder_equals_the_tokenizer(sample):
    enc, whole = token_records.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), cache_words=2000), tokenizer()
    texts = [t for _, t in sample] + ["I'll DON'T we've", "Σας ΣΑΣ ǅ İstanbul ſ", "<|endoftext|> a<|endoftext|>b", "é ü ﬁ ½ ⅷ 一二",
                                      "a_b__c 12 3.5%", "x y z", "", "ÀÉ×÷ŉ"]
    for low, high in words.slices(array(texts), 1 << 16):
        part = texts[low:high]
        flat, upto = enc.encode(*words.buffer_of(array(part)))
        for t, a, b in zip(part, upto, upto[1:]):
            assert flat[a:b].tolist() == whole.encode(t, add_special_tokens=False).ids


def test_token_records_round_trip(spark, edge, empty, scratch):
    path, whole = public_tokenizers.path("word_bpe_49k.json"), tokenizer()
    folder, manifest = token_records.write(edge, path)
    ordered = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    wanted, start = [], 0
    for i, t in ordered:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        wanted.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    rows = [tuple(r) for r in token_records.digests(folder, manifest).collect()]
    assert sorted(map(repr, ((r[0], r[2], r[3]) for r in rows))) == sorted(map(repr, wanted))
    by_start = sorted(rows, key=lambda r: r[1])
    assert [r[1] for r in by_start] == list(itertools.accumulate([0, *(r[2] for r in by_start[:-1])]))
    assert [r[0] for r in by_start] == [r[0] for r in ordered]
    read = {(r.doc_id, r.start): list(r.ids) for r in token_records.read(spark, folder, manifest).collect()}
    shuffled = [((r.doc_id, r.start), list(r.ids)) for r in token_records.read(spark, folder, manifest, shuffle_seed=3).collect()]
    assert dict(shuffled) == read and len(shuffled) == len(EDGE)
    assert token_records.digests(*token_records.write(empty, path)).count() == 0


def test_broken_records_are_found():
    good = token_records.frame(b"payload")
    for at in (0, 9, 13, len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        stream = iter([bytes(bad)])
        import io
        with pytest.raises(token_records.CorruptRecord):
            token_records._checked(io.BytesIO(bytes(bad)).read)
    import io
    assert token_records._checked(io.BytesIO(good).read) == b"payload"
    with pytest.raises(token_records.CorruptRecord):
        token_records._checked(io.BytesIO(good[:-2]).read)


# 2 and 8: classifiers -------------------------------------------------------------

def test_ftrl_finds_planted_words_and_stays_sparse():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=40)) + (" scum idiot" if i % 4 == 0 else "") for i in range(600)]
    y = [int(i % 4 == 0) for i in range(600)]
    learner = toxicity.learn(array(texts[:400]), y[:400])
    at = np.append(np.flatnonzero(np.abs(learner.z[:-1]) > toxicity.L1), 1 << toxicity.HASH_BITS)
    model = toxicity.Model(at[:-1], learner.weights(at)[:-1].astype(float), float(learner.weights(at)[-1]))
    seen = np.unique(toxicity.features(*words.buffer_of(array(texts[:400])))[1])
    assert len(model.places) < len(seen) / 100
    assert ((toxicity.score_texts(array(texts[400:]), model) >= 0.5) == np.array(y[400:])).all()


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, note string")


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_classifiers_on_edges(spark, edge, empty, name):
    module, label = {"toxicity": (toxicity, "toxic"), "quality": (quality, "quality")}[name]
    none = labels_of(spark, [(1, None, None, "x"), (None, 1, 1, "x")])
    assert module.fit(edge, none, label) is None
    assert {r.score for r in module.score(edge, None).collect()} == {0.5}
    texts = [(100 + i, ("good plain words here " if i % 2 else "bad!! %%% $$$ | ") * 30 + str(i)) for i in range(400)]
    docs = frame(spark, EDGE + texts)
    labels = labels_of(spark, [(i, i % 2, i % 2, "x") for i, _ in texts] + [(6, 0, 0, "x"), (6, 1, 1, "x")])
    model = module.fit(docs, labels, label)
    rows = module.score(docs, model).collect()
    assert len(rows) == len(EDGE) + len(texts) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (6, 7)}) == 1
    assert np.mean([(r.score >= 0.5) == bool(r.doc_id % 2) for r in rows if (r.doc_id or 0) >= 100]) > 0.95
    assert module.score(empty, model).count() == 0


@pytest.mark.parametrize("name, floor", [("op2_toxicity", 0.9), ("op8_quality", 0.95)])
def test_held_out_accuracy(spark, name, floor):
    folder = "/root/testdata/sf0.01"
    label = {"op2_toxicity": "toxic", "op8_quality": "quality"}[name]
    truth = {r.doc_id: r[label] for r in table(spark, folder, "labels").collect()}
    rows = [r for r in queries.QUERIES[name](spark, folder).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) >= floor


# 3: fingerprints -------------------------------------------------------------------

def test_simhash_in_order_and_search(spark, edge, empty):
    rows = simhash.compare_in_order(edge).collect()
    assert len(rows) == len(EDGE) and simhash.compare_in_order(empty).count() == 0
    same = {bytes(r.fp) for r in rows if r.doc_id in (6, 7)}
    assert len(same) == 1 and all(r.n_chars == len(LONG) for r in rows if r.doc_id == 5)
    assert all(bytes(r.fp) == bytes(16) for r in rows if r.doc_id in (1, 2, 3, 4))
    ids = {d: t or "" for d, t in EDGE if d}
    order = sorted(ids)
    by = {r.doc_id: r for r in rows}
    for a, b in zip(order, order[1:]):
        if a != 6 and b != 6:
            assert by[a].edited_sha256 == hashlib.sha256(simhash.edited(ids[a], ids[b]).encode()).hexdigest()
    one = simhash.compare_in_order(frame(spark, [(1, "just one document")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


@pytest.mark.parametrize("radius, blocks", [(3, 4), (2, 4), (6, 8)])
def test_block_tables_find_all_within_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    base = [rng.getrandbits(128) for _ in range(30)]
    prints = base + [b ^ sum(1 << p for p in rng.sample(range(128), rng.randrange(9))) for b in base for _ in range(4)] + base[:3]
    df = spark.createDataFrame([(p.to_bytes(16, "little"),) for p in prints], "fp binary")
    found = {bytes(r.fp): r.n for r in simhash.within(df, df, radius, blocks).collect()}
    assert found == {p.to_bytes(16, "little"): sum((p ^ q).bit_count() <= radius for q in prints) for p in prints}


@pytest.mark.parametrize("radius, blocks", [(11, 6), (3, 4), (9, 4), (1, 4)])
def test_search_returns_each_fingerprint_within_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    base = [rng.getrandbits(128) for _ in range(20)]
    prints = base + [b ^ sum(1 << p for p in rng.sample(range(128), rng.randrange(15))) for b in base for _ in range(6)] + base[:3]
    df = spark.createDataFrame([(p.to_bytes(16, "little"),) for p in prints], "fp binary")
    rows = simhash.pairs_within(df.limit(15), df, radius, blocks).collect()
    as_int = {p.to_bytes(16, "little"): p for p in prints}
    found = sorted((as_int[bytes(r.fp)], as_int[bytes(r.found)], r.distance, r.rows) for r in rows)
    assert found == sorted((p, q, (p ^ q).bit_count(), prints.count(q)) for p in set(prints[:15]) for q in set(prints)
                           if (p ^ q).bit_count() <= radius)


def test_fingerprint_query_lists_an_edited_copy(spark, monkeypatch):
    text = " ".join(f"word{i * i % 997}" for i in range(250))
    copy = text.replace("word4 ", "other ", 1)
    docs = frame(spark, [(50, text), (51, copy), (52, copy), (53, "something else entirely")])
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    rows = {r.doc_id: r for r in queries.op3_document_fingerprints(spark, "").collect()}
    listed = {x.fingerprint for x in rows[50].within_radius}
    assert {i for i, r in rows.items() if r.fingerprint in listed} == {50, 51, 52}
    assert rows[50].n_within_radius == 3 and rows[51].within_radius is None


# 4: near-dedup ----------------------------------------------------------------------

def test_fingerprints_equal_the_definition(sample):
    for t in [t for _, t in sample[:60]] + [t for _, t in EDGE if t != LONG]:
        assert near_dedup.fingerprint_text(None if t is None else t.encode()) % (1 << 64) == plain_fingerprint(t)


def test_golay_decoding_is_perfect():
    rng = np.random.default_rng(0)
    index = np.arange(4096)
    code = [int(v) << 11 for v in index]
    low, high, _ = near_dedup._decoder()
    code = np.array([c | int(low[c & 0xFFF] ^ high[c >> 12]) for c in code])
    assert min(int(c).bit_count() for c in code[1:]) == 7
    for _ in range(20):
        flips = sum(1 << int(p) for p in rng.choice(23, rng.integers(0, 4), replace=False))
        assert (near_dedup.decode(code ^ flips) == index).all()


@pytest.mark.parametrize("shape", [(3, 2), (5, 3), (4, 2)])
def test_linked_fingerprints_share_a_key(shape):
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << p for p in rng.sample(range(64), rng.randrange(5)))
        keys = [set(near_dedup.golay_keys(np.array([x], np.uint64).view(np.int64), *shape)[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


@pytest.mark.parametrize("hot", [4096, 8])
def test_components_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(near_dedup, "HOT_KEY", hot)
    monkeypatch.setattr(near_dedup, "SMALL_RUN", 4)
    rng = random.Random(7)
    prints = [rng.getrandbits(64) for _ in range(20)]
    for _ in range(150):  # chains and dense groups
        prints.append(rng.choice(prints) ^ sum(1 << p for p in rng.sample(range(64), rng.randrange(1, 6))))
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = near_dedup.links(df)
    rows = {r.node: r.root for r in near_dedup.components(edges).collect()}
    wanted = plain_components([p % (1 << 64) for p in prints], 4)
    assert [rows.get(p, p) for p in prints] == [prints[w] for w in wanted]


def test_near_groups_on_edges(spark, edge, empty):
    rows = near_dedup.near_groups(edge).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(EDGE) and near_dedup.near_groups(empty).count() == 0
    assert {by[i].component_id for i in (1, 2, 3)} == {1} and by[1].fingerprint == "0" * 16
    assert by[7].component_id == 6
    kept = near_dedup.keep_one(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 8, 9, 10]


def test_keep_one_keeps_a_document_of_each_group(spark):
    one, two, three, four = (" ".join(f"{w}{i * i}" for i in range(60)) for w in ("alpha", "beta", "gamma", "delta"))
    rows = [(None, one), (None, one), (None, two), (None, two + " "), (1, three), (1, three), (1, four), (2, four)]
    kept = sorted((r.doc_id or 0, r.text.strip()) for r in near_dedup.keep_one(frame(spark, rows)).collect())
    assert kept == sorted([(0, one), (0, two), (1, three), (1, four)])


# 5: language ---------------------------------------------------------------------------

def small_model():
    languages = ("de", "en")
    grams = np.zeros((1 << language_id.GRAM_BITS, 2), np.float32)
    uses = np.zeros((len(language_id.SCRIPTS), 2), bool)
    uses[0] = True
    for k, text in enumerate(("der die und nicht schon größer ", "the and this with other things ")):
        raw, at = words.buffer_of(language_id.prepared(array([text])))
        w = words.words(raw, at, words.ALNUM, lower=False, hashed=False)
        for a, b in zip(w.start, w.end):
            grams[language_id.places(raw, int(a), int(b)), k] = 1.5
    return language_id.Model(languages, grams - grams.mean(axis=1, keepdims=True), uses)


def test_no_language_model_keeps_every_document(spark, edge):
    assert language_id.keep_languages(edge, None).count() == len(EDGE)


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(2)
    for _ in range(20):
        count = rng.integers(0, 6, 4)
        scores = rng.normal(size=(int(count.sum()), 3)).astype(np.float32)
        label = language_id.viterbi(scores, count, 0.7)
        at = 0
        for n in count:
            s = scores[at:at + n].astype(float)

            def value(path):
                return sum(s[i, k] for i, k in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))
            if n:
                best = max(value(p) for p in itertools.product(range(3), repeat=int(n)))
                assert abs(value(label[at:at + n]) - best) < 1e-6
            at += n


def test_spans_of_mixed_text():
    found = language_id.spans("der die und nicht schon the and this with other", small_model())
    assert [x[2] for x in found] == ["de", "en"]
    assert language_id.spans("...", small_model()) == []


def test_scripts_by_first_code_point():
    text = "abc где ψυχή 日本 한국 éa 😀"
    raw, at = words.buffer_of(array([text]))
    w = words.words(raw, at, words.ALNUM)
    assert [language_id.SCRIPTS[i] for i in language_id.scripts(raw, w.start)] == [
        "latin", "cyrillic", "greek", "han", "hangul", "latin", "other"]


def test_language_on_edges(spark, edge, empty, sample):
    model = small_model()
    rows = language_id.predict(edge, model).collect()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {1, 2, 3, 4} <= und and not und & {5, 6, 7, 8, 9, 10} and len(rows) == len(EDGE)
    assert all(r.score == 0 for r in rows if r.doc_id == 9)  # a script without a learned language
    assert {r.lang_pred for r in language_id.predict(edge, None).collect()} == {"und"}
    assert language_id.fit(empty) is None and language_id.predict(empty, model).count() == 0
    kept = language_id.keep_languages(edge, model)
    assert kept.columns == edge.columns and {1, 2, 3, 4, 9} & {r.doc_id for r in kept.collect()} == set()


def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = [r for r in queries.op5_language_id(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.98


# 6: decontamination ----------------------------------------------------------------------

ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "short item"), (10, "Short ITEM!"),
         (3, "..."), (4, None), (5, "the the the the the the the the the the the the the the"), (6, "é")]
PASSAGE = "One, two three four five six seven eight nine ten eleven twelve thirteen fourteen."


def test_contamination_equals_brute_force(spark, empty):
    docs = EDGE + [(20, "a short item here " + "filler words " * 10), (21, PASSAGE + " and more"), (22, "x " * 600 + PASSAGE),
                   (23, "the " * 40), (24, "ten eleven twelve thirteen fourteen"), (25, PASSAGE + " " + PASSAGE), (26, "é É café")]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    rows = decontaminate.contamination(frame(spark, docs), benchmark)
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_contamination(docs, ITEMS)))
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(frame(spark, docs), benchmark.where("false")).collect()} == {0}


def test_decontamination_takes_effect(spark):
    benchmark = spark.createDataFrame([(1, ITEMS[0][1])], "item_id long, text string")
    docs = frame(spark, [(1, PASSAGE), (2, "clean"), (3, "w " * 400 + PASSAGE), (None, None), (4, "start " + PASSAGE + " end.")])
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "None"]
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, benchmark).collect()}
    assert cut[2] == "clean" and cut[4] == "start. end." and cut[1] == "." and cut[None] is None


def test_only_texts_that_may_be_hit_are_shuffled(spark):
    """Beyond the broadcast threshold the texts are filtered before their exchange."""
    benchmark = spark.createDataFrame([(1, ITEMS[0][1])], "item_id long, text string")
    docs = frame(spark, [(1, PASSAGE), (None, PASSAGE), (2, "clean"), (3, None)])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = decontaminate.contamination(docs, benchmark)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "LeftSemi, BuildRight" in plan
        assert sorted((str(r.doc_id), r.n_hit > 0) for r in rows.collect()) == [("1", True), ("2", False), ("3", False), ("None", True)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_contamination_of_repeated_rows_and_long_texts(spark):
    """A benchmark of one common word, a text that is hit everywhere, repeated rows, one plan with and without broadcasts."""
    items = [(1, "the " * 13), (2, ITEMS[0][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, "the " * 20_000 + "end"), (1, "the " * 20_000 + "end"), (None, PASSAGE), (None, PASSAGE), (None, "the " * 12), (2, "w " * 9_000 + PASSAGE)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(map(repr, plain_contamination(docs, items)))
    try:
        for threshold in (limit, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            rows = decontaminate.contamination(frame(spark, docs), benchmark).collect()
            assert sorted(repr((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in rows) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    cut = [r.text for r in decontaminate.remove_spans(frame(spark, docs), benchmark).collect()]
    assert sorted(cut) == sorted([" end", " end", ".", ".", "the " * 12, "w " * 8_999 + "w."])


# 7: tool calls -----------------------------------------------------------------------------

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after array<string>, status string"
RESULTS = "conv_id long, turn long, call_id string, content string, record string"


def linked(spark, calls, results):
    return tool_calls.link(spark.createDataFrame([(*c, "x") for c in calls], CALLS),
                           spark.createDataFrame([(*r, "x") for r in results], RESULTS), tool_calls.schema_table(spark)).collect()


def test_tool_calls_are_linked_and_checked(spark):
    ok = '{"query":"q","limit":3}'
    rows = {(r.conv_id, r.call_id): r for r in linked(spark, [
        (1, 0, "a", "search", ok, ["b"]), (1, 0, "a", "search", ok, ["b"]), (1, 2, "b", "search", '{"limit":"x","query":"é\\n"}', None),
        (1, 4, "c", "search", '{"limit":1.5,"query":null,"more":1}', ["a", "zz"]), (1, 5, "d", "nothing", "{}", []),
        (1, 6, "e", "search", "not json", None), (1, 7, "f", "search", None, None), (1, 8, None, "search", ok, None),
        (2, 0, "a", "translate", '{"query":"","limit":-1}', ["x"]), (2, 1, "x", "summarise", '{"query":"z"}', ["a"]),
        (2, 2, "k", "search", '{"a":1,"a":2}', None), (3, 0, "s", "search", ok, ["s"])],
        [(1, 1, "a", "done"), (1, 1, "a", "done"), (1, 3, "a", "again"), (1, 3, "q", "lost"), (2, 9, "a", None)])}
    a = rows[1, "a"]
    assert (a.status, a.order_turn, a.order_steps, a.n_calls, a.n_results, a.result_turn) == ("linked", 2, 1, 1, 2, 1)
    assert a.record == '{"arguments":{"limit":3,"query":"q"},"call_id":"a","name":"search","result":"done"}'
    assert rows[1, "b"].errors == "type of limit" and rows[1, "b"].status == "unanswered"
    assert rows[1, "c"].errors == "type of limit, type of query, unexpected more, unknown dependency zz"
    assert (rows[1, "c"].order_turn, rows[1, "c"].order_steps) == (4, 0)
    assert rows[1, "d"].errors == "unknown tool" and rows[1, "q"].status == "orphan" and rows[1, None].status == "no id"
    assert {rows[1, x].errors for x in "ef"} == {"malformed"} and rows[2, "k"].errors == "malformed"
    assert rows[2, "a"].status == rows[2, "x"].status == rows[3, "s"].status == "cycle"
    assert json.loads(rows[2, "a"].record)["result"] is None


def test_tool_calls_of_empty_tables(spark):
    assert linked(spark, [], []) == []


def test_order_puts_dependencies_first(spark):
    rng = random.Random(3)
    calls = [(1, t, f"c{t}", "search", "{}", [f"c{u}" for u in rng.sample(range(30), 2) if (u * 7) % 30 < (t * 7) % 30]) for t in range(30)]
    at = {r.call_id: (r.order_turn, r.order_steps) for r in linked(spark, calls, [])}
    assert all(at[d] < at[c[2]] for c in calls for d in c[5])


def test_order_equals_plain_recursion_on_rings_and_branches(spark):
    rng = random.Random(5)
    calls = []
    for conv in range(40):
        n = rng.randint(1, 14)
        for t in range(n):
            turn = t if conv % 3 else rng.randint(0, 3)  # turns may tie
            after = [f"c{rng.randrange(n)}" if rng.random() < .25 else f"c{max(0, t - rng.randint(1, 3))}" for _ in range(rng.choice([0, 1, 1, 2]))]
            calls.append((conv, turn, f"c{t}", "search", "{}", after))
    got = {(r.conv_id, r.call_id): None if r.status == "cycle" else (r.order_turn, r.order_steps) for r in linked(spark, calls, [])}
    want = plain_call_ranks(calls)
    assert got == want and None in want.values() and len({r for r in want.values()}) > 20


def test_long_chains_and_rings_take_few_rounds(spark, monkeypatch):
    calls = [(1, t, f"c{t}", "search", "{}", [f"c{(t + 1) % 1000}"]) for t in range(1000)]  # a ring
    calls += [(2, t, f"c{t}", "search", "{}", [f"c{t + 1}"]) for t in range(1000)]  # a chain
    calls += [(3, t, f"c{t}", "search", "{}", [f"c{t - 1}"] + [f"c{t + 1}"] * (t == 500)) for t in range(1000)]  # a small ring, and all behind it
    written = []
    monkeypatch.setattr(tool_calls, "stored", lambda df, purpose: written.append(purpose) or stored(df, purpose))
    rows = {(r.conv_id, r.call_id): r for r in linked(spark, calls, [])}
    assert written.count("call-steps") <= 25
    assert all(rows[1, f"c{t}"].status == "cycle" for t in range(1000))
    assert all((rows[2, f"c{t}"].order_turn, rows[2, f"c{t}"].order_steps) == (999, 999 - t) for t in range(1000))
    assert [rows[3, f"c{t}"].status == "cycle" for t in range(1000)] == [t >= 500 for t in range(1000)]


# 9: SentencePiece -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_viterbi.Pieces(public_tokenizers.path("piece_bpe_32k.model"), cache_words=500)


def test_viterbi_pieces_equal_plain_search(pieces, sample):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    parts = sorted({w for _, t in sample[:40] for w in t.split()})[:300] + ["日本語", "a😀b", "x" * 40, "don't", "co-op.\n"]
    for part, ids in zip(parts, pieces.encode(array(parts))):
        score, cuts = plain_best(pieces, "▁" + part)
        found = [model.id_to_piece(i) for i in ids.tolist()]
        if not any(model.is_byte(i) for i in ids.tolist()):
            assert abs(sum(model.get_score(i) for i in ids.tolist()) - score) < 1e-6 and found == cuts
        assert pieces.decode(ids.tolist()) == part


def unigram_twin():
    """The same pieces and scores, read by the library as a unigram model (trainer_spec.model_type = 1)."""
    import sentencepiece

    def varint(b, i):
        value = shift = 0
        while True:
            value, shift, i = value | (b[i] & 127) << shift, shift + 7, i + 1
            if b[i - 1] < 128:
                return value, i

    def fields(b, i, end):
        while i < end:
            tag, i = varint(b, i)
            start = i
            if tag & 7 == 0:
                _, i = varint(b, i)
            elif tag & 7 == 2:
                n, start = varint(b, i)
                i = start + n
            else:
                i += {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, start, i
    data = bytearray(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    for field, a, z in list(fields(data, 0, len(data))):
        if field == 2:
            for inner, x, _ in list(fields(data, a, z)):
                if inner == 3:
                    data[x] = 1
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(data))


def test_viterbi_is_never_worse_than_the_library(pieces, sample):
    twin = unigram_twin()
    parts = sorted({w for _, t in sample[:100] for w in t.split()})[:3000]
    equal = 0
    for part, ids in zip(parts, pieces.encode(array(parts))):
        other = twin.encode(part)
        mine, its = (sum(twin.get_score(i) for i in x) for x in (ids.tolist(), other))
        assert 0 <= mine - its < 64  # its sums are 32-bit floats beside a score of -1e9
        equal += ids.tolist() == other
    assert equal > 0.98 * len(parts)


def test_long_parts_block_by_block_equal_the_batched_search(pieces):
    rng = random.Random(1)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ab", "eth▁nao日😀é.\n", "x"):
        for n in (1, 2, 15, 16, 17, 100, 700):
            chars = np.frombuffer("".join(rng.choices(letters, k=n)).encode("utf-32-le"), np.uint32)
            ids, _ = pieces.viterbi(chars.reshape(1, -1))
            for block in (1, 7, 64, 1 << 15):
                assert pieces.viterbi_long(chars, block).tolist() == ids.tolist()


def test_two_million_letters_without_a_space_stay_small(pieces):
    import tracemalloc
    text = "".join(random.Random(2).choices("abcdefghijklmnopqrstuvwxyz", k=1 << 21))
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    tracemalloc.start()
    try:
        ids = pieces.viterbi_long(chars)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert pieces.decode(ids.tolist()) == text and peak < 64 << 20


def test_sentencepiece_round_trip(spark, edge, empty, pieces, sample):
    path = public_tokenizers.path("piece_bpe_32k.model")
    odd = ["  two  blanks ", "\n\nlines\t", "a\x00b", "é é", "🙂🙂", " "]
    for t, ids in zip([*odd, *(t for _, t in sample[:50])], pieces.encode(array([*odd, *(t for _, t in sample[:50])]))):
        assert pieces.decode(ids.tolist()) == t
    rows = sentencepiece_viterbi.encode_rows(edge, path)
    assert rows.where("not round_trip").isEmpty() and rows.count() == len(EDGE)
    back = sorted(((r.doc_id or 0), r.text) for r in sentencepiece_viterbi.decode_rows(rows, path).collect())
    assert back == sorted(((i or 0), t or "") for i, t in EDGE)
    assert sentencepiece_viterbi.encode_rows(empty, path).count() == 0
    assert sentencepiece_viterbi.encode_documents(edge, path).columns == [
        *(c for c in edge.columns if c != "ids"), "ids", "n_ids", "round_trip"]


# 10: sharding ------------------------------------------------------------------------------------

@pytest.mark.parametrize("shape", ["even", "hot", "few"])
def test_cuts_are_minimax(spark, shape):
    rng = random.Random(shape)
    n = {"even": 500, "hot": 300, "few": 5}[shape]
    groups = sorted({rng.getrandbits(64) - (1 << 63): rng.randrange(1, 40) for _ in range(n)}.items())
    if shape == "hot":
        groups[7] = (groups[7][0], 3000)
    df = spark.createDataFrame(groups, "h long, weight long")
    at = sharding.cuts(df, 16)
    loads = [sum(w for h, w in groups if sum(h > c for c in at) == s) for s in range(16)]
    assert max(loads) == plain_capacity([w for _, w in groups], 16) and len(at) <= 15
    assert sum(load > 0 for load in loads) == min(16, len(groups))
    if shape == "hot":  # the runs beside the hot group are minimax over the 15 shards left
        before, after = [w for _, w in groups[:7]], [w for _, w in groups[8:]]
        best = min(max(plain_capacity(before, k) if before else 0, plain_capacity(after, 15 - k)) for k in range(1, 15))
        assert sorted(loads)[-2] == best


def test_repeated_rows_are_dealt(spark):
    rows = sharding.shard_rows(frame(spark, [(1, "same")] * 3000 + [(i, f"text {i}") for i in range(2, 3000)]), slot_buckets=8)
    by = {}
    for r in rows.collect():
        by.setdefault(r.shard, []).append(r.slot)
    assert len(by) == 16 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards_on_edges(spark, edge, empty):
    rows = sharding.shard_rows(edge, slot_buckets=4).collect()
    assert len(rows) == len(EDGE) and sharding.shard_rows(empty).count() == 0
    assert len({r.shard for r in rows if r.doc_id in (6, 7)}) == 1 and all(0 <= r.shard < 16 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    texts = {i: t for i, t in EDGE if i}
    assert all((r["size"], r.text_crc32) == (len((texts[r.doc_id] or "").encode()) + 1, zlib.crc32((texts[r.doc_id] or "").encode()))
               for r in rows if r.doc_id)
