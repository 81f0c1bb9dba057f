"""Registered queries: SQL oracles, contracts, and the pipeline against brute force over its own stages."""

import duckdb
import public_tokenizers
import pytest

from brute_force import plain_components, plain_contamination

import corpus_pipeline
from martflow.llm import language_id, near_dedup, quality, queries, sentencepiece_viterbi
from martflow.llm.common import stored, table
from tools.check_oracle import canon

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    found = con.execute(queries.ORACLE[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in found.description], found.fetchall())


def test_native_queries_run_no_python(spark):
    for name in ("op6_decontamination", "op7_tool_call_linking", "op10_sharding"):
        plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_every_number_has_one_query():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = table(spark, FOLDER, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = quality.fit(docs, table(spark, FOLDER, "labels"))
    score = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    rows = {i: t for i, t in rows.items() if score[i] >= 0.5}
    good = docs.where(docs.doc_id.isin([*rows]))
    found = {r.doc_id: r for r in language_id.predict(good, language_id.fit(good)).collect()}
    rows = {i: t for i, t in rows.items() if found[i].lang_pred != "und" and found[i].score >= 0.4}
    ids = sorted(rows)
    roots = plain_components([near_dedup.fingerprint_text(rows[i].encode()) % (1 << 64) for i in ids], 4)
    rows = {i: rows[i] for k, i in enumerate(ids) if roots[k] == k}
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    rows = {r[0]: rows[r[0]] for r in plain_contamination(rows.items(), items) if not r[-1]}
    out = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: r.text for r in out} == rows and all(r.round_trip for r in out)
    pieces = sentencepiece_viterbi.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert all(pieces.decode(r.ids) == r.text and r.n_ids == len(r.ids) for r in out)
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5 and corpus_pipeline.ORACLE_SQL is None


def test_stages_take_empty_and_odd_documents(spark):
    docs = table(spark, FOLDER, "documents")
    odd = spark.createDataFrame([(10_000_001, None, None, None, None), (10_000_002, "", "", "", 0), (None, "A plain text of words.", "en", "s", 1)],
                                docs.schema)
    for start in (docs.where("false"), odd):
        current = start
        for name, stage in corpus_pipeline.STAGES:
            current = stored(stage(spark, current, FOLDER), "stage")
        assert current.count() <= start.count()
