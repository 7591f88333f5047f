"""The registered queries against their SQL or brute force, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from checks.compare import compare
from driftline.llm import decontamination, pieces, queries, secret_scan, simhash, toxicity

SQL = {name: sql for name, (_, sql) in queries.QUERIES.items() if sql}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(queries.QUERIES[name][0](spark, sf_dir), con, SQL[name]) is None


@pytest.mark.parametrize("name", ["op3_suffix_dedup", "op5_sentencepiece", "op6_secret_scan", "op8_embedding_dedup", "op10_simhash_dedup"])
def test_query_returns_every_row(spark, sf_dir, name):
    source = "embeddings" if "embedding" in name else "documents"
    table = queries.table(spark, sf_dir, source)
    found = queries.QUERIES[name][0](spark, sf_dir).collect()
    assert sorted(r[0] for r in found) == sorted(r[0] for r in table.select(table.columns[0]).collect())


def test_pipeline_stages_take_effect(spark):
    # The smallest tables keep no document with a live secret up to that stage.
    sf_dir = "/root/testdata/sf0.01"
    docs = queries.table(spark, sf_dir, "documents")
    columns = docs.columns
    kept = [{r.doc_id: r for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        kept.append({r.doc_id: r for r in docs.collect()})
        assert len(kept[-1]) == docs.count() <= len(kept[-2])
    start, tame, single, clean, redacted = kept

    everything = queries.table(spark, sf_dir, "documents")
    model = toxicity.fit_held_in(everything.select("doc_id", "text"), queries.table(spark, sf_dir, "labels"))
    toxic = {r.doc_id for r in toxicity.score_documents(everything, model).collect() if r.predicted}
    assert set(tame) == set(start) - toxic

    frame = spark.createDataFrame(list(tame.values()), everything.schema)
    groups = simhash.near_duplicates(frame).collect()
    assert set(single) == {r.component_id for r in groups}
    frame = spark.createDataFrame(list(single.values()), everything.schema)
    leaked = decontamination.find_leaks(frame, queries.table(spark, sf_dir, "benchmark")).collect()
    assert set(clean) == set(single) - {r.doc_id for r in leaked} != set(single)

    frame = spark.createDataFrame(list(clean.values()), everything.schema)
    live = {r.doc_id: [s.value for s in r.spans if s.live] for r in secret_scan.find_secrets(frame).collect()}
    assert set(redacted) == set(clean) and any(live.values())
    for i, values in live.items():
        assert all(v not in redacted[i].text for v in values)
        assert values or redacted[i] == clean[i]

    coder = pieces.PieceCoder(pieces.read_model(spark))
    coded = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()}
    assert set(coded) == set(redacted)
    for i, row in redacted.items():
        assert coded[i].ids == coder.encode([row.text])[0].tolist()


def test_pipeline_keeps_columns_named_like_a_score(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    named = docs.selectExpr("*", "lang AS score", "doc_id AS predicted", "source AS n_sentences", "text AS offending")
    kept = corpus_pipeline.drop_toxic(spark, named, sf_dir)
    assert kept.schema == named.schema
    plain = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, sf_dir).collect()}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == plain and len(rows) == len(plain)
    assert all((r.score, r.predicted, r.n_sentences, r.offending) == (r.lang, r.doc_id, r.source, r.text) for r in rows)


def test_pipeline_runs_whole(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "lang", "source", "n_pieces", "ids"]
    assert found.where("n_pieces != size(ids)").count() == 0 < found.count()
