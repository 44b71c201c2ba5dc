"""The registered queries and the pipeline over the smallest driver tables."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from test_corpus import bigram_scores
from test_tokens import LIBRARY, LONGEST, RANKS, greedy

from check_queries import cell
from lotwise.llm import raking
from lotwise.llm.queries import QUERIES, SQL
from lotwise.plans.registry import table


@pytest.fixture(scope="module")
def texts(spark, small_sf):
    return {r.doc_id: r.text for r in table(spark, small_sf, "documents").collect()}


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small_sf, name):
    duck = duckdb.connect()
    for source in ("documents", "embeddings", "benchmark"):
        duck.execute(f"CREATE VIEW {source} AS SELECT * FROM '{small_sf}/{source}.parquet'")
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    df = QUERIES[name](spark, small_sf)
    assert sorted(df.columns) == sorted(columns)
    got = sorted(tuple(cell(row[c]) for c in columns) for row in df.collect())
    assert got == sorted(tuple(map(cell, row)) for row in result.fetchall())


def test_language_model(spark, small_sf, texts):
    want = bigram_scores(texts)
    rows = QUERIES["op1_ngram_lm"](spark, small_sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        held, tokens, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and abs(r.score - score) <= 0.002 * tokens


def test_tokens(spark, small_sf, texts):
    for r in QUERIES["op2_token_counts"](spark, small_sf).collect():
        words = regex.findall(public_tokenizers.PATTERN, texts[r.doc_id])
        assert (r.n_words, r.n_tokens) == (len(words), sum(greedy(w.encode(), RANKS, LONGEST) for w in words))
    for r in QUERIES["op9_byte_bpe"](spark, small_sf).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize(("name", "label", "least"), [("op3_quality", "quality", 0.9), ("op6_toxicity", "toxic", 0.8)])
def test_classifiers(spark, small_sf, texts, name, label, least):
    rows = QUERIES[name](spark, small_sf).collect()
    marks = {r.doc_id: r[label] for r in table(spark, small_sf, "labels").collect()}
    assert {r.doc_id for r in rows} == set(texts) and all(0 <= r.score <= 1 for r in rows)
    new = [r.predicted == marks[r.doc_id] for r in rows if r.held_out and r.doc_id in marks]
    assert np.mean(new) >= least


def test_language(spark, small_sf, texts):
    rows = QUERIES["op4_language"](spark, small_sf).collect()
    langs = {r.doc_id: r.lang for r in table(spark, small_sf, "documents").collect()}
    assert len(rows) == len(texts) and np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) >= 0.95


def test_mixing(spark, small_sf, texts):
    rows = QUERIES["op7_mixing"](spark, small_sf).collect()
    assert len(rows) == len(texts)
    for name in ("source", "lang"):
        values = {r[name] for r in rows}
        tokens = {v: sum(r.tokens for r in rows if r[name] == v) for v in values}
        mass = {v: sum(r.tokens * r.probability for r in rows if r[name] == v) for v in values}
        wanted = {v: n**0.7 for v, n in tokens.items()}
        for v in values:
            assert mass[v] / sum(mass.values()) == pytest.approx(wanted[v] / sum(wanted.values()), abs=1e-4)


def test_stages_keep_what_they_should(spark, odd_documents, small_sf):
    docs = table(spark, small_sf, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "toxicity", "near_duplicates", "mixing", "encoding"]
    planted = [
        (9_000_001, None, "en", "src0", 0),
        (9_000_002, "!!! 12 -- 34", "en", "src0", 12),
        (9_000_003, docs.first().text, "en", "src1", 1),
    ]
    extended = docs.union(spark.createDataFrame(planted, docs.schema)).cache()
    kept = {name: {r.doc_id for r in stages[name](spark, extended, small_sf).collect()} for name in list(stages)[:3]}
    assert not kept["language"] & {9_000_001, 9_000_002} and 9_000_003 in kept["language"]
    assert len(kept["language"]) == docs.count() + 1
    assert 9_000_003 not in kept["near_duplicates"] and docs.first().doc_id in kept["near_duplicates"]
    marks = {r.doc_id: r.toxic for r in table(spark, small_sf, "labels").collect()}
    assert all(i in kept["toxicity"] for i, toxic in marks.items() if toxic == 0)
    for name in ("language", "toxicity", "near_duplicates", "mixing"):
        assert stages[name](spark, extended, small_sf).columns == columns


def test_run_is_all_stages(spark, small_sf, texts):
    rows = corpus_pipeline.run(spark, small_sf).collect()
    assert 0 < len(rows) < len(texts) and len({r.doc_id for r in rows}) == len(rows)
    for r in rows:
        assert r.round_trip and list(r.ids) == LIBRARY.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_topics_come_from_vectors(spark, small_sf):
    rows = QUERIES["op7_mixing"](spark, small_sf)
    vectors = {r.vec_id: r.label for r in table(spark, small_sf, "embeddings").collect()}
    assert all(r.topic == vectors.get(r.doc_id) for r in rows.collect())
    assert rows.filter(F.col("tokens") != F.col("tokens").cast("long")).count() == 0 and raking.MISSING
