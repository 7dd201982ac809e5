"""Registered text queries against SQL, and the pipeline against a plain version of each stage."""

import hashlib
import os
import re

import numpy as np
import pytest

import corpus_pipeline
from miasma.llm import quality, queries, rules, simhash

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, duck, name):
    cursor = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    got = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_thirteen_operators_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


def test_every_row_gets_a_result(spark):
    docs, pages = (spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in ("documents", "pages"))
    for name, rows in (("op2_lm_scoring", docs), ("op4_html_extraction", pages), ("op6_resharding", docs)):
        assert queries.QUERIES[name](spark, SF_DIR).count() == rows


def test_held_out_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op9_quality_classifier"](spark, SF_DIR).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.85


def test_pipeline_equals_its_stages_done_plainly(spark):
    from tokenizers import Tokenizer

    from test_text_operators import brute_components, brute_fingerprint, brute_hits, brute_statistics

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r in docs.collect()]
    weights = quality.train(docs, labels)
    rows = [r for r, s in zip(rows, quality.dot(weights, [r.text.encode() for r in rows], quality.Words())) if s >= 0]
    found = rules.train(docs, labels)
    kept = {r.doc_id for r in rules.judge(spark.createDataFrame(rows, docs.schema), found).filter("kept").collect()}
    rows = [r for r in rows if r.doc_id in kept]
    for r in rows:
        n, _, _, _, repeats = brute_statistics(r.text)
        assert n >= 50 and 100 * repeats <= 50 * n
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    stays = set(brute_components(prints, 2))
    rows = [r for r in rows if r.doc_id in stays]
    hits = {r.doc_id: brute_hits(r.text, items) for r in rows}
    rows = [r for r in rows if not (hits[r.doc_id][1] and 20 * hits[r.doc_id][1] >= hits[r.doc_id][0])]
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    expected = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in rows}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.ids for r in got} == expected and len(got) == len(expected)
    texts = {r.doc_id: r.text for r in rows}
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()


def test_star_rounds_reach_the_smallest_vertex(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "u bigint, v bigint")
    assert {r.u: r.v for r in simhash.roots(chain).collect()} == {**{i: 0 for i in range(1, 61)}, 101: 100}
