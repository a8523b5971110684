"""Registered queries of the subpackage against their SQL, and the pipeline against brute force."""

import os

import duckdb
import pytest

import corpus_pipeline
from compare import TABLES, as_rows
from tierline.functions.spread import materialize
from tierline.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    result = db.execute(SQL[name])
    assert as_rows(df.columns, df.collect()) == as_rows([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_pipeline_stages(spark):
    from test_text_operators import brute_components

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, before, FOLDER), name)
        if name != "packing":
            assert after.columns == docs.columns
        if name == "near_dedup":
            rows = sorted(before.select("doc_id", "text").collect())
            _, label = brute_components([r.text for r in rows], 5, 80)
            assert sorted(r.doc_id for r in after.collect()) == [r.doc_id for i, r in enumerate(rows) if label[i] == i]
        if name == "secrets":
            assert after.count() == before.count()
        if name == "packing":
            assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {r.doc_id for r in before.collect()}
        sizes[name] = after.count()
        before = after
    assert 0 < sizes["decontamination"] <= sizes["near_dedup"] < docs.count()
