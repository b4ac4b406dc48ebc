"""The registered queries against their SQL, and the pipeline against its stages by brute force."""

from __future__ import annotations

import re

import duckdb
import pytest

import corpus_pipeline
from layerloom.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_there_is_one_query_per_operator():
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = connection.sql(ORACLE_SQL[name])
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    rows = [tuple(r) for r in found.select(*columns).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected.select(*columns).fetchall()))


def test_pipeline_keeps_clean_documents_and_packs_them(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, kept, FOLDER)
        assert found.columns == docs.columns, name
        rows = found.collect()
        assert len({r.doc_id for r in rows}) == len(rows)
        kept = spark.createDataFrame(rows, docs.schema)
    left = {r.doc_id: r.text for r in kept.collect()}
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in left.values()]
    assert len(set(texts)) == len(texts)
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(left)
