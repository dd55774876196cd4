"""Registered queries against their SQL, and the pipeline's stages, at the smallest scale."""

import os

import duckdb
import pytest

import corpus_pipeline
from hearthline.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in os.listdir(FOLDER):
        db.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return db


def plain(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, FOLDER)
    want = duck.sql(queries.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.columns, map(tuple, got.collect())) == plain(want.columns, want.fetchall())


def test_all_ten_are_registered():
    assert sorted(int(k.split("_")[0][2:]) for k in queries.QUERIES) == list(range(1, 11))


def test_pipeline_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "secret_scan", "source_mix", "byte_bpe"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = [(900_001, None, None, "src1", 0), (900_002, "12345 ... 678", "en", "src1", 13), (None, "", "en", None, 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), "stage")
        seen.append(docs)
    told, single, clean, mixed, coded = seen
    assert all(list(df.columns) == list(corpus_pipeline.COLUMNS) for df in seen[:4])
    assert told.filter("doc_id >= 900001 or doc_id is null").count() == 0
    ids = {r.doc_id for r in told.select("doc_id").collect()}
    groups = duckdb.sql(queries.SQL["op10_jaccard_join"].replace("FROM documents", f"FROM '{FOLDER}/documents.parquet'")).fetchall()
    assert {r.doc_id for r in single.select("doc_id").collect()} == {d for d, _, c in groups if d == c and d in ids}
    assert clean.count() == single.count() and clean.filter("text rlike 'AKIA[A-Z0-9]{14}'").count() == 0
    before = clean.selectExpr("sum(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+')) n").first().n
    after = mixed.selectExpr("sum(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+')) n").first().n
    assert abs(after - before) < 0.1 * before
    assert mixed.groupBy("doc_id").count().filter("count > 3").count() == 0
    assert mixed.join(clean, list(corpus_pipeline.COLUMNS), "left_anti").count() == 0
    assert coded.count() == mixed.count() and coded.filter("not round_trip").count() == 0
